"""Nested conversation expressions on ``array<struct<from,value>>`` columns.

These are per-row higher-order functions: on a nested dataset (S1) they run
in the scan stage with no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from babelframe import constants as C


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def turns_of_role(conv: Column | str, role: str) -> Column:
    return F.filter(_c(conv), lambda t: t["from"] == F.lit(role))


def last_value_of_role(conv: Column | str, role: str) -> Column:
    """Value of the last turn of ``role``; none -> ''."""
    return F.coalesce(F.try_element_at(turns_of_role(conv, role), F.lit(-1))["value"], F.lit(""))


def first_value_of_role(conv: Column | str, role: str = C.GPT) -> Column:
    """Value of the first turn of ``role``; none -> NULL (the item fails)."""
    return F.try_element_at(turns_of_role(conv, role), F.lit(1))["value"]


def last_turn_value(conv: Column | str) -> Column:
    """Value of the last turn of any role."""
    return F.try_element_at(_c(conv), F.lit(-1))["value"]


def replace_role_values(conv: Column | str, role: str, new_value: Column) -> Column:
    """Every turn of ``role`` gets ``new_value``; other turns unchanged."""
    return F.transform(
        _c(conv),
        lambda t: F.when(
            t["from"] == F.lit(role), F.struct(t["from"].alias("from"), new_value.alias("value"))
        ).otherwise(t),
    )


def is_multi_turn(conv: Column | str) -> Column:
    """more than two turns."""
    return F.size(_c(conv)) > 2
