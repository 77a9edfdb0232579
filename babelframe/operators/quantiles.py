"""Exact quantiles by refining value intervals through counts.

An order statistic is found without sorting: the values of an interval are
counted in equal bins, together with each bin's smallest and largest value.
The bin that holds the wanted rank becomes the next interval, cut down to the
values that really occur in it. A bin with one value is settled at once,
however many rows hold it. When the open intervals hold few rows, their
distinct values are counted and the ranks read off.

Counts, minima and maxima merge, so each round is one aggregate with partial
sums inside the tasks; no row is shuffled and a value that half of all rows
hold costs no task more than any other. All columns and all ranks share the
rounds. The first round needs the range (one job); up to some 10**11 rows
with no extreme spread, two rounds of counting and the last look-up suffice.

NULL and NaN are left out; infinities take their ranks at the ends.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of an interval; rows that the open intervals may hold at the end.
BINS, FEW_ROWS = 2048, 50_000
#: Positive intervals of a larger ratio are binned by logarithms.
WIDE_RATIO = 1e6


@dataclass
class Interval:
    """Values ``low`` to ``high`` of a column: ``before`` finite values are
    smaller, ``rows`` lie in it, and ``ranks`` are looked for."""

    column: int
    low: float
    high: float
    before: int
    rows: int
    ranks: list[int] = field(default_factory=list)

    def place(self, v: Column) -> Column:
        """The bin of a value of the interval, never falling with the value."""
        if self.low > 0 and self.high / self.low > WIDE_RATIO:
            start, width = math.log(self.low), math.log(self.high) - math.log(self.low)
            share = (F.log(v) - F.lit(start)) / F.lit(width)
        else:  # halves, so that the width of the widest interval is finite
            share = (v / 2 - F.lit(self.low / 2)) / F.lit(self.high / 2 - self.low / 2)
        return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor(share * BINS))).cast("int")

    def holds(self, v: Column) -> Column:
        return (v >= F.lit(self.low)) & (v <= F.lit(self.high))


def _members(df: DataFrame, cols: list[str], intervals: list[Interval], value) -> DataFrame:
    """One row for each value in an open interval: its number and ``value``."""
    found = []
    for j, c in enumerate(cols):
        v = F.col(c).cast("double")
        own = [(i, x) for i, x in enumerate(intervals) if x.column == j]
        if own:
            found.append(F.coalesce(*[F.when(x.holds(v), F.struct(F.lit(i).alias("interval"), *value(x, v))) for i, x in own]))
    return df.select(F.explode(F.filter(F.array(*found), lambda s: s.isNotNull())).alias("m")).select("m.*")


def order_statistics(df: DataFrame, cols: list[str], ranks: dict[str, list[int]], shape: dict[str, tuple[int, float, float]]) -> dict[str, dict[int, float]]:
    """The finite values of the given 0-based ranks; ``shape``: number of
    finite values, least and largest one of each column."""
    out: dict[str, dict[int, float]] = {c: {} for c in cols}
    open_: list[Interval] = []

    def settle(x: Interval) -> None:
        if x.low == x.high:
            out[cols[x.column]].update({r: x.low for r in x.ranks})
        elif x.ranks:
            open_.append(x)

    for j, c in enumerate(cols):
        if ranks[c]:
            n, low, high = shape[c]
            settle(Interval(j, low, high, 0, n, sorted(set(ranks[c]))))
    stuck = False
    while open_ and not stuck and sum(x.rows for x in open_) > FEW_ROWS:
        bins = _members(df, cols, open_, lambda x, v: (x.place(v).alias("bin"), v.alias("v")))
        counted = bins.groupBy("interval", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        rows: dict[int, list] = {}
        for r in counted.collect():  # BINS rows an interval at most
            rows.setdefault(r["interval"], []).append(r)
        last, open_ = open_, []
        for i, x in enumerate(last):
            before, left = x.before, list(x.ranks)
            for r in sorted(rows[i], key=lambda r: r["bin"]):
                mine = [k for k in left if k < before + r["n"]]
                if mine:
                    settle(Interval(x.column, r["low"], r["high"], before, r["n"], mine))
                    left = left[len(mine) :]
                before += r["n"]
        # neighbouring numbers that the bins cannot part: few distinct values
        stuck = [(x.low, x.high) for x in open_] == [(x.low, x.high) for x in last]
    if open_:
        values = _members(df, cols, open_, lambda x, v: (v.alias("v"),)).groupBy("interval", "v").agg(F.count(F.lit(1)).alias("n"))
        found: dict[int, list] = {}
        for r in values.collect():  # FEW_ROWS rows at most, or as many as are neighbours
            found.setdefault(r["interval"], []).append((r["v"], r["n"]))
        for i, x in enumerate(open_):
            before, left = x.before, list(x.ranks)
            for v, n in sorted(found[i]):
                mine = [k for k in left if k < before + n]
                out[cols[x.column]].update({k: v for k in mine})
                left, before = left[len(mine) :], before + n
    return out


def exact_quantiles_many(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles (``quantile_cont``) of several columns."""
    aggs = []
    for j, c in enumerate(cols):
        v = F.col(c).cast("double")
        finite = F.when(F.abs(v) < F.lit(math.inf), v)  # NaN is no less than infinity
        aggs += [F.count(finite).alias(f"n{j}"), F.min(finite).alias(f"low{j}"), F.max(finite).alias(f"high{j}")]
        aggs += [F.count_if(v == F.lit(-math.inf)).alias(f"down{j}"), F.count_if(v == F.lit(math.inf)).alias(f"up{j}")]
    r = df.agg(*aggs).first()
    wanted: dict[str, list[int]] = {}
    positions: dict[str, list[float]] = {}
    for j, c in enumerate(cols):
        n = r[f"n{j}"] + r[f"down{j}"] + r[f"up{j}"]
        positions[c] = [(n - 1) * p for p in probs] if n else []
        need = {k for x in positions[c] for k in (math.floor(x), math.ceil(x))}
        wanted[c] = [k - r[f"down{j}"] for k in need if 0 <= k - r[f"down{j}"] < r[f"n{j}"]]
    shape = {c: (r[f"n{j}"], r[f"low{j}"], r[f"high{j}"]) for j, c in enumerate(cols)}
    values = order_statistics(df, cols, wanted, shape)
    out: dict[str, list[float | None]] = {}
    for j, c in enumerate(cols):

        def at(k: int, j: int = j, c: str = c) -> float:
            k -= r[f"down{j}"]
            return -math.inf if k < 0 else math.inf if k >= r[f"n{j}"] else values[c][k]

        out[c] = [None for _ in probs] if not positions[c] else []
        for x in positions[c]:
            low, high = at(math.floor(x)), at(math.ceil(x))
            out[c].append(low if low == high else low + (high - low) * (x - math.floor(x)))
    return out


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Exact linear-interpolated quantiles of one column."""
    return exact_quantiles_many(df, [col], probs)[col]
