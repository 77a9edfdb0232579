"""Scalar text functions as Catalyst column expressions (no Python per row).

All regular expressions here are written so that Java (Spark) and RE2 read
them the same way: explicit escapes, no ``\\s``/``\\w`` shorthands, whose
meaning differs between engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from babelframe import constants as C

# --- fixed values: the characters Python's str.split() treats as whitespace --
WS_CHARS = (
    r"\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WS_CHARS}]"
# the same characters as a plain list, for ``translate`` (a character map)
WS_LIST = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
NOT_WS_RUN = f"[^{WS_CHARS}]+"
# word characters as Python's re \w sees them in our data: letters, digits, _
WORD_RUN = r"[\p{L}\p{N}_]+"
# one sub-word-like token: a word run or one other non-space character
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS_CHARS}]"
# ASCII punctuation (POSIX [:punct:])
ASCII_PUNCT_CLASS = r"[!-/:-@\[-`{-~]"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def spaces(col: Column | str) -> Column:
    """Every whitespace character mapped to a plain space (no regex)."""
    return F.translate(_c(col), WS_LIST, " " * len(WS_LIST))


def split_ws(col: Column | str) -> Column:
    """Whitespace tokens, as Python ``str.split()`` (M6 tokens)."""
    return F.regexp_extract_all(_c(col), F.lit(NOT_WS_RUN), 0)


def words_lower(col: Column | str) -> Column:
    """M9: ``re.findall(r'\\w+', str(text).lower())`` -> array<string>."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit("None"))), F.lit(WORD_RUN), 0)


def strip_ws(col: Column | str) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends
    (``btrim`` with the whitespace set: no regex scan of the whole text)."""
    return F.btrim(_c(col), F.lit(WS_LIST))


def strip_image_tag(col: Column | str) -> Column:
    """Remove every ``<image>``; newlines stay."""
    return F.replace(_c(col), F.lit(C.IMAGE_TAG), F.lit(""))


def strip_image_affix(col: Column | str) -> Column:
    """Remove ``\\n<image>`` then ``<image>\\n``; a bare tag stays."""
    once = F.replace(_c(col), F.lit("\n" + C.IMAGE_TAG), F.lit(""))
    return F.replace(once, F.lit(C.IMAGE_TAG + "\n"), F.lit(""))


def capitalize_first(col: Column | str) -> Column:
    """P10: ``s.lower().capitalize()`` - first character upper, rest lower.

    Not ``initcap``: only the very first character of the string is raised.
    """
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def language_code(col: Column | str) -> Column:
    """Lower-cased ISO code with the ``jp`` alias folded into ``ja``."""
    c = F.lower(_c(col))
    for alias, code in C.LANGUAGE_ALIASES.items():
        c = F.when(c == alias, F.lit(code)).otherwise(c)
    return c


def language_name(col: Column | str, names: dict[str, str] | None = None) -> Column:
    """ISO 639-1 code -> language name; unknown -> NULL."""
    names = names or C.LANGUAGE_NAMES
    mapping = F.create_map(*[F.lit(x) for kv in sorted(names.items()) for x in kv])
    return F.try_element_at(mapping, language_code(col))


def render_template(template: Column | str, message: Column | str) -> Column:
    """``template.format(message=text)`` for a ``{message}`` slot.

    ``template`` is a Column or a literal template string.
    """
    tpl = F.lit(template) if isinstance(template, str) else template
    return F.replace(tpl, F.lit("{message}"), F.coalesce(_c(message).cast("string"), F.lit("None")))


def input_message(col: Column | str) -> Column:
    """P13 (evaluation form): ``f"Input: {text}"``."""
    return F.concat(F.lit("Input: "), F.coalesce(_c(col).cast("string"), F.lit("None")))


def as_message(col: Column | str) -> Column:
    """Coerce any value to its string form (NULL -> 'None')."""
    return F.coalesce(_c(col).cast("string"), F.lit("None"))


def clean_response(col: Column | str) -> tuple[Column, Column]:
    """(translation, error). Strips all Unicode whitespace; empty -> error."""
    raw = _c(col)
    text = strip_ws(raw)
    error = (
        F.when(raw.isNull(), F.lit("No response"))
        .when(text == "", F.concat(F.lit("empty_response: "), raw))
    )
    return text, error


def char_length(col: Column | str) -> Column:
    """M2: length in code points (Python ``len``)."""
    return F.length(_c(col)).cast("bigint")


def count_matches(col: Column | str, pattern: str) -> Column:
    """Number of characters of ``col`` matching a one-character class."""
    c = _c(col)
    return F.length(c) - F.length(F.regexp_replace(c, F.lit(pattern), ""))


def json_escaped_length(col: Column | str) -> Column:
    """Length of a string inside Python ``json.dumps`` output (ensure_ascii).

    ``"`` and ``\\`` and \\b \\f \\n \\r \\t take 2 characters, other control
    characters 6, non-ASCII BMP characters 6 (\\uXXXX), supplementary
    characters 12 (a surrogate pair). Trap D9.
    """
    c = F.coalesce(_c(col), F.lit(""))
    return (
        F.length(c)
        + count_matches(c, r"[\"\\\x{08}\x{0c}\n\r\t]")
        + 5 * count_matches(c, r"[\x{00}-\x{07}\x{0b}\x{0e}-\x{1f}\x{7f}]")
        + 5 * count_matches(c, r"[\x{80}-\x{ffff}]")
        + 11 * count_matches(c, r"[\x{10000}-\x{10ffff}]")
    )


def json_turn_length(from_col: Column | str, value_col: Column | str) -> Column:
    """M8 for one turn: ``len(json.dumps({"from": f, "value": v}))``."""
    return F.lit(len('{"from": "", "value": ""}')) + json_escaped_length(from_col) + json_escaped_length(value_col)


def json_turns_length(turns: Column | str) -> Column:
    """M8 on a nested ``array<struct<from,value>>``: ``len(json.dumps(turns))``."""
    t = _c(turns)
    per_turn = F.aggregate(
        t,
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + json_turn_length(x["from"], x["value"]),
    )
    n = F.size(t)
    return F.lit(2) + per_turn + F.greatest(n - 1, F.lit(0)) * 2
