"""Secret scans with an incremental blob ledger.

Every historical version of a document is a blob, addressed by the SHA-256 of
its text. The ledger is a Parquet table (blob, rules, findings): which
rule versions have been run on a blob, and what they found. ``scan`` hashes all
texts, takes one text per blob, removes the (blob, rule version) pairs the
ledger has, runs the missing rules, appends one row per blob worked on, and
joins the findings back to every row that holds the blob. A new rule version
is run on all blobs, the other rules only on new ones.

A run that dies before its append leaves the ledger as it was; one that dies
after it is not paid again. Two runs at once may both scan a blob; reading
the ledger takes distinct findings, so results stay right.

Spans are code points, end exclusive. The kinds of ``BASE`` keep exactly the
patterns below; ``EXTRA`` adds formats of well-known tokens and private keys.

Edge cases: a NULL text counts as the empty one and has no findings; repeated
rows each get the findings; a NULL doc_id is carried through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from babelframe.session import work_path


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are leftmost and do not overlap; those whose
    ``group`` has fewer than ``least`` characters are dropped. ``needs``: a
    string that every match contains. Change ``version`` with the pattern."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    needs: str = ""

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base patterns and their least lengths. (?ai:...) folds
# the ASCII letters of the keywords only.
BASE = (
    Rule("assign", 1, r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, "AKIA"),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32),
)
EXTRA = (
    Rule("github", 2, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, "gh"),
    Rule("slack", 2, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, "xox"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30, "eyJ"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----", 0, 60, "PRIVATE KEY"),
)
RULES = BASE + EXTRA

_FOUND = "array<struct<rule:string,from:int,to:int>>"
LEDGER = f"blob string, rules array<string>, findings {_FOUND}"


def find(text: str, rule: Rule, pattern: re.Pattern) -> list[tuple[str, int, int]]:
    if rule.needs not in text:
        return []
    return [(rule.key, *m.span()) for m in pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _compiled(rule: Rule) -> re.Pattern:
    # A whole match of plain letters and one repeated class is a maximal run,
    # so the least length can be part of the pattern; it then skips short
    # runs faster. Every other pattern is run as written.
    head = re.fullmatch(r"([A-Za-z]*)\[[^\[\]\\]+\]\+", rule.pattern)
    if rule.group == 0 and head and rule.least > len(head[1]):
        return re.compile(rule.pattern[:-1] + f"{{{rule.least - len(head[1])},}}")
    return re.compile(rule.pattern)


def _scanner(rules: tuple[Rule, ...]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = {r.key: (r, _compiled(r)) for r in rules}
        for f in frames:
            yield pd.DataFrame(
                {
                    "blob": f["blob"],
                    "rules": f["todo"],
                    "findings": [
                        [dict(zip(("rule", "from", "to"), x, strict=True)) for k in todo for x in find(text, *made[k])]
                        for text, todo in zip(f["text"], f["todo"], strict=True)
                    ],
                }
            )

    return run


def read_ledger(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan(
    df: DataFrame,
    ledger: str | None = None,
    rules: tuple[Rule, ...] = RULES,
    text_col: str = "text",
) -> DataFrame:
    """``df`` without its text, with ``blob`` and ``findings`` (rule, from,
    to; by place, then as ``rules`` lists them); columns of ``df`` of these
    names get a final ``_``. Appends to ``ledger``, a folder all executors
    share (a fresh one in the work folder if None)."""
    spark = df.sparkSession
    ledger = ledger or work_path(spark, "llm-ledger")
    keys = F.array(*[F.lit(r.key) for r in rules])
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = df.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    known = read_ledger(spark, ledger)
    if known is None:
        todo = blobs.withColumn("todo", keys)
    else:
        done = known.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
        done = done.filter(F.size(F.array_except(keys, "done")) < len(rules))
        todo = (
            blobs.join(done, "blob", "left")
            .withColumn("todo", F.array_except(keys, F.coalesce("done", F.array().cast("array<string>"))))
            .filter(F.size("todo") > 0)
        )
    todo.select("blob", "text", "todo").mapInPandas(_scanner(rules), LEDGER).write.mode("append").parquet(ledger)
    found = (
        read_ledger(spark, ledger)
        .select("blob", F.explode("findings").alias("x"))
        .filter(F.col("x.rule").isin([r.key for r in rules]))
        .groupBy("blob")
        .agg(F.collect_set("x").alias("findings"))  # bounded by one text
        .select(F.col("blob").alias("found_blob"), "findings")
    )
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)])
    ranked = F.sort_array(F.transform("findings", lambda x: F.struct(x["from"], order[x["rule"]].alias("rank"), x["to"], x["rule"].alias("rule"))))
    findings = F.transform(ranked, lambda x: F.struct(x["rule"].alias("rule"), x["from"].alias("from"), x["to"].alias("to")))
    rest = [c for c in df.columns if c != text_col]
    hashed = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)], F.sha2(text, 256).alias("own_blob"))
    joined = hashed.join(found, F.col("own_blob") == F.col("found_blob"), "left")
    joined = joined.select(*[f"c{i}" for i in range(len(rest))], "own_blob", F.coalesce(findings, F.array().cast(_FOUND)).alias("findings"))
    return joined.toDF(*[f"{c}_" if c in ("blob", "findings") else c for c in rest], "blob", "findings")


def kind(rule):
    return F.substring_index(rule, "@", 1)


def span_list(findings) -> F.Column:
    """Findings as ``kind:start:end``, comma-joined."""
    one = F.transform(findings, lambda x: F.concat_ws(":", kind(x["rule"]), x["from"].cast("string"), x["to"].cast("string")))
    return F.array_join(one, ",")


def redact(df: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``df`` with every secret replaced by ``[kind]``; overlapping findings
    are replaced together, under the first one's kind. Rows without findings
    stay as they are."""
    spark = df.sparkSession
    ledger = ledger or work_path(spark, "llm-ledger")
    names, df = df.columns, df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    text_col = f"c{names.index(text_col)}"
    text = F.col(text_col)
    found = (
        scan(df.select(text_col), ledger, rules, text_col)
        .filter(F.size("findings") > 0)
        .groupBy("blob")
        .agg(F.first("findings").alias("__findings"))
        .withColumnRenamed("blob", "__blob")
    )
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    clean = F.aggregate(
        "__findings",
        start,
        lambda a, x: F.struct(
            F.when(
                x["from"] >= a["at"],
                F.concat(a["text"], F.substring(text, a["at"] + 1, x["from"] - a["at"]), F.lit("["), kind(x["rule"]), F.lit("]")),
            )
            .otherwise(a["text"])
            .alias("text"),
            F.greatest(a["at"], x["to"]).alias("at"),
        ),
        lambda a: F.concat(a["text"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    blob = F.sha2(F.coalesce(text, F.lit("")), 256)
    return (
        df.join(found, blob == F.col("__blob"), "left")
        .withColumn(text_col, F.when(F.col("__findings").isNull(), text).otherwise(clean))
        .select(*df.columns)
        .toDF(*names)
    )
