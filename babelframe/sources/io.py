"""Sources and sinks.

Readers take explicit schemas (ids stay strings, D1). Writers go through
Spark's committers (concurrent tasks never append to one file, D17).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from babelframe import constants as C
from babelframe.session import configured
from babelframe.sources.json_records import read_records

TURN = T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())])
CONVERSATION_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("conversations", T.ArrayType(TURN)),
    ]
)
METADATA_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("blip_caption", T.StringType())])
AUDIT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in C.AUDIT_HEADER])
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("English", T.StringType()),
        T.StructField("Ground_truth", T.StringType()),
        T.StructField("Model_output", T.StringType()),
        T.StructField("Bleu_score", T.DoubleType()),
    ]
)

# RFC-4180 CSV: doubled quotes, values kept verbatim
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# a missing value is written as nothing, an empty text as ""; reading tells
# them apart by a mark for missing values that texts do not hold
CSV_READ_OPTIONS = CSV_OPTIONS | {"nullValue": "\0"}
# tables of texts that a job writes as CSV; readers tell gzip by the file's
# name, and a multi-line file is read by one task in any case
CSV_PACKED_OPTIONS = CSV_OPTIONS | {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
#: Reports that a task writes side by side.
REPORT_WRITERS = 64


def read_conversations(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Conversation records of JSON arrays (or objects) in any layout,
    each file read by many tasks; ``multi_line=False`` is Spark's own reader
    for a record a line."""
    if multi_line:
        return read_records(spark, path, CONVERSATION_SCHEMA)
    return spark.read.schema(CONVERSATION_SCHEMA).json(path)


def read_metadata(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Caption metadata ``(id, blip_caption)``, read like S1."""
    if multi_line:
        return read_records(spark, path, METADATA_SCHEMA)
    return spark.read.schema(METADATA_SCHEMA).json(path)


def read_parallel_csv(spark: SparkSession, path: str, languages: list[str] | None = None) -> DataFrame:
    """S3: wide parallel-sentence CSV, every column a string."""
    langs = languages or C.PARALLEL_LANGUAGES
    schema = T.StructType(
        [T.StructField(C.PARALLEL_ENGLISH_COLUMN, T.StringType())]
        + [T.StructField(n + C.PARALLEL_SUFFIX, T.StringType()) for n in langs]
    )
    return spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(path)


def write_parallel_csv(df: DataFrame, path: str) -> None:
    """S3: a wide parallel table, packed. Shuffle files that its rows came
    through are removed once it is written."""
    with configured(df.sparkSession, classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.mode("overwrite").options(**CSV_PACKED_OPTIONS).csv(path)


def read_dataset(spark: SparkSession, root: str) -> DataFrame:
    """A columnar dataset with all splits (``split=`` partitions)."""
    return spark.read.parquet(root)


def write_conversations(df: DataFrame, path: str) -> None:
    """Every row written (failed rows keep their text), JSON lines."""
    df.write.mode("overwrite").json(path)


def write_audit_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """``ID, GPT Value Original, GPT Value Modified`` for successes."""
    df.select(*[F.col(c) for c in C.AUDIT_HEADER]).write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_audit_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.options(**CSV_READ_OPTIONS).schema(AUDIT_SCHEMA).csv(path)


def save_dataset(df: DataFrame, path: str, split_col: str | None = "split") -> None:
    """Checkpoint a dataset to parquet (by split when present)."""
    w = df.write.mode("overwrite")
    if split_col and split_col in df.columns:
        w = w.partitionBy(split_col)
    w.parquet(path)


def publish_dataset(df: DataFrame, root: str, owner: str, name: str, private: bool = False) -> str:
    """S9 (re-aimed): copy all splits to ``root/owner/name`` (no network);
    a private dataset is written under ``root/.private``."""
    base = f"{root.rstrip('/')}/{'.private/' if private else ''}{owner}/{name}"
    save_dataset(df, base)
    return base


def write_reports(df: DataFrame, path: str) -> None:
    """One report per (prompt_idx, lang) - one partitioned write, packed.

    A task keeps up to REPORT_WRITERS reports open, so that its texts are not
    sorted by report (and spilled) first; rows of further ones are."""
    out = df.select("prompt_idx", "lang", "English", "Ground_truth", "Model_output", "Bleu_score")
    with configured(df.sparkSession, maxConcurrentOutputFileWriters=str(REPORT_WRITERS)):
        out.write.mode("overwrite").partitionBy("prompt_idx", "lang").options(**CSV_PACKED_OPTIONS).csv(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(list(REPORT_SCHEMA.fields) + [T.StructField("prompt_idx", T.LongType()), T.StructField("lang", T.StringType())])
    return spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(path)


def write_sample_csv(df: DataFrame, text_col: str, path: str) -> None:
    """The text column only, no index; the sample is small by contract
    (``n_samples`` rows), so it is written as a single file."""
    df.select(text_col).coalesce(1).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_sample_csv(spark: SparkSession, text_col: str, path: str) -> DataFrame:
    return spark.read.options(**CSV_READ_OPTIONS).schema(T.StructType([T.StructField(text_col, T.StringType())])).csv(path)
