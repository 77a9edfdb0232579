"""Records of JSON files of any layout, read by many tasks.

A JSON array of records is one value, so Spark's ``multiLine`` reader takes a
file as a whole in one task. Here a file is cut at every ``}`` by the text
source, which reads byte ranges of one file in parallel and from any store.
A ``}`` may also lie in a text or close an inner object, so what a range
means depends on all before it - but only through two numbers: whether it
begins inside a quoted text, and how many brackets are open.

1. Each range tells, for both cases of the first number, how it ends, by how
   much the brackets change and how few were open on the way: one small row a
   range. A running sum over
   these rows, in the order of the file, gives the state at which each range
   begins.
2. With its state each range cuts out its records as texts. A record that
   ends in a later range leaves pieces, which are put together by the range
   that the record began in.

Records are the objects of a top-level array, or, if there is none, the
top-level objects one after another (JSON lines). They are parsed with an
explicit schema, like Spark's own reader does (malformed ones give NULLs).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a range worked on at a time; only memory depends on it.
CHUNK = 1 << 20


def _scan(raw: np.ndarray, quoted: bool) -> tuple[np.ndarray, bool]:
    """(+1, -1 or 0 for brackets outside of texts; ends inside a text) of
    bytes that begin inside a text or not."""
    quote = raw == 0x22
    slash = raw == 0x5C
    if slash.any():
        # a quote counts unless an odd run of backslashes stands before it
        at = np.arange(len(raw), dtype=np.int32)
        run = np.zeros(len(raw), np.int32)
        run[1:] = (at - np.maximum.accumulate(np.where(slash, np.int32(-1), at)))[:-1]
        quote &= run % 2 == 0
    inside = np.logical_xor.accumulate(quote) ^ quoted
    opens = ((raw == 0x7B) | (raw == 0x5B)) & ~inside
    closes = ((raw == 0x7D) | (raw == 0x5D)) & ~inside
    return opens.astype(np.int8) - closes, bool((int(quote.sum()) + quoted) % 2)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """(file, begin, bytes): the ranges of a task in order, each in chunks of
    about CHUNK bytes (a line at least) that end with a bracket."""
    key, parts, size = None, [], 0
    for b in batches:
        file, begin, value = b.column(0), b.column(1).to_numpy(), b.column(2)
        ends = np.cumsum(pc.binary_length(value).to_numpy().astype(np.int64))
        code = file.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((begin[1:] != begin[:-1]) | (code[1:] != code[:-1])) + 1
        at, done = 0, 0
        for last in [*cuts.tolist(), len(ends)][: len(ends)]:
            now = (file[at].as_py(), int(begin[at]))
            while at < last:
                if now != key or size >= CHUNK:
                    if parts:
                        yield (*key, b"}".join([*parts, b""]))
                    key, parts, size = now, [], 0
                to = min(last, max(at + 1, int(np.searchsorted(ends, done + CHUNK - size, "right"))))
                parts += value.slice(at, to - at).to_pylist()
                size += int(ends[to - 1]) - done
                at, done = to, int(ends[to - 1])
    if parts:
        yield (*key, b"}".join([*parts, b""]))


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    """Rows of a schema written as ``name type, ...``."""
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds, strict=True)], names=names)


_ARROW = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a range does, begun outside (0) and inside (1) of a text: ends
    inside of one, change of depth, least depth on the way."""
    out = []
    for (file, begin), chunks in groupby(_chunks(batches), key=lambda c: c[:2]):
        row = None
        for _, _, text in chunks:
            if row is None:
                head = text.removeprefix(b"\xef\xbb\xbf").lstrip()[:1]
                row = [file, begin, head == b"[", False, 0, 0, True, 0, 0]
            for at in (3, 6):
                step, ends = _scan(np.frombuffer(text, np.uint8), row[at])
                depth = row[at + 1] + np.cumsum(step, dtype=np.int32)
                row[at : at + 3] = ends, int(depth[-1]), min(row[at + 2], int(depth.min()))
        out.append(row)
    yield _batch(out, _TOLD)


_TOLD = "file string, begin long, array boolean, ends0 boolean, step0 long, low0 long, ends1 boolean, step1 long, low1 long"


def _states(rows: list) -> dict[tuple[str, int], tuple[bool, int, int, int]]:
    """How each range begins: (inside a text, depth, depth around records,
    beginning of the range in which a record still open began)."""
    out: dict[tuple[str, int], tuple[bool, int, int, int]] = {}
    file, quoted, depth, level, since = None, False, 0, 0, -1
    for r in sorted(rows, key=lambda r: (r["file"], r["begin"])):
        if r["file"] != file:
            file, quoted, depth, level, since = r["file"], False, 0, int(r["array"]), -1
        out[file, r["begin"]] = (quoted, depth, level, since)
        ends, step, low = (r["ends1"], r["step1"], r["low1"]) if quoted else (r["ends0"], r["step0"], r["low0"])
        if depth <= level or depth + low <= level:  # what was open has been closed
            since = r["begin"]
        quoted, depth = ends, depth + step
    return out


def _records(held):
    """Records, and pieces of those that cross the border of a range (``whole``
    is false): ``begin`` and ``place`` tell where the record begins (a piece
    without its head has place -1), ``piece`` the range of a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = held.value
        for (file, begin), chunks in groupby(_chunks(batches), key=lambda c: c[:2]):
            quoted, depth, level, since = states[file, begin]
            parts: list[bytes] = []
            place = -1 if depth > level else None  # of the record that is open
            done = 0

            def row(text: bytes, closed: bool, begin=begin, file=file, since=since) -> tuple:
                head = place is not None and place < 0
                return (file, since if head else begin, place, begin, closed and not head, text)

            for _, _, text in chunks:
                step, quoted = _scan(np.frombuffer(text, np.uint8), quoted)
                after = depth + np.cumsum(step, dtype=np.int32)
                starts = np.flatnonzero((step > 0) & (after == level + 1)).tolist()
                ends = (np.flatnonzero((step < 0) & (after == level)) + 1).tolist()
                rows = []
                if place is not None:
                    parts.append(text[: ends[0]] if ends else text)
                    if ends:
                        rows.append(row(b"".join(parts), True))
                        place, parts, ends = None, [], ends[1:]
                for i, a in enumerate(starts):
                    place = done + a
                    if i < len(ends):
                        rows.append(row(text[a : ends[i]], True))
                        place = None
                    else:
                        parts = [text[a:]]
                depth, done = int(after[-1]), done + len(text)
                yield _batch(rows, _FOUND)
            if place is not None:
                yield _batch([row(b"".join(parts), False)], _FOUND)

    return run


_FOUND = "file string, begin long, place long, piece long, whole boolean, text binary"


def read_record_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, begin, place, text): the records of JSON files as texts; the
    first three columns give their order."""
    ranges = spark.read.option("lineSep", "}").format("text").load(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("begin"),
        F.col("value").cast("binary").alias("value"),
    )
    told = ranges.mapInArrow(_summary, _TOLD).collect()  # one row a byte range
    found = ranges.mapInArrow(_records(spark.sparkContext.broadcast(_states(told))), _FOUND)
    whole = found.filter("whole").select("file", "begin", "place", "text")
    crossing = (
        found.filter("NOT whole")
        .groupBy("file", "begin")  # the pieces of one record
        .agg(F.max("place").alias("place"), F.sort_array(F.collect_list(F.struct("piece", "text"))).alias("pieces"))
        .select("file", "begin", "place", F.aggregate("pieces", F.lit(b""), lambda a, x: F.concat(a, x["text"])).alias("text"))
    )
    return whole.unionByName(crossing).withColumn("text", F.col("text").cast("string"))


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The records of JSON files (arrays or lines) with the given schema."""
    return read_record_texts(spark, path).select(F.from_json("text", schema).alias("r")).select("r.*")


def _array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mark = "["
    for b in batches:
        if b.num_rows:
            marks = pa.array([mark, *[","] * (b.num_rows - 1)])
            mark = ","
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, b.column(0).cast(pa.string()), "")], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]" if mark == "," else "[]"])], names=["value"])


def write_arrays(df: DataFrame, path: str) -> None:
    """Every part file is one JSON array of its records, a record a line."""
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    lines.mapInArrow(_array_lines, "value string").write.mode("overwrite").text(path)
