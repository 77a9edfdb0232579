"""Quality classifier: a byte-level convolutional network in numpy.

A document's bytes are cut into overlapping chunks that cover the whole text.
Learned byte embeddings and filters run over each chunk; each filter's
largest response in the chunk is kept (max-pooling). A logistic output
combines the mean and the largest chunk response of every filter into one
probability.

The network is fitted on a bounded sample of labelled rows, by Adam on the
log loss; through max-pooling only the winning position of a filter gets a
gradient, so a step works on gathered windows.

Edge cases: NULL and empty texts are one chunk of padding and get a score
like any other; labels other than 0 and 1 are not learned from; without both
labels in the sample every score is the share of label 1 (0.5 if none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe.llm import common as C

CHUNK, OVERLAP = 512, 64
WIDTH, STRIDE = 8, 2
DEPTH, FILTERS = 4, 16
#: The sample: about so many labelled rows, with texts of at most so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 20_000
EPOCHS, BATCH, RATE = 14, 64, 0.01
#: Share of good training texts that are cropped to a short piece, anew each time.
CROPPED = 0.3

Net = dict[str, np.ndarray]


def chunks(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(chunks, row of each): byte values + 1; 0 is padding, which has an embedding too."""
    raw, offs = C.text_bytes(text)
    step = CHUNK - OVERLAP
    size = np.diff(offs)
    count = np.maximum(1, -(-(size - OVERLAP) // step))
    row = np.repeat(np.arange(len(size)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = (offs[:-1][row] + nth * step)[:, None] + np.arange(CHUNK)
    inside = at < offs[1:][row][:, None]
    padded = np.append(raw.astype(np.int16) + 1, 0).astype(np.int16)
    return padded[np.where(inside, at, len(raw))], row


def responses(net: Net, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter in each chunk, and where."""
    best = np.empty((len(x), FILTERS), np.float32)
    where = np.empty((len(x), FILTERS), np.int64)
    positions = (CHUNK - WIDTH) // STRIDE + 1
    for i in range(0, len(x), 64):
        e = np.ascontiguousarray(net["bytes"][x[i : i + 64]]).reshape(-1, CHUNK * DEPTH)
        views = np.lib.stride_tricks.sliding_window_view(e, WIDTH * DEPTH, axis=1)[:, :: STRIDE * DEPTH]
        r = (views.reshape(-1, WIDTH * DEPTH) @ net["filters"]).reshape(len(e), positions, FILTERS)
        where[i : i + 64] = r.argmax(1)
        best[i : i + 64] = r.max(1)
    return np.maximum(best + net["bias"], 0), where


def combine(net: Net, pooled: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Probability of each row; its features; starts and sizes of its chunks."""
    start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    size = np.diff(np.append(start, len(row)))
    mean = np.add.reduceat(pooled, start) / size[:, None].astype(np.float32)
    top = np.maximum.reduceat(pooled, start)
    features = np.concatenate([mean, top], 1)
    z = features @ net["weights"] + net["offset"]
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30))), features, start, size


def _crop(text: str, rng: np.random.Generator) -> str:
    """Sometimes a short piece of the text. Any piece of a good text is good,
    so this teaches that few patterns alone (a short text) are no fault; a
    piece of a bad text may be good."""
    if rng.random() >= CROPPED or len(text) < 40:
        return text
    at = text.find(" ", int(rng.integers(len(text) // 2))) + 1
    return text[at : at + int(rng.integers(10, 250))]


def fit(texts: list[str], labels: np.ndarray, seed: int = 5) -> Net:
    rng = np.random.default_rng(seed)
    net: Net = {
        "bytes": rng.normal(0, 0.5, (257, DEPTH)).astype(np.float32),
        "filters": rng.normal(0, (2 / (WIDTH * DEPTH)) ** 0.5, (WIDTH * DEPTH, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "weights": rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        net["weights"][:] = 0
        net["offset"][:] = np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -20, 20)
        return net
    net["offset"][:] = np.log(share / (1 - share))
    m, v, step = {k: 0.0 for k in net}, {k: 0.0 for k in net}, 0
    total = EPOCHS * -(-len(texts) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for i in range(0, len(texts), BATCH):
            pick = order[i : i + BATCH]
            x, row = chunks(pa.array([_crop(texts[j], rng) if labels[j] else texts[j] for j in pick], pa.string()))
            pooled, where = responses(net, x)
            p, features, start, size = combine(net, pooled, row)
            err = ((p - labels[pick]) / len(pick)).astype(np.float32)
            grad = {"weights": features.T @ err, "offset": err.sum(keepdims=True)}
            nth = np.repeat(np.arange(len(size)), size)
            back = err[:, None] * net["weights"]
            dp = back[nth, :FILTERS] / size[nth][:, None]
            dp = dp + back[nth, FILTERS:] * (pooled == features[nth, FILTERS:])
            dp *= pooled > 0
            grad["bias"] = dp.sum(0)
            taps = x[np.arange(len(x))[:, None, None], (where * STRIDE)[:, :, None] + np.arange(WIDTH)]  # chunk, filter, tap
            e = net["bytes"][taps].reshape(len(x), FILTERS, WIDTH * DEPTH)
            grad["filters"] = np.einsum("cf,cfd->df", dp, e)
            de = (dp[:, :, None] * net["filters"].T[None]).reshape(-1, DEPTH)
            grad["bytes"] = np.zeros_like(net["bytes"])
            for k in range(DEPTH):
                grad["bytes"][:, k] = np.bincount(taps.ravel(), de[:, k], 257)
            step += 1
            rate = RATE * (1 - step / (total + 1))
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net[k] = (net[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return net


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE_ROWS) -> Net:
    """Fit on about ``rows`` rows of ``labelled``, chosen by a hash of the id
    among texts of at most SAMPLE_BYTES bytes."""
    usable = labelled.filter(F.col(label_col).isin(0, 1) & (F.octet_length(F.coalesce(text_col, F.lit(""))) <= SAMPLE_BYTES))
    sample = C.some_rows(usable, id_col, rows).select(id_col, F.col(text_col).alias("t"), F.col(label_col).alias("y")).collect()
    sample.sort(key=lambda r: (r[0] is None, r[0], r["t"] or ""))
    return fit([r["t"] or "" for r in sample], np.array([r["y"] for r in sample], np.float64))


def _score(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = held.value
        for b in C.slices(batches, "text", 1 << 20):
            x, row = chunks(b.column(1))
            p, *_ = combine(net, responses(net, x)[0], row)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=[b.schema.names[0], "score"])

    return run


def score(df: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): the probability of label 1 for every row's whole text."""
    held = C.broadcast(df.sparkSession, net)
    return df.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(_score(held), f"`{id_col}` {dict(df.dtypes)[id_col]}, score double")
