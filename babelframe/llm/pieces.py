"""SentencePiece encoding and decoding with exact N-best segmentations.

The pieces of a SentencePiece model that spell a text form a lattice. Forward
Viterbi scores of every position are exact heuristics for a backward A-star
search from the end of the text, so paths leave the agenda best first and
only what is needed is expanded.

A position that no piece can straddle (no piece has its two neighbouring
characters side by side) is on every path, so a text is a chain of small
lattices (words, or parts of them), which repeat and are looked up. Forward
and backward scores give each one's best path and its cheapest change. The
best paths of the whole text are found by the same backward search over the
chain; a part can differ from its best path only if its change is among the
``n - 1`` cheapest, so only those few parts are searched for their own n
best.

Scores are whole numbers (micro-nats), so sums are exact. A piece model whose
stored scores are log-probabilities uses them (``scores="model"``); the
stored scores of a BPE vocabulary are merge ranks, and a piece of rank r gets
-log(r + 2), the Zipf law of such a list (``scores="zipf"``). Equal scores are
ordered by the ids read from the end.

The format's U+2581 is read as a space, and one space goes in front of the
text. Characters without a piece become byte pieces; so does a U+2581 of the
text itself, and decoding gives back every text exactly. Ids are stored as
little-endian uint32 bytes.

Edge cases: a NULL or empty text has one segmentation without ids; a text
with fewer than n segmentations has fewer rows; repeated rows are encoded
each; a lone surrogate cannot occur in a Spark string.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from babelframe.llm import common as C

NBEST = 3
#: Bytes of each of a worker's caches, and of a batch of texts; only speed and
#: memory depend on them.
CACHE_BYTES, BATCH_BYTES = 144 << 20, 3 << 20
LONG_WORD = 32
SPACE = "▁"
_UNIT = 1_000_000
_ROLL = 0x5851F42D4C957F2D
_NONE = -(1 << 55)
#: Change of a lattice that has one path only.
NO_CHANGE = 1 << 60


@dataclass
class Vocabulary:
    """Pieces (with spaces) by their spelling, with whole-number scores;
    ``byte``: id and score of each byte piece; ``key`` tells vocabularies
    apart in a worker."""

    pieces: dict[str, tuple[int, int]]
    byte: list[tuple[int, int]]
    spelled: dict[int, bytes]
    key: str = ""


def read_vocabulary(path: str, scores: str = "zipf") -> Vocabulary:
    """The pieces of a model file; read on the driver."""
    import sentencepiece

    raw = Path(path).read_bytes()
    model = sentencepiece.SentencePieceProcessor(model_proto=raw)
    pieces, byte, spelled, rank = {}, [(-1, 0)] * 256, {}, 0
    for i in range(model.get_piece_size()):
        text = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        if model.is_byte(i):
            value = int(text[3:-1], 16)
            byte[value] = (i, 0)
            spelled[i] = bytes([value])
            continue
        cost = math.log(rank + 2) if scores == "zipf" else -model.get_score(i)
        rank += 1
        text = text.replace(SPACE, " ")
        pieces[text] = (i, -round(cost * _UNIT))
        spelled[i] = text.encode()
    if min(byte)[0] < 0:
        raise ValueError("the model has no byte pieces")
    least = min((s for _, s in pieces.values()), default=0)
    return Vocabulary(pieces, [(i, least - _UNIT) for i, _ in byte], spelled, f"{hashlib.sha256(raw).hexdigest()}:{scores}")


class Tail:
    """A path from position ``at`` to the end of a lattice. Order: cost, then
    the ids from the end. ``jump`` is a farther node of the path, so that two
    paths find where they part in logarithmic time."""

    __slots__ = ("at", "cost", "depth", "ids", "jump", "rest", "score")

    def __init__(self, cost: int, at: int, score: int, ids: tuple[int, ...], rest: Tail | None):
        self.cost, self.at, self.score, self.ids, self.rest = cost, at, score, ids, rest
        if rest is None:
            self.depth, self.jump = 0, self
        else:
            self.depth = rest.depth + 1
            far = rest.jump
            self.jump = far.jump if rest.depth - far.depth == far.depth - far.jump.depth else rest

    def __lt__(self, other: Tail) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        depth = min(self.depth, other.depth)
        a, b = self.cut(depth), other.cut(depth)
        if a is b:
            return self.depth < other.depth
        while a.rest is not b.rest:
            a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.rest, b.rest)
        return a.ids < b.ids

    def cut(self, depth: int) -> Tail:
        x = self
        while x.depth > depth:
            x = x.jump if x.jump.depth >= depth else x.rest
        return x

    def all_ids(self) -> tuple[int, ...]:
        out, x = [], self
        while x.rest is not None:
            out.extend(x.ids)
            x = x.rest
        return tuple(out)


class Lattices:
    """Lattices of a vocabulary's pieces."""

    def __init__(self, v: Vocabulary):
        self.v = v
        # every beginning of a piece; the value is None if it is no piece itself
        self.starts: dict[str, tuple[int, int, tuple[int, ...]] | None] = {}
        for p, (i, s) in v.pieces.items():
            for n in range(1, len(p)):
                self.starts.setdefault(p[:n], None)
            self.starts[p] = (i, s, (i,))

    def edges(self, text: str) -> list[list[tuple[int, int, tuple[int, ...]]]]:
        """For each end position: (start, score, ids) of the pieces that end there."""
        into: list[list] = [[] for _ in range(len(text) + 1)]
        starts, size = self.starts, len(text)
        for i, c in enumerate(text):
            if starts.get(c) is None:
                raw = c.encode()
                into[i + 1].append((i, sum(self.v.byte[x][1] for x in raw), tuple(self.v.byte[x][0] for x in raw)))
            for j in range(i + 1, size + 1):
                try:
                    found = starts[text[i:j]]
                except KeyError:
                    break
                if found is not None:
                    into[j].append((i, found[1], found[2]))
        return into

    def forward(self, into: list) -> list[int]:
        best = [0]
        for found in into[1:]:
            best.append(max([best[i] + s for i, s, _ in found]))
        return best

    def best(self, text: str) -> tuple[bytes, int, int]:
        """Ids (as bytes) and score of the best path, and what the cheapest
        other path costs more (NO_CHANGE: there is no other)."""
        into = self.edges(text)
        forward = self.forward(into)
        top = forward[-1]
        back: list[int | None] = [None] * len(into)
        back[-1] = 0
        for j in range(len(text), 0, -1):
            if (rest := back[j]) is not None:
                for i, s, _ in into[j]:
                    if back[i] is None or back[i] < s + rest:
                        back[i] = s + rest
        path, j, used = [], len(text), set()
        while j:
            ids, i = min([(ids, i) for i, s, ids in into[j] if forward[i] + s == forward[j]])
            path.append(ids)
            used.add((i, j))
            j = i
        other = [forward[i] + s + back[j] for j in range(1, len(into)) if back[j] is not None for i, s, _ in into[j] if (i, j) not in used]
        ids = [x for ids in reversed(path) for x in ids]
        return np.array(ids, "<u4").tobytes(), top, top - max(other) if other else NO_CHANGE

    def search(self, text: str, n: int) -> list[tuple[int, tuple[int, ...]]]:
        """The n best (score, ids) of a lattice, best first."""
        into = self.edges(text)
        forward = self.forward(into)
        agenda = [Tail(-forward[-1], len(text), 0, (), None)]
        out = []
        while agenda and len(out) < n:
            x = heapq.heappop(agenda)
            if x.at == 0:
                out.append((x.score, x.all_ids()))
                continue
            for i, s, ids in into[x.at]:
                heapq.heappush(agenda, Tail(-(forward[i] + x.score + s), i, x.score + s, ids, x))
        return out


class Batch:
    """Best paths of many short lattices at once, in numpy."""

    def __init__(self, lattices: Lattices):
        rows = {}
        for text, found in lattices.starts.items():
            h = 0
            for c in text:
                h = (h * _ROLL + ord(c) + 1) & (2**64 - 1)
            rows[h] = found
        if len(rows) != len(lattices.starts):
            raise ValueError("two piece beginnings share a hash")
        self.lattices = lattices
        self.keys = np.array(sorted(rows), np.uint64)
        self.id = np.array([-1 if (x := rows[k]) is None else x[0] for k in sorted(rows)], np.int64)
        self.score = np.array([0 if (x := rows[k]) is None else x[1] for k in sorted(rows)], np.int64)
        self.byte = np.array(lattices.v.byte[:128], np.int64)
        self.longest = max(map(len, lattices.v.pieces), default=1)

    def best(self, texts: list[str]) -> list[tuple[bytes, int, int]]:
        """``Lattices.best`` of texts of at most LONG_WORD characters."""
        size = np.array([len(t) for t in texts])
        n, width = len(texts), int(size.max())
        points = np.zeros((n, width), np.uint64)
        inside = np.arange(width) < size[:, None]
        points[inside] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        longest = min(self.longest, width)
        score = np.full((longest + 1, n, width), _NONE, np.int64)
        ids = np.full((longest + 1, n, width), -1, np.int64)
        row, at = np.nonzero(inside)
        h = np.zeros(len(row), np.uint64)
        for m in range(1, longest + 1):
            ok = at + m <= size[row]
            row, at, h = row[ok], at[ok], h[ok]
            h = h * np.uint64(_ROLL) + points[row, at + m - 1] + np.uint64(1)
            k = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            ok = self.keys[k] == h
            row, at, h, k = row[ok], at[ok], h[ok], k[ok]
            piece = self.id[k] >= 0
            score[m, row[piece], at[piece]] = self.score[k[piece]]
            ids[m, row[piece], at[piece]] = self.id[k[piece]]
        row, at = np.nonzero(inside & (ids[1] < 0))
        c = points[row, at].astype(np.int64)
        odd = np.zeros(n, bool)
        odd[row[c >= 128]] = True  # characters of several byte pieces: one by one below
        c = np.minimum(c, 127)
        ids[1, row, at], score[1, row, at] = self.byte[c, 0], self.byte[c, 1]
        forward = np.full((n, width + 1), _NONE, np.int64)
        forward[:, 0] = 0
        for j in range(1, width + 1):
            for m in range(1, min(j, longest) + 1):
                np.maximum(forward[:, j], forward[:, j - m] + score[m, :, j - m], out=forward[:, j])
        every = np.arange(n)
        back = np.full((n, width + 1), _NONE, np.int64)
        back[every, size] = 0
        for i in range(width - 1, -1, -1):
            for m in range(1, min(width - i, longest) + 1):
                np.maximum(back[:, i], score[m, :, i] + back[:, i + m], out=back[:, i])
        place, path = size.copy(), np.full((n, width), -1, np.int64)
        used = np.zeros(score.shape, bool)
        for step in range(width):
            pick, by = np.full(n, 1 << 40), np.zeros(n, np.int64)
            for m in range(1, longest + 1):
                i = np.maximum(place - m, 0)
                fits = (place >= m) & (forward[every, i] + score[m, every, i] == forward[every, place]) & (ids[m, every, i] < pick) & (ids[m, every, i] >= 0)
                pick[fits], by[fits] = ids[m, every, i][fits], m
            on = by > 0
            if not on.any():
                break
            path[on, step] = pick[on]
            place = place - by
            used[by[on], every[on], place[on]] = True
        other = np.full(n, 2 * _NONE, np.int64)
        for m in range(1, longest + 1):
            through = forward[:, : width + 1 - m] + score[m, :, : width + 1 - m] + back[:, m:]
            through[used[m, :, : width + 1 - m]] = 2 * _NONE
            np.maximum(other, through.max(1), out=other)
        top = forward[every, size]
        change = np.where(other > _NONE // 2, top - other, NO_CHANGE).tolist()
        count = (path >= 0).sum(1)
        flat = path[:, ::-1]
        raw = flat[flat >= 0].astype("<u4").tobytes()
        ends = (4 * np.cumsum(count)).tolist()
        out = [(raw[i:j], s, c) for i, j, s, c in zip([0, *ends], ends, top.tolist(), change, strict=False)]
        for i in np.flatnonzero(odd).tolist():
            out[i] = self.lattices.best(texts[i])
        return out


class Spelling:
    """The bytes of every id."""

    def __init__(self, spelled: dict[int, bytes]):
        self.of = [spelled.get(i, b"") for i in range(max(spelled, default=0) + 1)]

    def texts(self, ids: list[bytes]) -> tuple[bytes, list[int]]:
        """The bytes that several segmentations spell, and where each of them ends."""
        flat, at = C.joined(self.of, np.frombuffer(b"".join(ids), "<u4"))
        return bytes(flat), at[np.cumsum([len(x) // 4 for x in ids]).astype(np.int64)].tolist()


class Segmenter:
    """N-best segmentations of whole texts, a batch at a time: the words of
    all its texts are found and told apart in one go, and each distinct one is
    looked up or searched once."""

    def __init__(self, v: Vocabulary, n: int):
        self.lattices, self.n = Lattices(v), n
        self.batch = Batch(self.lattices)
        self.spelling = Spelling(v.spelled)
        # a key, a tuple, two numbers and the ids, with their places in a dict
        self.words = C.Cache(CACHE_BYTES, lambda k, x: 330 + len(k) + len(x[0]))
        self.known = C.Cache(CACHE_BYTES // 2, lambda k, x: 330 + 4 * len(k) + len(x[0]))
        self.searched = C.Cache(CACHE_BYTES // 8, lambda k, x: 400 + 4 * len(k) + sum(200 + len(b) + 8 * len(i) for _, b, i in x))
        inside = sorted({c for p in v.pieces if len(p) > 1 for c in p})
        self.place = np.zeros(0x110000, np.int16)
        for i, c in enumerate(inside):
            self.place[ord(c)] = i + 1
        self.side = np.zeros((len(inside) + 1, len(inside) + 1), bool)
        self.pairs = {p[i : i + 2] for p in v.pieces for i in range(len(p) - 1)}
        for a, b in self.pairs:
            self.side[self.place[ord(a)], self.place[ord(b)]] = True
        #: spaces begin words if no piece has another character before one
        self.spaced = not any(x[1] == " " != x[0] for x in self.pairs)

    def parts(self, texts: list[str]) -> list[list[str]]:
        """Each text cut where no piece has the two characters side by side."""
        joined = "".join(texts)
        x = self.place[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
        ends = np.cumsum([len(t) for t in texts])
        cut = np.ones(len(x) + 1, bool)
        cut[1:-1] = ~self.side[x[:-1], x[1:]]
        cut[ends] = True
        at = np.flatnonzero(cut)
        last = np.searchsorted(at, ends).tolist()
        at = at.tolist()
        pieces = [joined[i:j] for i, j in pairwise(at)]
        return [pieces[i:j] for i, j in zip([0, *last], last, strict=False)]

    def of_parts(self, parts: list[str]) -> dict[str, tuple[bytes, int, int]]:
        """``Lattices.best`` of distinct parts."""
        self.known.turn()
        new = self.known.split(parts)
        short = sorted((p for p in new if len(p) <= LONG_WORD), key=len)
        for i in range(0, len(short), 2048):
            self.known.put(short[i : i + 2048], self.batch.best(short[i : i + 2048]))
        own = {p: self.lattices.best(p) for p in new if len(p) > LONG_WORD}
        young = self.known.young
        return {p: own[p] if p in own else young[p] for p in parts}

    def of_words(self, words: list[bytes]) -> list[tuple[bytes, int, int]]:
        """Ids and score of the best path of distinct words, and its cheapest change."""
        self.words.turn()
        new = self.words.split(words)
        if not new:
            return list(map(self.words.young.__getitem__, words))
        split = self.parts([w.decode() for w in new])
        known = self.of_parts(list({p for ps in split for p in ps}))
        found = []
        for ps in split:
            if len(ps) == 1:
                found.append(known[ps[0]])
            else:
                ids, scores, changes = zip(*[known[p] for p in ps], strict=True)
                found.append((b"".join(ids), sum(scores), min(changes)))
        short = [i for i, w in enumerate(new) if len(w) <= 4 * LONG_WORD]
        self.words.put([new[i] for i in short], [found[i] for i in short])
        young = self.words.young
        if len(short) == len(new):
            return list(map(young.__getitem__, words))
        own = dict(zip(new, found, strict=True))
        return [own[w] if w in own else young[w] for w in words]

    def n_best(self, part: str) -> list[tuple[int, bytes, tuple[int, ...]]]:
        if self.searched.split([part]):
            best = self.lattices.search(part, self.n)
            self.searched.put([part], [[(s, np.array(ids, "<u4").tobytes(), ids[::-1]) for s, ids in best]])
        return self.searched.young[part]

    def best(self, texts: pa.Array) -> list[list[tuple[int, bytes]]]:
        """The n best (score, ids) of each whole text, best first."""
        self.searched.turn()
        some = pc.greater(pc.binary_length(texts), 0)
        raw, rows = C.text_bytes(pc.if_else(some, pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar("")), texts))
        cut = np.zeros(len(raw) + 1, bool)
        if self.spaced:
            blank = raw == 0x20
            cut[1:-1] = blank[1:] & ~blank[:-1]
        cut[rows] = True
        edges = np.flatnonzero(cut)
        start = edges[:-1]
        words, which = C.distinct_spans(raw, start, edges[1:])
        found = self.of_words(words)
        held, ends = C.joined([x[0] for x in found], which)  # bytes of ids up to each word
        flat = bytes(held)
        scores = np.zeros(len(which) + 1, np.int64)
        np.cumsum(np.array([x[1] for x in found], np.int64)[which], out=scores[1:])
        first = np.searchsorted(start, rows)  # the first word of each text
        out: list[list[tuple[int, bytes]]] = [
            [(s, flat[i:j])] for s, i, j in zip(np.diff(scores[first]).tolist(), ends[first[:-1]].tolist(), ends[first[1:]].tolist(), strict=True)
        ]
        if self.n == 1 or not len(which):
            return out
        # the words that may change: those whose change is among the n - 1 cheapest of their text
        change = np.array([x[2] for x in found], np.int64)[which]
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        cheap = change[np.lexsort((change, text))]
        last = first[:-1] + self.n - 2
        most = np.where(last < first[1:], cheap[np.minimum(last, len(cheap) - 1)], NO_CHANGE)
        at = np.flatnonzero((change <= most[text]) & (change < NO_CHANGE))
        bounds = np.searchsorted(text[at], np.arange(len(texts) + 1)).tolist()
        at_list, most = at.tolist(), most.tolist()
        for row, (i, j) in enumerate(pairwise(bounds)):
            if i < j:
                places = at_list[i:j]
                spelled = {p: words[which[p]].decode() for p in places}
                self._changed(out[row], places, spelled, most[row], flat, ends, int(first[row]), int(first[row + 1]))
        return out

    def _changed(self, result: list, places: list[int], spelled: dict[int, str], most: int, flat: bytes, ends: np.ndarray, begin: int, stop: int) -> None:
        """Adds the other paths of a text, whose words are ``begin`` to
        ``stop``, to its best one; ``places``: the words that may change."""
        total = result[0][0]
        # changes of one part each, in the order of the whole paths they give
        changes, split = [], {}
        for at in places:
            w = spelled[at]
            if w not in split:
                known = self.of_some(self.parts_of(w))
                split[w] = [(p, self.n_best(p) if found[2] <= most else None, found[0]) for p, found in known]
            for nth, (_, best, _) in enumerate(split[w]):
                for k, (s, _, back) in enumerate((best or ())[1:], 1):
                    lower = back < best[0][2]
                    place = (at, nth)
                    changes.append((best[0][0] - s, not lower, (-at, -nth) if lower else place, back, place, k))
        changes = heapq.nsmallest(self.n - 1, changes)
        touched = sorted({c[4] for c in changes}, reverse=True)
        options = {x: [(0, split[spelled[x[0]]][x[1]][1][0][2], 0), *((c[0], c[3], c[5]) for c in changes if c[4] == x)] for x in touched}
        # the backward search over the touched parts; order: cost, then ids from the end
        agenda: list[tuple[int, tuple, tuple[int, ...]]] = [(0, (), ())]
        paths = []
        while agenda and len(paths) < self.n:
            cost, order, picked = heapq.heappop(agenda)
            if len(picked) == len(touched):
                paths.append((cost, picked))
                continue
            for more, back, k in options[touched[len(picked)]]:
                heapq.heappush(agenda, (cost + more, (*order, back), (*picked, k)))
        changed = sorted({x[0] for x in touched})
        for cost, picked in paths[1:]:
            chosen = dict(zip(touched, picked, strict=True))
            out, done = [], int(ends[begin])
            for at in changed:
                out.append(flat[done : int(ends[at])])
                out += [best[chosen[at, nth]][1] if (at, nth) in chosen else own for nth, (_, best, own) in enumerate(split[spelled[at]])]
                done = int(ends[at + 1])
            out.append(flat[done : int(ends[stop])])
            result.append((total - cost, b"".join(out)))

    def of_some(self, parts: list[str]) -> list[tuple[str, tuple[bytes, int, int]]]:
        """``Lattices.best`` of a few parts, one by one."""
        held = [self.known.young.get(p) or self.known.old.get(p) or self.lattices.best(p) for p in parts]
        return list(zip(parts, held, strict=True))

    def parts_of(self, word: str) -> list[str]:
        """``parts`` of one word."""
        out, last, pairs = [], 0, self.pairs
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in pairs:
                out.append(word[last:i])
                last = i
        out.append(word[last:])
        return out


#: The segmenters that this worker process has used.
_SEGMENTERS: dict[tuple[str, int], Segmenter] = {}


def segmenter_of(v: Vocabulary, n: int) -> Segmenter:
    if (v.key, n) not in _SEGMENTERS:
        _SEGMENTERS[v.key, n] = Segmenter(v, n)
    return _SEGMENTERS[v.key, n]


def _repeated(b: pa.RecordBatch, best: list[list], columns: list[int]) -> list[pa.Array]:
    """The given columns once for each segmentation, with its rank and score."""
    row = pa.array(np.repeat(np.arange(b.num_rows), [len(x) for x in best]))
    ranks = pa.array([k for x in best for k in range(1, len(x) + 1)], pa.int32())
    return [*(b.column(c).take(row) for c in columns), ranks, pa.array([s / _UNIT for x in best for s, _ in x], pa.float64())]


def _encoded(held, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = segmenter_of(held.value, n)
        for b in C.slices(batches, "__text", BATCH_BYTES):
            at = b.schema.get_field_index("__text")
            best = segmenter.best(b.column(at))
            columns = _repeated(b, best, [c for c in range(b.num_columns) if c != at])
            yield pa.RecordBatch.from_arrays([*columns, pa.array([i for x in best for _, i in x], pa.binary())], names=[f"c{i}" for i in range(len(columns) + 1)])

    return run


def encode(
    df: DataFrame, vocabulary: Vocabulary, n: int = NBEST, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(id, *keep, rank, score, ids): the n best segmentations of every whole
    text. Kept columns called like one of the results get a final ``_``."""
    held = C.broadcast(df.sparkSession, vocabulary)
    own = ["rank", "score", "ids"]
    names = [f"{c}_" if c in own else c for c in (id_col, *keep)]
    docs = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate((id_col, *keep))], F.col(text_col).alias("__text"))
    kinds = [t for n, t in docs.dtypes if n != "__text"]
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate([*kinds, "int", "double", "binary"]))
    return docs.mapInArrow(_encoded(held, n), schema).toDF(*names, *own)


def _digested(held, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = segmenter_of(held.value, n)
        for b in C.slices(batches, "text", BATCH_BYTES):
            best = segmenter.best(b.column(1))
            ids = [i for x in best for _, i in x]
            # decoded, each of them, and compared with the text
            decoded, ends = segmenter.spelling.texts(ids)
            texts = [t for x, t in zip(best, b.column(1).cast(pa.binary()).to_pylist(), strict=True) for _ in x]
            same = [decoded[i + 1 : j] == t for i, j, t in zip([0, *ends], ends, texts, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    *_repeated(b, best, [0]),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array(same, pa.bool_()),
                ],
                names=["id", "rank", "score", "n_ids", "ids_crc32", "round_trip"],
            )

    return run


def digests(df: DataFrame, vocabulary: Vocabulary, n: int = NBEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, rank, score, n_ids, ids_crc32, round_trip) of the n best
    segmentations of every whole text, encoded and decoded in one pass;
    ``round_trip`` tells whether decoding gives the text back."""
    held = C.broadcast(df.sparkSession, vocabulary)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {dict(docs.dtypes)['id']}, rank int, score double, n_ids long, ids_crc32 long, round_trip boolean"
    return docs.mapInArrow(_digested(held, n), schema).withColumnRenamed("id", id_col)


def decode_ids(ids: bytes, spelled: dict[int, bytes]) -> str:
    text = b"".join(map(spelled.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()
    return text[1:]


def _decoded(held, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = Spelling(held.value)
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                ids = [x or b"" for x in b.column(at).to_pylist()]
                raw, ends = spelling.texts(ids)
                null = b.column(at).is_null().to_pylist()
                texts = [None if no else raw[i + 1 : j].decode() for no, i, j in zip(null, [0, *ends], ends, strict=False)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[f"c{i}" for i in range(b.num_columns + 1)])

    return run


def decode(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``df`` (with ``ids``) plus ``decoded``, the exact text; a column of
    that name gets a final ``_``."""
    held = C.broadcast(df.sparkSession, vocabulary.spelled)
    schema = ", ".join(f"c{i} {t}" for i, t in enumerate([*[t for _, t in df.dtypes], "string"]))
    names = [f"{c}_" if c == "decoded" else c for c in df.columns]
    numbered = df.toDF(*[f"c{i}" for i in range(len(names))])
    return numbered.mapInArrow(_decoded(held, df.columns.index("ids")), schema).toDF(*names, "decoded")
