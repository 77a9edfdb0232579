"""Metrics: BLEU (M6), chrF (M7, A1), flag (F5), repeated tokens (M5),
readability and complexity (M1-M3, A6). Native formulas are checked
against small plain-Python versions written from the published specs."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from babelframe.functions import ngrams as NG
from babelframe.functions.readability import grade_and_ease
from babelframe.operators import metrics as ME

PUNCT = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


# ------------------------------------------------------------ references
def bleu_ref(hyp: str, ref: str) -> float:
    h, r = hyp.split(), ref.split()
    if not h:
        return 0.0
    ps = []
    for n in range(1, 5):
        hc = Counter(tuple(h[i : i + n]) for i in range(len(h) - n + 1))
        rc = Counter(tuple(r[i : i + n]) for i in range(len(r) - n + 1))
        m = sum(min(c, rc[g]) for g, c in hc.items())
        if n == 1 and m == 0:
            return 0.0
        ps.append(m / max(1, len(h) - n + 1) if m else 2.2250738585072014e-308)
    bp = 1.0 if len(h) > len(r) else math.exp(1 - len(r) / len(h))
    return bp * math.exp(math.fsum(0.25 * math.log(p) for p in ps))


def _toks(s):
    out = []
    for w in s.split():
        if len(w) > 1 and w[-1] in PUNCT:
            out += [w[:-1], w[-1]]
        elif len(w) > 1 and w[0] in PUNCT:
            out += [w[0], w[1:]]
        else:
            out.append(w)
    return out


def chrf_ref(hyp: str, ref: str, lowercase: bool = False) -> float:
    if lowercase:
        hyp, ref = hyp.lower(), ref.lower()
    grams = []
    hc, rc = "".join(hyp.split()), "".join(ref.split())
    for n in range(1, 7):
        grams.append(([hc[i : i + n] for i in range(len(hc) - n + 1)], [rc[i : i + n] for i in range(len(rc) - n + 1)]))
    ht, rt = _toks(hyp), _toks(ref)
    for n in range(1, 3):
        grams.append(
            ([" ".join(ht[i : i + n]) for i in range(len(ht) - n + 1)], [" ".join(rt[i : i + n]) for i in range(len(rt) - n + 1)])
        )
    ps, rs, eff = 0.0, 0.0, 0
    for h, r in grams:
        if h and r:
            m = sum((Counter(h) & Counter(r)).values())
            ps += m / len(h)
            rs += m / len(r)
            eff += 1
    if not eff:
        return 0.0
    p, r = ps / eff, rs / eff
    return 0.0 if p + r == 0 else 100 * (5 * p * r / (4 * p + r))


def score(spark, fn, pairs, **kw):
    df = spark.createDataFrame(pairs, "hyp string, ref string")
    return [r[0] for r in fn(df, "hyp", "ref", "s", **kw).select("s").collect()]


# ------------------------------------------------------------------ BLEU
BLEU_CASES = [
    ("the red kite flies high", "the red kite flies high"),  # identical: 1
    ("a b c d e", "v w x y z"),  # no overlap: 0
    ("red red kite", "red red kite"),  # 3 tokens: ~0 (4-gram rule)
    ("the red kite flies", "the red kite flies over the sea"),  # brevity penalty
    ("", "a b c"),  # empty hypothesis
    ("我爱你", "我爱你"),  # one token
]


def test_bleu_cases(spark):
    got = score(spark, ME.sentence_bleu, BLEU_CASES)
    want = [bleu_ref(h, r) for h, r in BLEU_CASES]
    assert got[0] == pytest.approx(1.0)
    assert got[1] == 0.0
    assert got[2] < 1e-60
    assert 0 < got[3] < 1
    assert got[4] == 0.0
    for g, w in zip(got, want):
        assert g == pytest.approx(w, rel=1e-12, abs=1e-300)


# ------------------------------------------------------------------ chrF
CHRF_CASES = [
    ("a red kite over the sea", "a red kite over the sea"),
    ("xyz", "abc"),
    ("", "a red kite"),
    ("kite", "kite"),
    ("red kite,", "red kite"),
    ("Red Kite", "red kite"),
    ("(hi) there!", "hi there"),
]


def test_chrf_cases(spark):
    got = score(spark, ME.sentence_chrf, CHRF_CASES)
    assert got[0] == pytest.approx(100.0)
    assert got[1] == 0.0
    assert got[2] == 0.0
    assert got[3] == pytest.approx(100.0)
    for g, (h, r) in zip(got, CHRF_CASES):
        assert g == pytest.approx(chrf_ref(h, r), rel=1e-12)
    low = score(spark, ME.sentence_chrf, CHRF_CASES, lowercase=True)
    assert low[5] == pytest.approx(100.0) and got[5] < 100.0


def test_corpus_chrf_single_row_equals_sentence(spark):
    df = spark.createDataFrame([CHRF_CASES[4]], "hyp string, ref string")
    corpus = ME.corpus_chrf(df, "hyp", "ref").first()["chrf"]
    sentence = ME.sentence_chrf(df, "hyp", "ref", "s").first()["s"]
    assert corpus == pytest.approx(sentence)


def test_corpus_chrf_sums_statistics(spark):
    df = spark.createDataFrame(CHRF_CASES, "hyp string, ref string")
    corpus = ME.corpus_chrf(df, "hyp", "ref").first()["chrf"]
    stats = [NG.chrf_stats(h, r) for h, r in CHRF_CASES]
    tot = [sum(s[i] for s in stats) for i in range(24)]
    ps = rs = 0.0
    eff = 0
    for i in range(8):
        h, r, m = tot[3 * i : 3 * i + 3]
        if h > 0 and r > 0:
            ps += m / h
            rs += m / r
            eff += 1
    p, r = ps / eff, rs / eff
    assert corpus == pytest.approx(100 * 5 * p * r / (4 * p + r))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["kite", "red", "a", "sea", "é", "中"]), min_size=0, max_size=12))
def test_chrf_stats_identical_is_perfect(words):
    s = " ".join(words)
    stats = NG.chrf_stats(s, s)
    for i in range(8):
        h, r, m = stats[3 * i : 3 * i + 3]
        assert m == r and (h == r or r == 0)


TEXT = st.text(st.sampled_from("ab .,é中文\u3000\x1c\n'😀"), max_size=25)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), TEXT), st.one_of(st.none(), TEXT)), min_size=1, max_size=8), st.booleans())
def test_batches_count_as_rows_do(pairs, small):
    """Whole batches against counters of single rows, also where the numbers
    of n-grams are packed anew."""
    held = NG._PACKED, NG.BATCH_CHARS
    if small:
        NG._PACKED, NG.BATCH_CHARS = 400, 30
    try:
        chrf = NG.chrf_batch(*zip(*pairs)).tolist()
        words = NG.bleu_batch(*zip(*pairs)).tolist()
        chars = NG.bleu_batch(*zip(*pairs), tokenize="char").tolist()
    finally:
        NG._PACKED, NG.BATCH_CHARS = held

    def match(h, r):
        h, r = Counter(h), Counter(r)
        return [sum(h.values()), sum(r.values()), sum((h & r).values())]

    def grams(x, n):
        return [tuple(x[i : i + n]) for i in range(len(x) - n + 1)]

    for (h, r), got, w, c in zip(pairs, chrf, words, chars):
        h, r = h or "", r or ""
        want = []
        for n, (a, b) in [(n, ("".join(h.split()), "".join(r.split()))) for n in range(1, 7)] + [(n, (_toks(h), _toks(r))) for n in (1, 2)]:
            x = match(grams(a, n), grams(b, n))
            want += [x[0] if x[1] else 0, *x[1:]]
        assert got == want
        for found, (a, b) in ((w, (h.split(), r.split())), (c, ("".join(h.split()), "".join(r.split())))):
            assert found == [len(a), len(b), *[match(grams(a, n), grams(b, n))[2] for n in range(1, 5)]]


def test_bleu_of_characters(spark):
    """Scripts without spaces: 0 by words, perfect by characters."""
    df = spark.createDataFrame([("一只红色的风筝", "一只红色的风筝"), ("赤い凧が空に", "赤い凧が海に")], "hyp string, ref string")
    words = [r["bleu"] for r in ME.sentence_bleu(df, "hyp", "ref").collect()]
    chars = [r["bleu"] for r in ME.sentence_bleu(df, "hyp", "ref", tokenize="char").collect()]
    assert words[0] < 1e-6 and chars[0] == pytest.approx(1.0) and 0 < chars[1] < 1
    with pytest.raises(ValueError):
        NG.bleu_batch(["a"], ["a"], tokenize="bytes")


def test_chrf_flag_threshold_units(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (49.0,), (50.0,)], "s double")
    got = [tuple(r) for r in df.select(ME.chrf_flag("s"), ME.chrf_flag("s", 50.0)).collect()]
    assert got == [(1, 1), (0, 1), (0, 1), (0, 0)]


# ------------------------------------------------------------ repeated tokens
def test_repeated_tokens(spark):
    df = spark.createDataFrame(
        [("the red red car", "le rouge"), ("ha ha ha", "ha"), ("", ""), (None, "x"), ("x", None), ("a  a", "b")],
        "p string, r string",
    )
    got = [r[0] for r in df.select(ME.repeated_tokens("p", "r")).collect()]
    assert got == [True, False, False, False, False, True]


# ------------------------------------------------------------ readability
def readability_ref(text):
    if text is None:
        return 0.0, 0.0
    punct = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    clean = "".join(ch for ch in text if ch not in punct)
    words = clean.split()
    import re

    pieces = re.findall(r"[^.!?]+[.!?]*", text)
    sents = max(1, sum(1 for p in pieces if len("".join(c for c in p if c not in punct).split()) > 2))

    def syl(w):
        w = w.lower()
        g = len(re.findall("[aeiouy]+", w))
        s = 1 if re.search("[^aeiouy]e$", w) else 0
        return max(1, g - s)

    W = len(words)
    Y = sum(syl(w) for w in words)
    wps = W / sents if W else 0.0
    spw = Y / W if W else 0.0
    return 0.39 * wps + 11.8 * spw - 15.59, 206.835 - 1.015 * wps - 84.6 * spw


READ_CASES = [
    "",
    None,
    "The cat sat on the mat.",
    "The cat sat on the mat. A dog ran away fast! Why is the sky so blue?",
    "no final stop here at all",
    "12345 678",
    "Rhythm myths fly by. She gave the cake to Mike, the baker.",
]


def test_readability_matches_reference(spark):
    df = spark.createDataFrame([(t,) for t in READ_CASES], "t string")
    g, e = grade_and_ease("t")
    got = [tuple(r) for r in df.select(g, e).collect()]
    for (gg, ee), t in zip(got, READ_CASES):
        wg, we = readability_ref(t)
        assert gg == pytest.approx(wg, abs=1e-9) and ee == pytest.approx(we, abs=1e-9), t


def test_min_max_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, x double")
    got = [r[0] for r in ME.min_max_scale(df, ["x"]).select("x_norm").collect()]
    assert got == [0.0, 0.0]


def test_complexity_range(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(READ_CASES[2:])], "id int, t string")
    out = ME.add_complexity(df, "t", keep=["id"]).select(F.min("complexity"), F.max("complexity")).first()
    assert 0.0 <= out[0] <= out[1] <= 1.0
