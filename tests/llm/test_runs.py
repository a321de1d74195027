"""Periodic runs of words against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripweave.llm import queries
from tripweave.llm.runs import SquareCatcher, find_runs, runs_of

SF_DIR = "/root/testdata/sf0.001"


def brute(w, least_words=6, least_exponent=4):
    """Every maximal stretch with a period, by its least period."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(
        (s, e - s, q) for (s, e), q in found.items() if e - s >= max(least_words, least_exponent * q)
    )


def squares(catcher):
    start, end, period = catcher.runs()
    return list(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True))


@st.composite
def sequences(draw):
    words = draw(st.lists(st.integers(0, draw(st.integers(0, 3))), max_size=90))
    if len(words) > 4 and draw(st.booleans()):
        a, p = draw(st.integers(0, len(words) - 1)), draw(st.integers(1, len(words) // 2))
        words = words[:a] + [words[a + (i - a) % p] if a + p <= len(words) else words[i]
                             for i in range(a, len(words))]
    return words


@settings(max_examples=400, deadline=None)
@given(sequences())
def test_runs(words):
    array = np.array(words, dtype=np.int64)
    assert runs_of(array) == brute(words)
    assert runs_of(array, 1, 2) == brute(words, 1, 2)
    assert runs_of(array, 9, 3) == brute(words, 9, 3)


@settings(max_examples=150, deadline=None)
@given(sequences(), st.lists(st.integers(1, 12)))
def test_words_that_come_one_after_the_other(words, sizes):
    """What is known after each append is what a look at all words so far finds."""
    catcher, at = SquareCatcher(), 0
    for n in [*sizes, len(words)]:
        catcher.append(np.array(words[at:at + n], dtype=np.int64))
        at = min(at + n, len(words))
        assert squares(catcher) == brute(words[:at], 1, 2)


@pytest.mark.parametrize("text", ["a " * 30_000, ("a " * 50 + "b ") * 400, ("a b " * 9 + "c ") * 500])
def test_long_runs_take_no_long_time(text):
    words = np.unique(np.array(text.split()), return_inverse=True)[1]
    found = runs_of(words)
    root = len(set(text.split()))
    assert found[0] == (0, len(words), 1) if root == 1 else len(found) > 400


def looped(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op11_runs(spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    seen = 0
    for d in docs:
        words = looped(d.doc_id, d.text)
        number = {w: i for i, w in enumerate(words)}
        runs = brute([number[w] for w in words]) if len(words) < 1500 else runs_of(
            np.array([number[w] for w in words])
        )
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        row = got[d.doc_id]
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        seen += bool(runs)
    assert seen > 5


def test_odd_documents(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "x " * 50_000), (5, "a b a b a b a b"), (5, "a b"),
        (None, "a a a a a a b"), (None, "é\u00a0é é\u00a0é " * 3), (6, "ha " * 5),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {c: F.lit("x") for c in ("id", "runs", "words", "n", "a", "p", "g", "collapsed")}
    )
    got = [(r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
           for r in find_runs(df).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 50_000, [(0, 50_000, 1)], "x"),
        (5, 8, [(0, 8, 2)], "a b"), (5, 2, [], "a b"), (None, 7, [(0, 6, 1)], "a b"),
        (None, 6, [(0, 6, 1)], "é\u00a0é"), (6, 5, [], "ha ha ha ha ha"),
    ], key=repr)
    assert find_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        find_runs(df, least_exponent=1)
