"""Collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import phrases
from tripweave.llm.phrases import Filter, Fingerprints, Words, collocations, filter_of, phrase_counts

P = 2**61 - 1


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute_counts(rows, longest):
    total, found = Counter(), Counter()
    for _, text, lang in rows:
        for words in pieces(text):
            total[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    found[lang or "und", tuple(words[i:i + m])] += 1
    return total, found


def brute(rows, least, longest, best):
    total, every = brute_counts(rows, longest)
    often = {k: a for k, a in every.items() if a >= least}
    out = {}
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        cuts = [
            (1000 * a * total[lang] // (often[lang, words[:k]] * often[lang, words[k:]]), k)
            for k in range(1, len(words))
        ]
        score, k = min(cuts)
        inside = any(
            other == lang and len(long) > len(words) and f >= a
            and any(long[i:i + len(words)] == words for i in range(len(long)))
            for (other, long), f in often.items()
        )
        if not inside:
            row = (" ".join(words), a, often[lang, words[:k]], often[lang, words[k:]], total[lang], score)
            out.setdefault(lang, []).append(row)
    return sorted(
        (lang, rank, *row) for lang, rows in out.items()
        for rank, row in enumerate(sorted(rows, key=lambda r: (-r[5], -r[1], r[0].encode()))[:best], 1)
    )


def texts(rng, n):
    words = ["the", "The", "of", "new", "york", "city", "a", "été", "x-y", "ha"]
    marks = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "!"]
    rows = []
    for i in range(n):
        text = "".join(
            (rng.choice(["new york city", "ha ha ha ha ha ha", "of the"]) if rng.random() < 0.2
             else rng.choice(words)) + rng.choice(marks) for _ in range(rng.randrange(40))
        )
        rows.append((rng.choice([i, i, None, 3]), text, rng.choice(["en", "en", "fr", None, "und"])))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)


def result(df):
    return sorted(tuple(r) for r in df.drop("first_doc").collect())


@pytest.mark.parametrize("least,longest,best", [(3, 5, 2000), (8, 5, 7), (2, 3, 30), (1, 2, 2000)])
def test_collocations(spark, monkeypatch, least, longest, best):
    monkeypatch.setattr(phrases, "_STEP", 64)  # several parts a text
    rows = texts(random.Random(least), 60)
    want = brute(rows, least, longest, best)
    assert result(collocations(table(spark, rows), least, longest, best)) == want
    assert len(want) > 5


def test_phrases_of_one_fingerprint_are_told_apart(spark, monkeypatch):
    """Eleven fingerprints and filters that let all pass: the counts are those of the texts."""
    of = Fingerprints.of
    monkeypatch.setattr(Fingerprints, "of", lambda *x: of(*x) % np.uint64(11))
    rows = texts(random.Random(5), 40)
    _, every = brute_counts(rows, 4)
    want = {(lang, " ".join(w)): n for (lang, w), n in every.items() if n >= 4}
    got = phrase_counts(table(spark, rows), 4, 4).where("size > 0").collect()
    assert {(r.lang, r.phrase): r["count"] for r in got} == want


def test_the_pointer_is_the_least_document(spark):
    rows = texts(random.Random(6), 50)
    least = {}
    for i, text, lang in rows:
        for words in pieces(text):
            for k in range(len(words) - 1):
                key = (lang or "und", " ".join(words[k:k + 2]))
                if i is not None:
                    least[key] = min(i, least.get(key, i))
                else:
                    least.setdefault(key, 10**9)
    for r in phrase_counts(table(spark, rows), 2, 2).where("size = 2").collect():
        want = least[r.lang, r.phrase]
        assert r.first_doc == (None if want == 10**9 else want)


def test_prefix_polynomials():
    prints = Fingerprints(5)
    words = Words([b"a b\tA b c. a b"] * 50, np.array([0, 1] * 25), ["en", "fr"])
    assert len(words) == 450 and words.phrase(9, 5) == b"a b a b c"
    values = words.prints[words.numbers]
    prefixes = prints.prefixes(values)
    value = values.tolist()
    for size in (1, 2, 5):
        at = np.arange(len(value) - size + 1)
        want = [
            sum(value[i + k] * pow(phrases._BASE, k, P) for k in range(size)) % P for i in at
        ]
        assert prints.of(prefixes, at, size).tolist() == want


def test_filter(spark, monkeypatch):
    keys = spark.range(0, 5000, numPartitions=3).select(F.xxhash64("id").alias("key"))
    values = np.array([r.key for r in keys.collect()], dtype=np.int64).view(np.uint64)
    held = filter_of(keys)
    assert held(values).all()
    assert held(values + np.uint64(1)).mean() < 0.02
    assert not filter_of(keys.limit(0))(values).any()
    monkeypatch.setattr(phrases, "_MOST_BITS", 4096)  # full: lets all pass
    assert filter_of(keys)(values).all() and isinstance(filter_of(keys), Filter)


def test_odd_documents(spark):
    rows = [
        (1, None, "en"), (2, "", None), (3, " . \n", "xx"), (4, "big cat " * 30_000, "en"),
        (5, "A b. a B", None), (5, "a b", "und"), (None, "\ta\tb ", None), (6, "x" * 5000 + " y", "en"),
    ]
    df = table(spark, rows).withColumns(
        {c: F.lit("x") for c in ("id", "key", "n", "phrase", "words", "a", "l", "r", "rank", "part")}
    )
    got = result(collocations(df, 4))
    assert got == brute(rows, 4, 5, 2000)
    assert ("und", 1, "a b", 4, 4, 4, 8, 2000) in got
    assert collocations(df.limit(0), 4).count() == 0


def test_a_size_is_written_at_a_time(spark):
    """Phrases of all sizes of a group are not held together; rows are those of the texts."""
    import pyarrow as pa

    from tripweave.llm import phrases

    class Held:
        value = staticmethod(lambda keys: np.ones(len(keys), dtype=bool))

    schema = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()),
                        ("n", pa.int64()), ("id", pa.int64())])
    batch = pa.RecordBatch.from_arrays([
        pa.array([2, 1, 3], pa.int64()), pa.array(["en", None, "en"]), pa.array(["a b c", "x y", None]),
    ], names=["id", "lang", "text"])
    out = list(phrases._written(3, [Held] * 3, schema)(iter([batch])))
    sizes = [set(b.column(1).to_pylist()) for b in out]
    assert sizes == [{0}, {1}, {2}, {3}]
    found = {tuple(r.values()) for b in out for r in b.to_pylist()}
    assert {(lang, size, p, n) for lang, size, p, n, _ in found if size} == {
        ("en", 1, "a", 1), ("en", 1, "b", 1), ("en", 1, "c", 1), ("und", 1, "x", 1), ("und", 1, "y", 1),
        ("en", 2, "a b", 1), ("en", 2, "b c", 1), ("und", 2, "x y", 1), ("en", 3, "a b c", 1),
    }
    assert {(lang, n) for lang, size, _, n, _ in found if not size} == {("en", 3), ("und", 2)}
    assert {i for _, size, p, _, i in found if size and p[0] in "abc"} == {2}
