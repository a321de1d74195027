"""Exact and near deduplication, repeated strings and decontamination against brute force."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripweave.llm import queries, repeats
from tripweave.llm.common import shingle_hashes
from tripweave.llm.components import components
from tripweave.llm.decontaminate import RADIUS, candidates, leaks, shingles_of, words_of as split_words
from tripweave.llm.exact import copies, frequent_digests
from tripweave.llm.near import bands, near_copies, sketches
from tripweave.llm.suffixes import common_prefixes, suffix_order

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def prose(rng, n):
    return [rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(n)]


def table(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) or {tuple(words)}


def brute_components(texts, size, percent):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in texts}


def found(df):
    return {r["id"]: (r["n_shingles"], r["component"]) for r in df.collect()}


def test_near_copies_of_the_test_documents(spark, texts):
    got = {
        r.doc_id: (r.n_shingles, r.component_id) for r in queries.op8_near_dedup(spark, SF_DIR).collect()
    }
    assert got == brute_components(texts, 4, 80)


def test_near_copies_of_edited_families(spark):
    """Copies with so many edits that some are similar to one another but not to the least one."""
    rng = random.Random(4)
    texts, n = {}, 0
    for _ in range(6):
        base = prose(rng, rng.choice([30, 80, 160]))
        family = [base]
        for _ in range(25):
            words = list(rng.choice(family))
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
            family.append(words)
            n += 1
            texts[rng.randrange(10**9)] = " ".join(words)
    want = brute_components(texts, 5, 80)
    assert found(near_copies(table(spark, texts))) == want
    assert len({c for _, c in want.values()}) > 6


def test_sketches_agree_as_often_as_sets():
    rng = np.random.default_rng(1)
    for size in (1, 3, 40, 2_000):
        a = rng.integers(0, 2**63, size, dtype=np.uint64)
        b = np.concatenate((a[: size - size // 4], rng.integers(0, 2**63, size // 4, dtype=np.uint64)))
        x, y = sketches([np.unique(a), np.unique(b)], 1024)
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((x == y).mean() - want) < 0.08
    assert bands(sketches([a])).shape == (1, 32)


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (7, 8), (7, 7), (5, 4)]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r.node, r.component) for r in got} == {(2, 1), (3, 1), (4, 1), (5, 1), (8, 7), (9, 7)}


def test_frequent_digests_are_verified(spark):
    rows = [(i, f"hot{i % 2}" if i % 3 else f"t{i}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "id bigint, digest string")
    counts = Counter(d for _, d in rows)
    got = {d: n for d, n, _ in frequent_digests(df, winners=4, counters=64, least=100)}
    assert got == {d: n for d, n in counts.items() if n >= 100}
    docs = df.withColumnsRenamed({"id": "doc_id", "digest": "text"})
    by = {r["id"]: r for r in copies(docs, winners=4, counters=64, least=100).collect()}
    last = {d: i for i, d in rows}
    assert all(by[i]["keep_id"] == last[d] and by[i]["copies"] == counts[d] for i, d in rows)


def brute_repeats(texts, length):
    seen, out = set(), {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            piece = raw[p:p + length]
            if piece in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(piece)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out[i] = (bytes(c for c, g in zip(raw, gone, strict=True) if not g), spans)
    return out


def test_repeats_of_the_test_documents(spark, texts):
    want = brute_repeats(texts, 100)
    for r in queries.op4_repeats(spark, SF_DIR).collect():
        kept, spans = want[r.doc_id]
        assert (r.n_removed, r.n_spans) == (r.n_bytes - len(kept), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeats_dealt_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PER_ANCHOR", 2)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 500)
    rng = random.Random(8)
    common = "".join(rng.choice("abc") for _ in range(60))
    texts = {i: "".join(rng.choice("abé") for _ in range(rng.randrange(40))) + common
             + "ab" * rng.randrange(60) + common[:rng.randrange(60)] for i in range(40)}
    want = brute_repeats(texts, 30)
    got = repeats.remove_repeats(table(spark, texts), length=30).collect()
    assert {r["id"]: (bytes(r["kept"]), len(r["spans"])) for r in got} == want


@pytest.mark.parametrize("shared", [7, None])
def test_repeats_of_different_texts_under_one_id(spark, shared):
    rng = random.Random(3)
    fresh = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (200, 400, 200, 200)]
    common = "".join(rng.choice("ijklmnop") for _ in range(150))
    rows = [
        (1 if shared else -(2**62), common), (shared, fresh[0] + common), (shared, fresh[1]),
        (shared, fresh[2] + common), (shared, fresh[3] + fresh[3]), (9, common + fresh[1][:120]),
    ]
    mark = F.xxhash64("text")
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    in_order = [r.text for r in df.orderBy(F.col("doc_id").asc_nulls_first(), mark).collect()]
    want = brute_repeats(dict(enumerate(in_order)), 100)  # rows of one id come in the order of their mark
    got = repeats.remove_repeats(df).collect()
    assert sorted(bytes(r["kept"]) for r in got) == sorted(kept for kept, _ in want.values())
    kept = [bytes(r["kept"]).decode() for r in got if r["id"] == shared]
    assert len(kept) == 4 and fresh[1] in kept and fresh[3] in kept
    assert sum(common in bytes(r["kept"]).decode() for r in got) == 1


def in_common(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


@settings(max_examples=300, deadline=None)
@given(st.one_of(
    st.binary(max_size=80), st.text("ab", max_size=120).map(str.encode),
    st.tuples(st.binary(max_size=6), st.integers(0, 40)).map(lambda x: x[0] * x[1]),
))
def test_suffix_order(raw):
    text = np.frombuffer(raw, dtype=np.uint8)
    order = suffix_order(text)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    shared = common_prefixes(text, order)
    for a, b in zip(order[:-1], order[1:], strict=True):
        assert shared[b] == in_common(raw[a:], raw[b:])
    assert not len(raw) or shared[order[0]] == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=300))
def test_suffix_order_of_names(names):
    order = suffix_order(np.array(names, dtype=np.int64))
    assert order.tolist() == sorted(range(len(names)), key=lambda i: names[i:])


def test_suffix_order_recurs_on_names(monkeypatch):
    from tripweave.llm import suffixes

    sizes, rng = [], random.Random(5)
    sort = suffixes.suffix_order
    monkeypatch.setattr(suffixes, "suffix_order", lambda text: sizes.append(len(text)) or sort(text))
    raw = bytes(rng.choice(b"abc") for _ in range(3_000)) * 2
    order = suffixes.suffix_order(np.frombuffer(raw, dtype=np.uint8))
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    assert len(sizes) > 3 and all(2 * b <= a for a, b in zip(sizes[:-1], sizes[1:], strict=True))


def words_of(text):
    return ["".join(c for c in w if c.isalnum()).lower() for w in text.split()]


def test_leaks_against_every_window(spark):
    rng = random.Random(2)
    items = {k: prose(rng, rng.choice([5, 12, 40, 90])) for k in range(12)}
    texts = {}
    for i in range(60):
        item = list(items[rng.randrange(12)])
        for _ in range(rng.randrange(0, 4)):
            if rng.random() < 0.5:
                item[rng.randrange(len(item))] = "other"
            else:
                item.insert(rng.randrange(len(item)), "more")
        texts[i] = " ".join(prose(rng, rng.randrange(30)) + item + prose(rng, rng.randrange(30)))
    want = {}
    for i, text in texts.items():
        w = words_of(text)
        for k, item in items.items():
            theirs = Counter(tuple(item[j:j + 5]) for j in range(len(item) - 4))
            best = 0
            for s in range(max(len(w) - len(item), 0) + 1):
                window = w[s:s + len(item)]
                ours = Counter(tuple(window[j:j + 5]) for j in range(len(window) - 4))
                best = max(best, (ours & theirs).total() / (ours | theirs).total())
            if best >= 0.8:
                want[i, k] = best
    found = leaks(
        table(spark, texts),
        spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id bigint, text string"),
    ).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    assert got == pytest.approx(want) and len(want) > 15
    assert all(r["distance"] <= RADIUS for r in found)


def test_leaks_that_lost_words_in_a_row(spark):
    rng = random.Random(12)
    items, texts, want = {}, {}, {}
    for i in range(360):
        item = prose(rng, rng.choice([50, 94, 150]))
        lost = (len(item) - 4) // 9
        fresh = [f"new{rng.randrange(10**6)}" for _ in range(lost)]
        shared = len(item) - 4 - lost
        words, similarity = [
            (item[:-lost] + fresh, shared / (shared + 2 * lost)),
            (fresh + item[lost:], shared / (shared + 2 * lost)),
            (item[:-(2 * lost - 1)], (shared - lost + 1) / (shared + lost)),
        ][i % 3]
        items[i], texts[i] = " ".join(item), " ".join(words)
        if similarity >= 0.8:
            want[i, i] = similarity
    found = leaks(
        table(spark, texts), spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    ).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    assert got == pytest.approx(want) and len(want) > 250
    by = Counter(r["found_by"] for r in found)
    assert by["blocks"] > 0.8 * len(found) and by["counts"] > 0
    assert all((r["distance"] <= RADIUS) == (r["found_by"] == "blocks") for r in found)


def test_leaks_do_not_join_common_openings(spark):
    opening = "which of the following statements is correct "
    texts = {i: opening + " ".join(f"d{i}x{j}" for j in range(40)) for i in range(400)}
    texts[400] = opening + " ".join(f"i7x{j}" for j in range(30)) + " tail words"
    docs = table(spark, texts)
    items = spark.createDataFrame(
        [(k, opening + " ".join(f"i{k}x{j}" for j in range(30))) for k in range(400)],
        "item_id bigint, text string",
    )
    found = leaks(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["start"], r["similarity"]) for r in found] == [(400, 7, 0, 1.0)]
    grams = items.select(
        F.col("item_id").alias("item"), F.size(split_words(F.col("text"))).alias("size"),
        F.posexplode(shingles_of(split_words(F.col("text")))).alias("at", "gram"),
    )
    places = docs.select(
        F.col("doc_id").alias("doc"), F.lit(b"").alias("digest"),
        F.size(split_words(F.col("text"))).alias("n"),
        F.posexplode(shingles_of(split_words(F.col("text")))).alias("place", "gram"),
    ).join(grams.select("gram").distinct(), "gram")
    assert places.count() == 400 * 3 + 33
    assert [(r["doc"], r["item"]) for r in candidates(places, grams, 400 * 33, 0.8).collect()] == [(400, 7)]


def test_leaks_of_the_test_documents(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    want = {(i, k) for i, t in texts.items() for k, item in items.items() if item in (t or "")}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op3_decontamination(spark, SF_DIR).collect()}
    assert want <= got


def test_shingles_follow_the_definition():
    texts = ["A b\tC  d e", "", "one", "a b c d", "a b c e f g a b c e", "\x1c a\x85b \u00a0"]
    for text, hashed in zip(texts, shingle_hashes([t.encode() for t in texts], 4), strict=True):
        assert len(hashed) == len(shingles(text, 4))
    same = shingle_hashes([b"x a b c d", b"A B c D y z"], 4)
    assert len(np.intersect1d(*same)) == 1


def test_groups_of_a_column_without_its_texts():
    import pyarrow as pa

    from tripweave.llm.common import groups_of, text_bytes, text_groups

    column = pa.array(["é" * 4, None, "", "ab" * 6, "c", None])
    for most in (1, 5, 8, 100):
        assert list(text_groups(column, most)) == list(groups_of(text_bytes(column), most))
    assert list(text_groups(column, 8)) == [(0, 1), (1, 4), (4, 6)]
    assert list(text_groups(pa.array([], pa.string()))) == []
