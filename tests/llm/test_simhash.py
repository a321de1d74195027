"""SimHash, BK-trees and the components they link, against brute force."""

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripweave.llm import queries, simhash
from tripweave.llm.simhash import Trees, fingerprint, links, near_links, simhash_copies

SF_DIR = "/root/testdata/sf0.001"


def brute_print(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, radius):
    """The least place that links lead to."""
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def family(rng, n, flips):
    base = rng.getrandbits(64)
    out = {base}
    while len(out) < n:
        x = base
        for _ in range(rng.randrange(1, flips + 1)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return list(out)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@settings(max_examples=100, deadline=None)
@given(st.text("ab é\n", max_size=60), st.integers(1, 4))
def test_fingerprint(text, size):
    assert fingerprint(text.encode(), size) == brute_print(text, size)


def test_fingerprint_is_sparks_hash(spark):
    one = spark.range(1).select(F.xxhash64(F.lit("a b ç")).alias("h")).first().h
    assert fingerprint("A b  ç".encode()) == one % 2**64


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_trees_find_all_within_the_radius(radius):
    rng = random.Random(radius)
    groups = [family(rng, 40, 4), [rng.getrandbits(64) for _ in range(60)], family(rng, 1, 1)]
    prints = np.array([p for g in groups for p in g], dtype=np.uint64)
    firsts = np.array([0, 40, 100])
    trees = Trees(prints, firsts)
    assert len(trees.children) == len(prints) - 3
    for g, first in zip(groups, firsts, strict=True):
        asked = np.array(g + family(rng, 20, 3) + [g[0] ^ 5], dtype=np.uint64)
        got = {(int(w), int(n)) for who, node in trees.near(asked, np.full(len(asked), first), radius)
               for w, n in zip(who, node, strict=True)}
        assert got == {(i, first + j) for i, x in enumerate(asked.tolist()) for j, y in enumerate(g)
                       if (x ^ y).bit_count() <= radius}


def test_links_are_few_and_enough():
    rng = random.Random(4)
    prints = family(rng, 300, 3) + [rng.getrandbits(64) for _ in range(50)]
    array = np.array(prints, dtype=np.uint64)
    a, b = links(np.zeros(len(prints), dtype=np.int64), array, np.ones(len(prints), dtype=bool), 2, 64)
    want = brute_classes(prints, 2)
    assert len(a) == len(prints) - len(set(want))
    place = {p: i for i, p in enumerate(prints)}
    assert all(want[place[x]] == want[place[y]] for x, y in zip(a.tolist(), b.tolist(), strict=True))


def classes_of(spark, prints, radius):
    df = spark.createDataFrame([(signed(p),) for p in prints], "print bigint").repartition(3)
    found = near_links(df, radius).collect()
    label = {signed(p): signed(p) for p in prints}
    for r in found:
        low, high = sorted((label[r.a], label[r.b]))
        label = {k: low if v == high else v for k, v in label.items()}
    return len(found), [label[signed(p)] for p in prints]


@pytest.mark.parametrize("per_tree", [8192, 16])
def test_shards_of_many_trees(spark, monkeypatch, per_tree):
    monkeypatch.setattr(simhash, "PER_TREE", per_tree)
    monkeypatch.setattr(simhash, "_ROWS", 100)
    rng = random.Random(9)
    prints = [p for n in (150, 30, 2) for p in family(rng, n, 3)]
    prints += [rng.getrandbits(64) for _ in range(60)]
    for radius in (2, 0, 3):
        _, got = classes_of(spark, prints, radius)
        want = brute_classes(prints, radius)
        assert [got.index(x) for x in got] == [want.index(x) for x in want]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    prints = [brute_print(d.text) for d in docs]
    want = brute_classes(prints, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op13_simhash(spark, SF_DIR).collect()}
    assert got == {d.doc_id: (f"{prints[i]:016x}", docs[want[i]].doc_id) for i, d in enumerate(docs)}
    assert len(set(want)) < len(docs)


def test_odd_documents(spark):
    rows = [
        (4, None), (2, ""), (3, " \n"), (None, None), (5, "One two three"), (6, "one  two THREE"),
        (6, "w " * 40_000), (None, "é b"), (8, "é b"), (None, "alone here"), (None, "alone here"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {c: F.lit("x") for c in ("id", "print", "component", "least", "root", "tree", "shard")}
    )
    got = sorted(((r["id"], r["component"]) for r in simhash_copies(df).collect()), key=repr)
    assert got == sorted([
        (4, 2), (2, 2), (3, 2), (None, 2), (5, 5), (6, 5), (6, 6), (None, 8), (8, 8), (None, None),
        (None, None),
    ], key=repr)
    assert simhash_copies(df.limit(0)).count() == 0
