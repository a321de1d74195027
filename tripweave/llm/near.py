"""Near-duplicate detection: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, cut_table, free_name, mix, shingle_hashes, text_bytes, text_groups
from .components import components

#: Coordinates of a sketch, and of a band: two sets of similarity 0.8 share no band of 32 with a
#: probability of (1 - 0.8**4)**32 = 5e-8.
COORDINATES = 128
PER_BAND = 4

_EMPTY = np.uint64(2**64 - 1)
_ROUND = np.uint64(0xD1342543DE82EF95)


def sketches(sets: list[np.ndarray], size: int = COORDINATES) -> np.ndarray:
    """The fast similarity sketch of each set of hashes; ``size`` is a power of two.

    In round i of the first ``size`` rounds each element is thrown into one bin by a hash of its
    own for the round; bins that are still empty keep the least hash thrown into them.  Rounds
    beyond throw all elements into bin i - size.  So every coordinate of a non-empty set is filled,
    the first round or two fill nearly all of a large set's, and coordinates agree between two sets
    with a probability of their Jaccard similarity, concentrated as for independent samples.
    """
    out = np.full((len(sets), size), _EMPTY, dtype=np.uint64)
    shift = np.uint64(64 - (size.bit_length() - 1))
    active = np.array([i for i, s in enumerate(sets) if len(s)], dtype=np.int64)
    changed = True
    for turn in range(2 * size):
        if not len(active):
            break
        if changed:
            items = np.concatenate([sets[i] for i in active])
            owner = np.repeat(np.arange(len(active)), [len(sets[i]) for i in active])
        salt = np.uint64(int(_ROUND) * (turn + 1) % 2**64)
        hashed = np.minimum(mix(items + salt), _EMPTY - np.uint64(1))  # never the empty mark
        bins = (hashed >> shift).astype(np.int64) if turn < size else turn - size
        thrown = np.full((len(active), size), _EMPTY, dtype=np.uint64)
        np.minimum.at(thrown.reshape(-1), owner * size + bins, hashed)
        now = out[active]
        out[active] = now = np.where(now == _EMPTY, thrown, now)
        changed = turn < 2 or turn % 16 == 15
        if changed:  # sets whose sketch is full drop out
            active = active[(now == _EMPTY).any(axis=1)]
    return out


def bands(sketch: np.ndarray, per_band: int = PER_BAND) -> np.ndarray:
    """One signed 64-bit hash for each band of consecutive coordinates; the band's place counts."""
    n, size = sketch.shape
    weights = mix(np.arange(1, per_band + 1, dtype=np.uint64) * _ROUND) | np.uint64(1)
    place = mix(np.arange(size // per_band, dtype=np.uint64) + np.uint64(77))
    summed = (sketch.reshape(n, -1, per_band) * weights).sum(axis=2, dtype=np.uint64)
    return mix(summed + place).view(np.int64)


def _signatures(words: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in text_groups(batch.column(1)):
                sets = shingle_hashes(text_bytes(batch.column(1).slice(first, last - first)), words)
                rows = bands(sketches(sets))
                filled = [bool(len(s)) for s in sets]
                digests = [
                    hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                    for s in sets
                ]
                values = pa.array(rows[filled].reshape(-1))
                ends = np.cumsum([0] + [rows.shape[1] * f for f in filled]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first),
                    batch.column(2).slice(first, last - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), values).cast(schema.types[4]),
                ], schema=schema)

    return run


def _similar(words: int, percent: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            linked = np.zeros(batch.num_rows, dtype=bool)
            for first, last in text_groups(batch.column(3)):
                left, right = (text_bytes(batch.column(k).slice(first, last - first)) for k in (2, 3))
                known: dict[bytes, int] = {}
                for t in left:
                    known.setdefault(t, len(known))
                hubs = shingle_hashes(list(known), words)
                others = shingle_hashes(right, words)
                for i, y in enumerate(others, first):
                    x = hubs[known[left[i - first]]]
                    if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y), 1):
                        both = len(x) + len(y) - len(np.union1d(x, y))
                        linked[i] = 100 * both >= percent * (len(x) + len(y) - both)
            keep = pa.array(linked)
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], schema=schema)

    return run


def _differences(words: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in text_groups(batch.column(4)):
                left, right = (text_bytes(batch.column(k).slice(first, last - first)) for k in (3, 4))
                known = {t: k for k, t in enumerate(dict.fromkeys(left))}
                hubs = shingle_hashes(list(known), words)
                others = shingle_hashes(right, words)
                diffs, adds, hub_sizes = [], [], []
                for t, y in zip(left, others, strict=True):
                    x = hubs[known[t]]
                    hub_sizes.append(len(x))
                    added = np.setdiff1d(y, x, assume_unique=True)
                    lost = np.setdiff1d(x, y, assume_unique=True)
                    diffs.append(np.concatenate((added, lost)).view(np.int64))
                    adds.append(len(added))
                part = batch.slice(first, last - first)
                sizes = np.cumsum([0] + [len(d) for d in diffs]).astype(np.int32)
                values = pa.array(np.concatenate(diffs) if diffs else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), part.column(5), part.column(6),
                    pa.array([len(y) for y in others], pa.int64()), pa.array(hub_sizes, pa.int64()),
                    pa.array(adds, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(sizes), values).cast(schema.types[8]),
                ], schema=schema)

    return run


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b, ...) with the texts of a and b."""
    for side, name in (("b", "right"), ("a", "left")):
        held = texts.select(F.col("node").alias(side), F.col("text").alias(name))
        pairs = pairs.join(held.hint("merge"), side)
    return pairs


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = pairs.select("a", "b").schema
    return _with_texts(pairs, texts).select("a", "b", "left", "right").mapInArrow(
        _similar(words, percent, to_arrow_schema(schema)), schema
    )


def links_between(
    tried: DataFrame, found: DataFrame, texts: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links (a, b) between nodes that were compared with the same hub but are in two components.

    Sets are written as their difference from the hub's set, which is short for a near copy.  With
    H the size of the difference between two sets, their similarity is (n + m - H) / (n + m + H),
    so similar sets have H of at most r (n + m), which is at most a bound that follows from either
    size.  Differences of d and e elements must then share k = (d + e - H) / 2 of them, so, in a
    fixed order of elements, the first d - k + 1 of the one and the first e - k + 1 of the other
    share one (prefix filter).  Least k: for the shorter difference d - bound / 2, for the longer
    e - bound; and for a node of the hub's component, as its partner is not similar to the hub and
    has e > r (m + hub's size), more than (d + r (hub's size - n)) / 2.  So two nodes that need not
    share an element are both similar to the hub, and in one component.  Elements that the hub
    lacks come first: they are rare.  A pair whose k is more than the elements of the hub that both
    lack can be must share one that the hub lacks, and meets by those only.  So the pairs that meet
    are few, and those are counted exactly.
    Two nodes that share their largest hub meet with that one only.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    whole = found.select(F.col("node").alias("b"), F.col("component").alias("c"))
    each = tried.unionByName(tried.select("a", F.col("a").alias("b")).distinct()).join(
        whole.hint("merge"), "b", "left"
    ).select("a", "b", F.coalesce("c", "b").alias("c"))
    mixed = each.groupBy("a").agg(
        F.min("c").alias("low"), F.max("c").alias("high"),
        F.max(F.when(F.col("a") == F.col("b"), F.col("c"))).alias("hub_c"),
    ).where("low != high").select("a", "hub_c")
    open_ = cut(each.join(mixed.hint("merge"), "a").where("a != b"))
    groups = open_.groupBy("a").agg(F.count(F.lit(1)).alias("size"))
    main = open_.join(groups.hint("merge"), "a").groupBy("b").agg(
        F.max(F.struct("size", "a")).alias("main")
    ).select("b", F.col("main.a").alias("main"))
    open_ = open_.join(main.hint("merge"), "b")
    kind = tried.schema["a"].dataType.simpleString()
    schema = tried.sparkSession.createDataFrame(
        [], f"a {kind}, b {kind}, c {kind}, with_hub boolean, main {kind}, n bigint, "
            f"hub_n bigint, adds bigint, diff array<bigint>"
    ).schema
    rows = cut(
        _with_texts(open_, texts)
        .select("a", "b", "c", "left", "right", (F.col("c") == F.col("hub_c")).alias("with_hub"),
                "main")
        .mapInArrow(_differences(words, to_arrow_schema(schema)), schema)
    )
    size, bound = F.size("diff"), F.floor(F.col("n") * (100 - percent) / percent).cast("int")
    shared = F.floor(
        (size * (100 + percent) + (F.col("hub_n") - F.col("n")) * (100 - percent))
        / (2 * (100 + percent))
    ).cast("int") + 1
    most = F.when(F.col("with_hub"), F.greatest(size - F.greatest(shared, F.lit(1)) + 1, F.lit(0)))
    narrow = ["a", "b", "c", "main", "n", "adds", F.size("diff").alias("d")]

    def first(length):
        return rows.select(
            *narrow, F.posexplode(F.slice("diff", 1, length)).alias("place", "element")
        )

    short = first(F.least(most, F.floor(bound / 2).cast("int") + 1)).alias("s")
    long = first(F.least(most, bound + 1)).alias("l")
    s, l_ = (lambda c: F.col(f"s.{c}")), (lambda c: F.col(f"l.{c}"))
    common = F.least(s("d") - s("adds"), l_("d") - l_("adds"))  # of the hub's, at most
    enough = (s("d") + l_("d")) * (100 + percent) <= (
        2 * common * (100 + percent) + (s("n") + l_("n")) * (100 - percent)
    )
    meet = short.join(
        long.hint("merge"),
        (s("a") == l_("a")) & (s("element") == l_("element")) & (s("c") != l_("c"))
        & ((s("main") != l_("main")) | (s("main") == s("a")))
        & ((s("place") < s("adds")) | enough)
        & ((s("d") < l_("d")) | ((s("d") == l_("d")) & (s("b") < l_("b"))))
        & (100 * F.least(s("n"), l_("n")) >= percent * F.greatest(s("n"), l_("n")))
        & ((l_("d") - s("d")) * (100 + percent) <= (s("n") + l_("n")) * (100 - percent)),
    ).select(s("a").alias("a"), s("b").alias("x"), l_("b").alias("y")).distinct()
    for side in ("x", "y"):
        meet = meet.join(
            rows.select("a", F.col("b").alias(side), F.col("n").alias(f"n{side}"),
                        F.col("diff").alias(f"d{side}")).hint("merge"), ["a", side]
        )
    apart = F.size("dx") + F.size("dy") - 2 * F.size(F.array_intersect("dx", "dy"))
    total = F.col("nx") + F.col("ny")
    return meet.where(100 * (total - apart) >= percent * (total + apart)).select(
        F.col("x").alias("a"), F.col("y").alias("b")
    )


def _mark(text: str) -> Column:
    """With the id it names a row; rows that repeat both are one document."""
    return F.xxhash64(F.col(text).cast("string"))


def _judged(docs: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """What ``near_copies`` returns, and the mark of each row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"), _mark(text).alias("mark")
    )
    schema = rows.sparkSession.createDataFrame(
        [], f"id {kind}, mark bigint, n_shingles bigint, class binary, bands array<bigint>"
    ).schema
    signed = cut(rows.mapInArrow(_signatures(words, to_arrow_schema(schema)), schema))
    named = signed.where(F.col("class").isNotNull() & F.col("id").isNotNull())
    classes = named.groupBy("class").agg(
        F.min(F.struct("id", "mark")).alias("node"), F.first("bands").alias("bands")
    )
    members = classes.select("node", F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = cut(members.join(sizes.hint("merge"), "band"))
    central = buckets.groupBy("node").agg(F.sum("size").alias("score"))
    hubs = buckets.join(central.hint("merge"), "node").groupBy("band").agg(
        F.max(F.struct("score", "node")).alias("hub")
    ).select("band", F.col("hub.node").alias("hub"))
    met = cut(buckets.drop("size").join(hubs.hint("merge"), "band"))

    needed = met.select(F.col("node.id").alias("id"), F.col("node.mark").alias("mark")).distinct()
    texts = cut_table(
        rows.join(needed.hint("merge"), ["id", "mark"]).groupBy("id", "mark")
        .agg(F.first("text").alias("text")).select(F.struct("id", "mark").alias("node"), "text")
    )
    tried = cut(
        met.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    )
    links = cut(verified(tried, texts, words, percent))
    found = components(links)

    late = links_between(tried, found, texts, words, percent)
    found = components(
        found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late)
    )
    class_of = classes.select("class", "node")
    root = F.coalesce("component", "node")
    return (
        signed.drop("bands").join(class_of.hint("merge"), "class", "left")
        .join(found.hint("merge"), "node", "left")
        .select(
            "id", "mark", "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce(root["id"], "id")).alias("component"),
            # Of classes of one id in a component, the least stays.
            (F.col("id").isNull() | root.isNull() | (
                (F.col("id") == root["id"]) & (F.col("node") == root)
            )).alias("kept"),
        )
    )


def near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
) -> DataFrame:
    """One row per document: id, n_shingles, component (its least id), kept (the id is the component's).

    Two documents are linked if 100 times the number of common shingles is at least ``percent``
    times the number of all.  See ``common.shingle_hashes`` for words and shingles; documents
    without words (or text) are linked with nothing.  A null id is linked with nothing and its row
    kept, with a null component.  A row that repeats an id is judged by its own text, so different
    texts of one id may have different components; of those in one component, one class of equal
    shingle sets is kept.  Other columns are not read.

    1. Texts of equal shingle sets form a class, named by its least row (id, then a hash of the text); only
       that one goes on.
    2. Classes that share a band of their sketches meet in a bucket.  Each is compared on full texts
       with the bucket's hub, the class that shares buckets with most others, so a bucket of n
       classes costs n - 1 comparisons.
    3. Links between classes that met the same hub but are then still in different components are
       found by their differences from it (``links_between``), so none is lost.
    """
    return _judged(docs, doc_id, text, words, percent).drop("mark")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **rule) -> DataFrame:
    """The documents without those that ``near_copies`` does not keep, matched by id and text."""
    gone, content = free_name(docs, "gone_id"), free_name(docs, "gone_mark")
    dropped = _judged(docs, doc_id, text, **{"words": 5, "percent": 80, **rule}).where(
        ~F.col("kept")
    ).select(F.col("id").alias(gone), F.col("mark").alias(content)).distinct()
    same = (F.col(doc_id) == F.col(gone)) & (_mark(text) == F.col(content))
    return docs.join(dropped.hint("merge"), same, "left_anti")
