"""Near-duplicate detection by SimHash fingerprints, looked up in BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import LOWER, cut, groups_of, text_bytes
from .components import components

SEED = 42
#: Fingerprints a tree holds at most (about: they are dealt by hash).
PER_TREE = 8192
#: Rows that a task takes before it plants and searches the trees they are for.
_ROWS = 65_536
_BITS = 64


def fingerprint(text: bytes, words: int = 3) -> int:
    """SimHash of a text's shingles, repeats included: bits set in over half of their XXH64."""
    split = text.translate(LOWER).split()
    if not split:
        return 0
    joined = b" ".join(split)
    sizes = [len(w) + 1 for w in split]
    starts = [0, *accumulate(sizes)]
    ends = starts[words:] if len(split) >= words else [starts[-1]]
    hashes = np.array(
        [xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(starts, ends, strict=False)],
        dtype="<u8",
    )
    held = np.zeros(_BITS, dtype=np.int64)
    for first in range(0, len(hashes), _ROWS):
        raw = hashes[first:first + _ROWS].view(np.uint8).reshape(-1, 8)
        held += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * held > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(words: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for first, last in groups_of(texts):
                found = np.array([fingerprint(t, words) for t in texts[first:last]], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(found.view(np.int64))],
                    schema=schema,
                )

    return run


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bits in which fingerprints differ."""
    return np.bitwise_count(a ^ b).astype(np.int64)


class Trees:
    """BK-trees: a node's children are keyed by their distance to it, one child for each distance.

    ``prints`` come tree by tree; ``firsts`` says where each tree begins, and so which is its root.
    All trees grow at the same time, one level in each round.
    """

    def __init__(self, prints: np.ndarray, firsts: np.ndarray):
        self.prints = prints
        sizes = np.diff(np.append(firsts, len(prints)))
        at = np.repeat(firsts, sizes)
        left = np.setdiff1d(np.arange(len(prints)), firsts, assume_unique=True)
        children, edges = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        while len(left):
            edge = at[left] * (_BITS + 1) + distance(prints[left], prints[at[left]])
            taken, first, which = np.unique(edge, return_index=True, return_inverse=True)
            child = left[first]
            children.append(child)
            edges.append(taken)
            at[left] = child[which]
            left = np.delete(left, first)
        edge, child = np.concatenate(edges), np.concatenate(children)
        order = np.argsort(edge)
        self.edges, self.children = edge[order], child[order]

    def near(self, prints: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple]:
        """Places of prints and of the nodes within the radius of them, level by level.

        A node within r of a print is at a distance of d - r to d + r from any node that is at d
        from the print, so only such edges are followed.
        """
        who, node = np.arange(len(prints)), roots
        while len(who):
            far = distance(prints[who], self.prints[node])
            yield who[far <= radius], node[far <= radius]
            base = node * (_BITS + 1)
            low = np.searchsorted(self.edges, base + np.maximum(far - radius, 0))
            high = np.searchsorted(self.edges, base + np.minimum(far + radius, _BITS), "right")
            number = high - low
            place = np.arange(number.sum()) + np.repeat(low - np.cumsum(number) + number, number)
            who, node = np.repeat(who, number), self.children[place]


def _tie(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give nodes that are linked the same, least label; a label is the place of a node that has it."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label[:] = further


def links(
    tree: np.ndarray, prints: np.ndarray, planted: np.ndarray, radius: int, step: int = 1024
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that link, directly or in steps, what is within the radius in a tree; rows come tree by tree.

    Rows with ``planted`` make up a tree and come first in it.  The others are looked up in it, or,
    if there are none, its own.  Of what is linked in a tree each row but one gives one pair, so
    the pairs are no more than the rows.
    """
    first = np.flatnonzero(np.diff(tree, prepend=tree[0] - 1) != 0) if len(tree) else np.zeros(0, int)
    number = np.cumsum(np.diff(tree, prepend=tree[0] - 1) != 0) - 1 if len(tree) else first
    place = np.flatnonzero(planted)
    new_place = np.cumsum(planted) - 1
    trees = Trees(prints[place], new_place[first])
    all_planted = np.logical_and.reduceat(planted, first) if len(first) else planted
    asked = np.flatnonzero(~planted | all_planted[number])
    label = np.arange(len(prints))
    for begin in range(0, len(asked), step):
        some = asked[begin:begin + step]
        roots = new_place[first[number[some]]]
        for who, node in trees.near(prints[some], roots, radius):
            _tie(label, some[who], place[node])
    tied = np.flatnonzero(label != np.arange(len(label)))
    return prints[tied], prints[label[tied]]


def _links(radius: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(rows: np.ndarray):
            a, b = links(rows[0], rows[1].view(np.uint64), rows[2].astype(bool), radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema
            )

        for batch in batches:
            held.append(np.array([
                batch.column(k).cast(pa.int64()).to_numpy(zero_copy_only=False) for k in range(3)
            ]))
            if sum(x.shape[1] for x in held) >= _ROWS:
                rows = np.concatenate(held, axis=1)
                whole = np.searchsorted(rows[0], rows[0, -1])  # the last tree may go on
                held = [rows[:, whole:]]
                if whole:
                    yield flush(np.ascontiguousarray(rows[:, :whole]))
        if held:
            yield flush(np.ascontiguousarray(np.concatenate(held, axis=1)))

    return run


def near_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints (``print``) that chains within the radius join.

    Fingerprints within the radius agree in one of radius + 1 blocks of bits, so those of equal
    block make up a shard, and a shard has all who can be near.  Shards of more than ``PER_TREE``
    are dealt by hash over several trees; each two of these meet in a task of their own, in which
    one is planted and the other looked up.  So no task holds more than two trees' fingerprints,
    however many a shard has.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    edges = [round(i * _BITS / (radius + 1)) for i in range(radius + 2)]
    blocks = F.array(*[
        F.xxhash64(F.lit(i), F.shiftrightunsigned(F.shiftleft("print", _BITS - high), _BITS - high + low))
        for i, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True))
    ])
    members = prints.select("print", F.explode(blocks).alias("shard"))
    sizes = members.groupBy("shard").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    parts = F.ceil(F.col("size") / F.lit(PER_TREE)).cast("int")
    part = F.pmod(F.xxhash64("print", F.lit("part")), F.col("parts")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(
        F.least("part", other).alias("low"), F.greatest("part", other).alias("high"),
        (F.col("part") <= other).alias("planted"),
    ))
    rows = (
        members.join(sizes.hint("merge"), "shard").withColumn("parts", parts).withColumn("part", part)
        .select("shard", "print", F.explode(meets).alias("x"))
        .select(F.xxhash64("shard", "x.low", "x.high").alias("tree"), "print", "x.planted")
    )
    schema = prints.sparkSession.createDataFrame([], "a bigint, b bigint").schema
    return (
        rows.repartition("tree").sortWithinPartitions("tree", F.desc("planted"))
        .mapInArrow(_links(radius, to_arrow_schema(schema)), schema)
    )


def simhash_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2,
) -> DataFrame:
    """One row per document: id, print (its 64-bit SimHash), component (least id that links lead to).

    Documents are linked if their fingerprints differ in at most ``radius`` bits.  See
    ``fingerprint``: words are runs of other bytes than ASCII white space, A-Z lower-cased;
    shingles of ``words`` of them, joined by one space, count as often as they occur; a text of fewer
    words is one shingle; a text without words, or null, has fingerprint 0 and is linked like any
    other.  Rows that repeat an id are documents of their own.  A null id never names a component: a
    component of null ids only has a null one.  Other columns are not read.

    Equal fingerprints are one from the start; the different ones are linked by ``near_links``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = docs.sparkSession.createDataFrame([], f"id {kind}, print bigint").schema
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    signed = cut(rows.mapInArrow(_fingerprints(words, to_arrow_schema(schema)), schema))
    classes = cut(signed.groupBy("print").agg(F.min("id").alias("least")))
    found = components(near_links(classes.select("print"), radius))
    rooted = classes.join(
        found.withColumnRenamed("node", "print").hint("merge"), "print", "left"
    ).select("print", "least", F.coalesce("component", "print").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of_print = rooted.join(named.hint("merge"), "root").select("print", "component")
    return signed.join(of_print.hint("merge"), "print").select("id", "print", "component")
