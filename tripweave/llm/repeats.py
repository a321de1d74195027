"""Removal of repeated byte strings: shards of a suffix array, laid out by anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, cut_table, groups_of, text_bytes, word_hashes
from .suffixes import common_prefixes, suffix_order

LENGTH = 100
#: Bytes of a gram; the least hash among the grams of a string of LENGTH bytes is its anchor.
GRAM = 32
#: Bytes of segments that a shard's suffix array is built of, about.
SHARD_BYTES = 2_000_000
#: Segments of one anchor in one shard, at most; those of more are dealt over several shards.
PER_ANCHOR = 5_000


def _anchored(length: int, gram: int, schema: pa.Schema):
    """Rows of segments: maximal runs of strings of one document with the same anchor.

    A segment that a task has seen before, at a place not later, goes along with the first one as
    one of its ``again``, so a task sends each segment once.
    """
    width = length - gram + 1

    def segments(data: np.ndarray, sizes: np.ndarray):
        n = len(data)
        empty = np.zeros(0, dtype=np.int64)
        if n < length:
            return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
        at = np.arange(n - gram + 1)
        grams = word_hashes(data, at, at + gram)
        bits = np.uint64(n.bit_length())
        least = ((grams >> bits) << bits) | at.astype(np.uint64)
        reach = 1
        while 2 * reach <= width:
            least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
        if reach < width:
            more = width - reach
            least = np.minimum(least[:-more], least[more:])
        anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        end = np.repeat(np.cumsum(sizes), sizes)
        start = np.flatnonzero(np.arange(len(anchor)) + length <= end[:len(anchor)])
        if not len(start):
            return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
        anchor = anchor[start]
        new = np.flatnonzero(np.concatenate((
            [True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        )))
        first, count = start[new], np.diff(np.append(new, len(start)))
        content = word_hashes(data, first, first + count + length - 1)
        doc = np.searchsorted(np.cumsum(sizes), first, side="right")
        return doc, first, count, grams[anchor[new]], content

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for a, b in groups_of(texts, 1_000_000):
                sizes = np.array([len(t) for t in texts[a:b]], dtype=np.int64)
                data = np.frombuffer(b"".join(texts[a:b]), dtype=np.uint8)
                doc, first, count, anchor, content = segments(data, sizes)
                offset = first - (np.cumsum(sizes) - sizes)[doc]
                ids = batch.column(0).slice(a, b - a)
                marks = batch.column(2).slice(a, b - a)
                place = np.array(ids.fill_null(-(2**63)))[doc] if len(doc) else doc
                mark = np.array(marks)[doc] if len(doc) else doc
                order = np.lexsort((offset, mark, place, content, anchor))
                doc, offset, count = doc[order], offset[order], count[order]
                anchor, content = anchor[order], content[order]
                lead = np.flatnonzero(np.concatenate((
                    [True] * bool(len(doc)),
                    (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]),
                ))).astype(np.int64)
                which = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(doc))))
                at = lead[which]
                # A row given twice does not come after itself.
                place, mark = place[order], mark[order]
                rest = (place != place[at]) | (mark != mark[at]) | (offset != offset[at])
                others = np.bincount(which[rest], minlength=len(lead))
                again = pa.StructArray.from_arrays(
                    [ids.take(pa.array(doc[rest])), marks.take(pa.array(doc[rest])),
                     pa.array(offset[rest])],
                    ["id", "mark", "start"],
                )
                bounds = np.concatenate(([0], np.cumsum(others))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(anchor[lead].view(np.int64)), pa.array(content[lead].view(np.int64)),
                    ids.take(pa.array(doc[lead])), marks.take(pa.array(doc[lead])),
                    pa.array(offset[lead]),
                    pa.array(count[lead], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(bounds), again.cast(schema.types[6].value_type),
                        mask=pa.array(others == 0),
                    ).cast(schema.types[6]),
                ], schema=schema)

    return run


def _cut_out(length: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for k in range(batch.num_rows):
                found = batch.column(2)[k].values
                start = np.array(found.field("start"))
                count = np.array(found.field("count"))
                kept = start + count + length - 1 <= len(texts[k])
                picked = found.filter(pa.array(kept))
                parts = [
                    texts[k][s:s + c + length - 1]
                    for s, c in zip(start[kept].tolist(), count[kept].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([
                    picked.field("shard"), picked.field("part"), picked.field("parts"),
                    pa.array([batch.column(0)[k].as_py()] * len(parts), schema.types[3]),
                    pa.array([batch.column(3)[k].as_py()] * len(parts), pa.int64()),
                    picked.field("start"), pa.array(parts, pa.binary()),
                ], schema=schema)

    return run


def _shard(length: int, schema: pa.Schema):
    """The classes of equal strings of one shard: which strings come later than another of them.

    Rows (id, mark, start, count, digest): runs of strings that do, with a null digest; and, for segments
    of anchors that are dealt over several shards, the first string of each class with its digest.
    """
    def run(group: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.lexsort((
            np.array(group.column("start")), np.array(group.column("mark")),
            np.array(group.column("id").combine_chunks().fill_null(-(2**63))),
        ))))
        parts = [bytes(x) for x in group.column("bytes").to_pylist()]
        sizes = np.array([len(p) for p in parts])
        raw = b"".join(parts)
        text = np.frombuffer(raw, dtype=np.uint8)
        order = suffix_order(text)
        owner = np.repeat(np.arange(len(parts)), sizes)
        ends = np.cumsum(sizes)
        classes = np.cumsum(common_prefixes(text, order)[order] < length)
        whole = order + length <= ends[owner[order]]  # where a whole string begins
        at, classes = order[whole], classes[whole]
        by = np.lexsort((at, classes))  # segments are in the order of their documents
        at, classes = at[by], classes[by]
        first = np.concatenate(([True] * bool(len(at)), classes[1:] != classes[:-1]))
        starts = np.array(group.column("start"))
        ids, marks = group.column("id").combine_chunks(), group.column("mark").combine_chunks()
        begin = ends - sizes
        home = starts[owner[at]] + at - begin[owner[at]]
        # The same string at the same place (a row given twice) does not come after itself.
        origin = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        number = np.array(ids.fill_null(-(2**63)))[owner[at]] if len(at) else at
        mark = np.array(marks)[owner[at]] if len(at) else at
        same_place = (
            (home == home[origin]) & (number == number[origin]) & (mark == mark[origin])
        )
        later = np.zeros(len(text), dtype=bool)
        later[at[~first & ~same_place]] = True
        # Runs do not cross segments, as the last length - 1 bytes of one begin no whole string.
        edge = np.flatnonzero(np.diff(np.concatenate(([False], later, [False])).astype(np.int8)))
        a, b = edge[::2], edge[1::2]
        dealt = np.array(group.column("parts"))[owner[at]] > 1
        lead = at[first & dealt]
        rows = np.concatenate((owner[a], owner[lead])).astype(np.int64)
        return pa.Table.from_arrays([
            ids.take(pa.array(rows)), marks.take(pa.array(rows)),
            pa.array(starts[rows] + np.concatenate((a, lead)) - begin[rows]),
            pa.array(np.concatenate((b - a, np.ones(len(lead), np.int64)))),
            pa.array([None] * len(a) + [
                hashlib.blake2b(raw[s:s + length], digest_size=16).digest() for s in lead.tolist()
            ], pa.binary()),
        ], schema=schema)

    return run


def _without(length: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for first in range(0, batch.num_rows, 64):
                out = []
                part = batch.slice(first, 64)
                for text, found in zip(texts[first:first + 64], part.column(2), strict=True):
                    spans: list[list[int]] = []
                    runs = found.as_py() or []
                    for s, c in sorted((r["start"], r["count"]) for r in runs):
                        e = min(s + c + length - 1, len(text))
                        if spans and s <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], e)
                        elif s < e:
                            spans.append([s, e])
                    kept, at = [], 0
                    for s, e in spans:
                        kept.append(text[at:s])
                        at = e
                    kept.append(text[at:])
                    out.append((len(text), spans, b"".join(kept)))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([x[0] for x in out], pa.int64()),
                    pa.array([[{"start": s, "end": e} for s, e in x[1]] for x in out], schema.types[2]),
                    pa.array([x[2] for x in out], pa.binary()),
                ], schema=schema)

    return run


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
) -> DataFrame:
    """One row per document: id, n_bytes, spans (start and end of what goes), kept (bytes).

    Texts are UTF-8 bytes; null counts as empty.  A byte goes if a string of ``length`` bytes that
    covers it also starts earlier: in a document of smaller id, or earlier in the same one.  Strings
    do not cross documents and are judged on the input.  Null ids come before all others.  Rows that
    repeat both id and text count as one document seen more than once; rows of different texts under
    one id (or null) are documents of their own, in the order of a hash of their text, the row's
    ``mark``.  Other columns are not read.

    1. The anchor of a string is its gram of least hash, so equal strings have equal anchors.  Each
       document is cut into segments: runs of strings of the same anchor.
    2. Of equal segments all but the first go.  An anchor that has just one segment needs no more.
    3. The other anchors' segments (one of each content) are dealt by anchor into shards.  A shard's
       suffix array is built by induced sorting; neighbours with ``length`` bytes in common are
       equal strings, of which all but the first go.  Segments of an anchor of very many are dealt
       over several shards, and the first strings of each then compared by digest.
    4. Each document's spans are merged and cut out.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).withColumn(
        "mark", F.xxhash64("text")
    )

    def declared(ddl: str):
        schema = spark.createDataFrame([], ddl).schema
        return schema, to_arrow_schema(schema)

    schema, arrow = declared(
        f"anchor bigint, content bigint, id {kind}, mark bigint, start bigint, count bigint, "
        f"again array<struct<id:{kind},mark:bigint,start:bigint>>"
    )
    found = rows.mapInArrow(_anchored(length, min(GRAM, length), arrow), schema)
    same = Window.partitionBy("anchor", "content")
    alike = Window.partitionBy("anchor")
    ranked = (
        found.repartition("anchor")
        .withColumn("rank", F.rank().over(same.orderBy("id", "mark", "start")))
        .withColumn("lead", (F.row_number().over(same.orderBy("id", "mark", "start")) == 1).cast("int"))
        .withColumn("contents", F.sum("lead").over(alike))
    )
    segments = cut_table(
        ranked.where("rank > 1 or contents > 1 or again is not null")
        .select("anchor", "content", "id", "mark", "start", "count", "again", "contents",
                (F.col("rank") > 1).alias("goes"),
                ((F.col("lead") == 1) & (F.col("contents") > 1)).alias("open"))
    )
    sure = segments.where("goes").select("id", "mark", "start", "count").unionByName(
        segments.where("again is not null").select(F.explode("again").alias("x"), "count")
        .select("x.id", "x.mark", "x.start", "count")
    )

    open_ = segments.where("open")
    total = open_.agg(F.sum(F.col("count") + length)).first()[0] or 0
    shards = int(total // SHARD_BYTES) + 1
    parts = F.ceil(F.col("contents") / F.lit(PER_ANCHOR)).cast("int")
    part = F.pmod(F.xxhash64("content", F.lit("part")), parts)
    wanted = open_.select(
        "id", "mark",
        F.struct(
            "start", "count",
            F.pmod(F.xxhash64("anchor", part), F.lit(shards)).cast("int").alias("shard"),
            part.cast("int").alias("part"), parts.alias("parts"),
        ).alias("segment"),
    ).groupBy("id", "mark").agg(F.collect_list("segment").alias("segments"))
    schema, arrow = declared(
        f"shard int, part int, parts int, id {kind}, mark bigint, start bigint, bytes binary"
    )
    texts = rows.withColumnsRenamed({"id": "doc", "mark": "doc_mark"})
    of_row = (F.col("doc_mark") == F.col("mark")) & F.col("doc").eqNullSafe(F.col("id"))
    pieces = (
        texts.join(wanted.hint("merge"), of_row)
        .select("id", "text", "segments", "mark").mapInArrow(_cut_out(length, arrow), schema)
    )
    schema, arrow = declared(f"id {kind}, mark bigint, start bigint, count bigint, digest binary")
    judged = cut(pieces.groupBy("shard").applyInArrow(_shard(length, arrow), schema))
    first = judged.where("digest is not null").groupBy("digest").agg(
        F.min(F.struct("id", "mark", "start")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    crossed = judged.join(first.hint("merge"), "digest").where(
        ~F.struct("id", "mark", "start").eqNullSafe(F.col("first"))
    )
    runs = sure.unionByName(
        judged.where("digest is null").select("id", "mark", "start", "count")
    ).unionByName(crossed.select("id", "mark", "start", "count"))
    by_doc = runs.groupBy("id", "mark").agg(
        F.collect_set(F.struct("start", "count")).alias("runs")
    )
    schema, arrow = declared(
        f"id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    )
    return (
        texts.join(by_doc.hint("merge"), of_row, "left")
        .select(F.col("doc").alias("id"), "text", "runs").mapInArrow(_without(length, arrow), schema)
    )
