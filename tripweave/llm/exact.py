"""Exact deduplication: frequent digests map-side, the others by an ordinary shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name

#: Digests that may be broadcast, and counters of the frequent-items sketch that proposes them.
WINNERS = 256
COUNTERS = 8192
#: A proposed digest of fewer copies than this is left to the shuffle.
LEAST_COPIES = 64


def digest_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def frequent_digests(
    digests: DataFrame, winners: int = WINNERS, counters: int = COUNTERS, least: int = LEAST_COPIES
) -> list[tuple[str, int, int | None]]:
    """The verified winners as (digest, copies, largest id), at most ``winners`` of them.

    A Misra-Gries summary of ``counters`` counters per task (Spark's frequent-items sketch, merged
    by Spark) proposes digests; a second pass counts only those, exactly.
    """
    found = digests.agg(
        F.expr(f"approx_top_k(digest, {winners}, {counters})").alias("top")
    ).first()["top"] or []
    proposed = [x["item"] for x in found if x["count"] >= least and x["item"] is not None]
    if not proposed:
        return []
    counted = (
        digests.where(F.col("digest").isin(proposed))
        .groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("largest"))
    )
    return [tuple(x) for x in counted.where(F.col("n") >= least).collect()]


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """One row per document: id, digest (SHA-256 in hex), copies, keep_id, kept.

    Texts are equal when their bytes are; null counts as empty.  The row of the largest id stays.
    A null id loses against any other; if all ids of a group are null, keep_id is null and its rows
    are kept.  Rows that repeat both id and text are one document seen more than once: they count
    in ``copies`` and are marked alike.  Columns beside id and text are not read.

    Groups of many copies never meet a shuffle: their few verified digests (``frequent_digests``,
    at most ``WINNERS``) are broadcast and joined map-side.  The others are aggregated and joined
    by digest.
    """
    digests = cut(docs.select(F.col(doc_id).alias("id"), digest_of(F.col(text)).alias("digest")))
    winners = frequent_digests(digests, **limits)
    kind = digests.schema["id"].dataType.simpleString()
    schema = f"digest string, copies bigint, keep_id {kind}"
    hot = F.broadcast(digests.sparkSession.createDataFrame(winners, schema))
    rest = digests.join(hot, "digest", "left_anti")
    grouped = rest.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.max("id").alias("keep_id")
    )
    return (
        digests.join(hot, "digest").unionByName(rest.join(grouped.hint("merge"), "digest"))
        .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
    )


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The documents without the rows that ``copies`` does not keep; all columns stay as they are."""
    gone, content = free_name(docs, "gone_id"), free_name(docs, "gone_digest")
    dropped = copies(docs, doc_id, text, **limits).where(~F.col("kept")).select(
        F.col("id").alias(gone), F.col("digest").alias(content)
    )
    same = F.col(doc_id).eqNullSafe(F.col(gone)) & (digest_of(F.col(text)) == F.col(content))
    return docs.join(dropped, same, "left_anti")
