"""Benchmark decontamination: SimHash of item-sized windows, multi-index search, exact check.

Spark's own functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name
from .exact import digest_of

SHINGLE = 5
SIMILARITY = 0.8
#: Fingerprints of 64 bits in 8 blocks.  Two that differ in at most RADIUS bits have a block that
#: differs in at most RADIUS // 8 = 1 bit, and the items are indexed under all such block values.
#: Windows beyond the radius (some that lost many words in a row) are found by counts instead.
RADIUS = 15
BLOCKS = 8
#: Tables of the items are broadcast up to so many rows (16 bytes each), else shuffled.
BROADCAST_ROWS = 2_000_000

_LANES = 0x0000000100000001


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(
        F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), ""
    )


def shingles_of(words: Column, size: int = SHINGLE) -> Column:
    """A hash for each place at which ``size`` words begin."""
    places = F.when(
        F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - F.lit(size))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(
        places, lambda i: F.xxhash64(*[F.get(words, i + F.lit(k)) for k in range(size)])
    )


def fingerprints(windows: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """The 64-bit SimHash of each row's words, a word weighing as often as it occurs.

    A bit is set if it is set in more than half of the words' hashes.  Two bits are counted in one
    64-bit sum, so 32 sums do.
    """
    hashed = F.xxhash64(F.lit("simhash"), F.col("_word"))
    counted = windows.select(*keys, F.explode(words).alias("_word")).select(
        *keys, hashed.alias("_h")
    ).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.shiftrightunsigned("_h", k).bitwiseAND(F.lit(_LANES))).alias(f"_s{k}")
          for k in range(32)],
    )
    low = [F.col(f"_s{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(32)]
    high = [F.shiftrightunsigned(F.col(f"_s{k}"), 32) for k in range(32)]
    bits = F.lit(0).cast("bigint")
    for k in range(32):
        for lane, place in ((low[k], k), (high[k], k + 32)):
            bit = F.when(lane * 2 > F.col("_n"), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
            bits = bits.bitwiseOR(F.shiftleft(bit, place))
    return counted.select(*keys, bits.alias("fingerprint"))


def _blocks(fingerprint: Column, near: bool) -> Column:
    """(block, value) for each block; with ``near`` also for all values that differ in one bit."""
    width = 64 // BLOCKS
    flips = [0, *[1 << bit for bit in range(width)]] if near else [0]
    return F.array(*[
        F.struct(
            F.lit(k).alias("block"),
            F.shiftrightunsigned(fingerprint, k * width).bitwiseAND(F.lit((1 << width) - 1))
            .bitwiseXOR(F.lit(flip).cast("bigint")).alias("value"),
        )
        for k in range(BLOCKS) for flip in flips
    ])


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


def rare_shingles(grams: DataFrame, times: DataFrame, similarity: float) -> DataFrame:
    """item, size, gram: of each item so many of its least frequent shingles that no similar window
    lacks them all.

    A window of no more shingles than the item's m has at least ``similarity`` * m in common with it,
    so it lacks m - ceil(similarity * m) at most, and one more than that cannot all be missing.
    """
    listed = grams.join(times, "gram", "left").groupBy("item", "size").agg(
        F.array_sort(F.collect_list(
            F.struct(F.coalesce("times", F.lit(0)).alias("times"), "gram")
        )).alias("by_times")
    )
    m = F.size("by_times")
    spare = m - F.ceil(m * F.lit(similarity) - F.lit(1e-6)).cast("int")
    rarest = F.slice("by_times", F.lit(1), spare + F.lit(1))
    return listed.select(
        "item", "size", F.explode(F.array_distinct(rarest.getField("gram"))).alias("gram")
    )


def candidates(places: DataFrame, grams: DataFrame, n_grams: int, similarity: float) -> DataFrame:
    """doc, digest, item, size, cell: where a window similar to the item may begin.

    Cells are stretches of the item's size; a window that begins in one ends in the next at the
    latest, so a shingle in a cell speaks for that cell and the one before.
    """
    times = places.groupBy("gram").agg(F.count(F.lit(1)).alias("times"))
    rare = cut(rare_shingles(grams, times, similarity))
    cell = F.floor(F.col("place") / F.col("size")).cast("int")
    return places.join(_sized(rare, n_grams), "gram").select(
        "doc", "digest", "n", "item", "size", F.explode(F.array(cell, cell - 1)).alias("cell")
    ).where(
        (F.col("cell") >= 0) & (F.col("cell") * F.col("size") <= F.greatest(F.lit(0), F.col("n") - F.col("size")))
    ).select("doc", "digest", "item", "size", "cell").distinct()


def _passages(
    docs: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str,
    similarity: float,
) -> DataFrame:
    """All windows found, under the document's id and the digest of its text; see ``leaks``."""
    items = cut(
        items.select(F.col(item_id).alias("item"), words_of(F.col(item_text)).alias("item_words"))
        .where(F.size("item_words") >= SHINGLE)
        .withColumn("size", F.size("item_words"))
    )
    grams = cut(
        items.select("item", "size", F.posexplode(shingles_of(F.col("item_words"))))
        .withColumnsRenamed({"pos": "at", "col": "gram"})
    )
    n_grams = grams.count()
    row = ["doc", "digest"]
    read = docs.select(
        F.col(doc_id).alias("doc"), F.unhex(digest_of(F.col(text))).alias("digest"),
        F.col(text).alias("text"),
    )
    # One row a place, however many items have its shingle.
    places = cut(
        read.select(*row, words_of(F.col("text")).alias("words")).select(
            *row, F.size("words").alias("n"), F.posexplode(shingles_of(F.col("words")))
        ).withColumnsRenamed({"pos": "place", "col": "gram"})
        .join(_sized(grams.select("gram").distinct(), n_grams), "gram")
    )
    region = F.xxhash64(*row, "size", "cell").alias("region")
    wanted = cut(candidates(places, grams, n_grams, similarity).select("*", region))
    by_doc = wanted.groupBy(*row).agg(F.collect_set(F.struct("size", "cell")).alias("cells"))
    same = (read["digest"] == by_doc["digest"]) & read["doc"].eqNullSafe(by_doc["doc"])
    begin = F.col("cell") * F.col("size")
    regions = cut(
        read.join(by_doc.hint("merge"), same)
        .select(read["doc"], read["digest"], words_of(F.col("text")).alias("words"),
                F.explode("cells").alias("at"))
        .select(*row, "words", "at.size", "at.cell")
        .select(*row, F.size("words").alias("n"), "size", "cell", region,
                F.slice("words", begin + F.lit(1), F.col("size") * 2).alias("words"))
        .dropDuplicates(["region"])
    )

    last = F.greatest(F.lit(0), F.col("n") - F.col("size"))
    starts = F.array_distinct(F.array(*[
        F.greatest(F.lit(0), F.least(s, last)) for s in (F.col("place") - F.col("at"), F.col("place"))
    ]))
    hits = (
        regions.select("region", "n", "cell", begin.alias("begin"), F.posexplode(shingles_of(F.col("words"))))
        .join(wanted.select("region", "item").hint("merge"), "region")
        .withColumnsRenamed({"col": "gram"}).withColumn("place", F.col("begin") + F.col("pos"))
        .join(_sized(grams, n_grams), ["item", "gram"])
        .withColumn("starts", F.filter(starts, lambda s: F.floor(s / F.col("size")) == F.col("cell")))
    )
    window = F.least("n", "size") - F.lit(SHINGLE - 1)
    total = window + F.col("size") - F.lit(SHINGLE - 1)
    needed = F.ceil(total * F.lit(similarity / (1 + similarity)) - F.lit(1e-6))
    inside = F.filter("places", lambda p: (p >= F.col("start")) & (p < F.col("start") + window))
    laid = cut(
        hits.groupBy("region", "item", "n", "size").agg(
            F.collect_set("place").alias("places"), F.collect_set("starts").alias("starts")
        ).withColumn("start", F.explode(F.array_distinct(F.flatten("starts"))))
        .select("region", "item", "size", "start", F.xxhash64("region", "start").alias("key"),
                (F.size(inside) >= needed).alias("enough"))
    )
    windows = (
        regions.join(
            laid.groupBy("region").agg(F.collect_set(F.struct("start", "key")).alias("w")).hint("merge"),
            "region",
        ).select(*row, "size", begin.alias("begin"), "words", F.explode("w").alias("w"))
        .select(*row, "size", "w.key", "w.start", F.slice(
            "words", F.col("w.start") - F.col("begin") + F.lit(1), F.col("size")
        ).alias("words"))
    )

    prints = cut(fingerprints(windows, ["key", "size"]))
    item_prints = cut(
        fingerprints(items, ["item", "size"], "item_words")
        .withColumnRenamed("fingerprint", "item_print")
    )
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print")))
    index = item_prints.select(
        "item", "size", "item_print", F.inline(_blocks(F.col("item_print"), near=True))
    )
    n_index = item_prints.count() * BLOCKS * (64 // BLOCKS + 1)
    near = (
        prints.select("key", "size", "fingerprint", F.inline(_blocks(F.col("fingerprint"), near=False)))
        .join(_sized(index, n_index), ["size", "block", "value"])
        .where(distance <= RADIUS)
        .select("key", "item", distance.alias("distance"), F.lit("blocks").alias("found_by")).distinct()
    )
    far = (
        laid.where("enough").select("key", "item")
        .join(prints.select("key", "fingerprint").hint("merge"), "key")
        .join(_sized(item_prints.select("item", "item_print"), n_grams), "item")
        .where(distance > RADIUS)
        .select("key", "item", distance.alias("distance"), F.lit("counts").alias("found_by"))
    )
    pairs = cut(near.unionByName(far))

    side = ["key", "item", "gram"]
    ours = pairs.join(windows.select("key", "words").hint("merge"), "key").select(
        "key", "item", F.explode(shingles_of(F.col("words"))).alias("gram"),
        F.lit(1).alias("here"), F.lit(0).alias("there"),
    )
    theirs = pairs.join(_sized(grams, n_grams), "item").select(
        "key", "item", "gram", F.lit(0).alias("here"), F.lit(1).alias("there")
    )
    weighed = ours.unionByName(theirs).groupBy(*side).agg(
        F.sum("here").alias("here"), F.sum("there").alias("there")
    ).groupBy("key", "item").agg(
        (F.sum(F.least("here", "there")) / F.sum(F.greatest("here", "there"))).alias("similarity")
    ).where(F.col("similarity") >= similarity)
    of_key = laid.select("key", "region", "start").distinct().join(
        regions.select(*row, "region").hint("merge"), "region"
    ).drop("region")
    return weighed.join(pairs.hint("merge"), ["key", "item"]).join(of_key.hint("merge"), "key")


def leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per document and benchmark item that a passage of it repeats: doc_id, item_id, start
    (first word of the best window), distance (of the fingerprints), similarity, found_by.

    A window has as many words as the item (or is the whole of a shorter document).  Similarity is
    the weighted Jaccard similarity of five-word shingles, each weighing as often as it occurs.

    1. A window similar to an item holds one of the item's rarest shingles (``rare_shingles``; by
       their places in all documents), so regions of two item sizes are read around these only, and a
       phrase that many items and documents share joins none of them.  Windows are laid where a
       shingle of the item stands in a region: aligned with it, and beginning at it.
    2. All these windows get 64-bit SimHash fingerprints.  Items of the window's size within
       ``RADIUS`` bits are found by blocks (``found_by`` is ``blocks``).
    3. A window beyond the radius (one that lost many words in a row may be) goes on if so many
       places in it hold a shingle of the item as the similarity needs: of n and m shingles, those
       of similarity s have s (n + m) / (1 + s) in common (``found_by`` is ``counts``).
    4. Those pairs are verified by their shingles, counted exactly.

    Jobs run while the table is built, even for ``explain()``.
    Items of fewer than five words are no evidence and match nothing; null or empty texts have no
    words.  Rows of equal id are looked through each for itself and reported under that id; null
    ids are kept apart from others only as null.  Other columns are not read.
    """
    found = _passages(docs, items, doc_id, text, item_id, item_text, similarity)
    best = F.struct("similarity", -F.col("start"), -F.col("distance"), "found_by")
    return found.groupBy("doc", "item").agg(
        F.max(best).alias("best")
    ).select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"),
        (-F.col("best.col2")).alias("start"), (-F.col("best.col3")).alias("distance"),
        F.col("best.similarity").alias("similarity"), F.col("best.found_by").alias("found_by"),
    )


def drop_leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY,
) -> DataFrame:
    """The documents without those of which a passage repeats a benchmark item.

    Rows are matched by id and text, so others of the same or of no id stay.
    """
    gone, content = free_name(docs, "gone_id"), free_name(docs, "gone_digest")
    leaked = _passages(docs, items, doc_id, text, item_id, item_text, similarity).select(
        F.col("doc").alias(gone), F.col("digest").alias(content)
    ).distinct()
    same = F.col(doc_id).eqNullSafe(F.col(gone)) & (
        F.unhex(digest_of(F.col(text))) == F.col(content)
    )
    return docs.join(leaked, same, "left_anti")
