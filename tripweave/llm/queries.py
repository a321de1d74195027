"""The named queries of this package: each takes (spark, folder of the test tables)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, quality, secrets
from .common import fold, table
from .decontaminate import leaks
from .exact import copies
from .licenses import find_licenses
from .near import near_copies
from .packing import pack
from .phrases import collocations
from .repeats import remove_repeats
from .runs import find_runs
from .simhash import simhash_copies
from .urls import judge

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"


def op1_packing(spark, sf_dir):
    """Pieces of all documents, packed into sequences of at most 4096 tokens."""
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


#: What the url rules are in the query; they are a parameter of the operator.
URL_RULES = [
    ("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"),
]


def op2_urls(spark, sf_dir):
    """A verdict on the url of every page, by rules or by trust that spreads between hosts."""
    return judge(table(spark, sf_dir, "pages"), URL_RULES).drop("url")


def op3_decontamination(spark, sf_dir):
    """Documents with a passage that repeats a benchmark item, and where."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_repeats(spark, sf_dir):
    """What is left of every document without the 100-byte strings that start earlier too."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_exact_dedup(spark, sf_dir):
    """Every document with the document of the same text that stays."""
    return copies(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", F.col("copies").alias("group_size"), "kept",
        F.col("digest").alias("text_sha256"),
    )


def _joined(spans):
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def op6_secrets(spark, sf_dir):
    """Secrets in every document: fixed patterns, and strings that look random."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))
    fixed = F.filter("spans", lambda x: x["kind"] != "random")

    def number(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"), number("assign"), number("access"), number("hex"),
        F.sha2(_joined(fixed), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


def op7_quality(spark, sf_dir):
    """A quality score for every document, learned from four of five folds of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels.where(fold(F.col("doc_id"), 5) != 0))
    return quality.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )


def op8_near_dedup(spark, sf_dir):
    """Every document with the least document that chains of near copies lead to."""
    return near_copies(table(spark, sf_dir, "documents"), words=4).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept"
    )


def op9_language(spark, sf_dir):
    """The language of every document, learned from two of three folds."""
    docs = table(spark, sf_dir, "documents")
    out = fold(F.col("doc_id"), 3) == 1
    model = language.train(docs.where(~out))
    kept = fold(F.col("id"), 3) == 1
    return language.predict(docs, model).select(
        F.col("id").alias("doc_id"), kept.alias("held_out"), "lang_pred", "score"
    )


def op10_licenses(spark, sf_dir):
    """Licence notices in every document: fixed phrases, and templates that a text covers."""
    labels = F.transform("places", lambda x: x["label"])
    by_cover = F.transform("spans", lambda x: x["label"])

    def distinct(names):
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    words = F.transform("places", lambda x: x["word"])
    return find_licenses(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        distinct(labels).alias("base_labels"), distinct(F.concat(labels, by_cover)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(
            F.coalesce(F.array_max(F.transform("spans", lambda x: x["cover"])), F.lit(0.0))
        ).alias("score"),
    )


def with_loops(docs: DataFrame) -> DataFrame:
    """The documents, of which one in ten repeats a stretch of its words from some word on to its end."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    looped = (
        docs.withColumn("g", F.floor(number / 10))
        .withColumn("words", F.when(number % 10 == 0, split))
        .withColumn("n", F.size("words"))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    )
    i_to = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(
            F.col("a") + (i - F.col("a")) % F.col("p")
        ).cast("int")),
    )
    changed = F.when(F.col("a").isNotNull(), F.array_join(i_to, " ")).otherwise(F.col("text"))
    return looped.withColumn("text", changed).select(*docs.columns)


def op11_runs(spark, sf_dir):
    """Periodic runs of words in every document, and a digest of what is left without them."""
    found = find_runs(with_loops(table(spark, sf_dir, "documents")))
    best = F.aggregate(
        "runs", F.get("runs", F.lit(0)),
        lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best),
    )
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", *[
        x[c].cast("string") for c in ("start", "length", "period")
    ]), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_phrases(spark, sf_dir):
    """The best collocations of every language."""
    return collocations(table(spark, sf_dir, "documents")).drop("first_doc")


def op13_simhash(spark, sf_dir):
    """The SimHash of every document, and the least document that near fingerprints lead to."""
    return simhash_copies(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_urls": op2_urls,
    "op3_decontamination": op3_decontamination,
    "op4_repeats": op4_repeats,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_secrets": op6_secrets,
    "op7_quality": op7_quality,
    "op8_near_dedup": op8_near_dedup,
    "op9_language": op9_language,
    "op10_licenses": op10_licenses,
    "op11_runs": op11_runs,
    "op12_phrases": op12_phrases,
    "op13_simhash": op13_simhash,
}
