"""A corpus pipeline: quality, exact copies, near copies, benchmark passages, packing.

Each stage takes (spark, docs, folder of the test tables) and returns a DataFrame; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import quality
from tripweave.llm.common import cut_table, table
from tripweave.llm.decontaminate import drop_leaks
from tripweave.llm.exact import drop_copies
from tripweave.llm.near import drop_near_copies
from tripweave.llm.packing import pack
from tripweave.llm.queries import TOKENIZER


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, accepts."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents of the same text, the one of the largest id."""
    return drop_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the least id, of each group of near copies."""
    return drop_near_copies(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences: one row per piece of a document."""
    pieces = pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", no_exact_copies),
    ("near_dedup", no_near_copies),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

#: SQL can express neither a trained classifier nor tokenization.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each result a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
