"""The corpus pipeline: quality rules, exact dedup, near-duplicate removal, source mixing, tokenising."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import bpe, exact_dedup, mixing, near_dedup, quality
from feedloom.llm.common import Scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules (null, empty and short texts do), and those that fail a soft rule on
    a strict host; a null source is a host. Repeated rows share a verdict; an empty table gives no rows."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text, white space aside: the longest, then the least id, a null id last. Null and
    empty texts are one text; of rows that repeat id and text one stays; an empty table gives no rows."""
    return exact_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least id of each near-duplicate class. Texts without words and rows without an id are classes of
    their own; rows that repeat an id count as one document; an empty table gives no rows."""
    return near_dedup.near_dedup(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents by Poisson counts so that all sources weigh the same, in a random order. A null source is a
    source; a null id has one count; rows that repeat an id share theirs; an empty table gives no rows."""
    return mixing.mix(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents but the text, with its ids, their number, and whether they decode to the text. A null
    or empty text has no ids; rows may repeat; long texts are encoded whole; an empty table gives no rows."""
    coded = bpe.encode(docs.withColumn("_text", F.col("text")), public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return coded.select(
        *(c for c in docs.columns if c != "text"),
        (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.col("decoded").eqNullSafe(F.coalesce("_text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("source_mixing", source_mixing),
    ("bpe", tokenise),
]

#: Weighted-sampling classes are not expressible in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to documents; each but the last is written to the shared folder and read again. A stage's input
    is deleted when its output is written; the last one's stays, as the result reads it."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.keep(stage(spark, docs, sf_dir))
        if i:
            scratch.drop(i)
    return STAGES[-1][1](spark, docs, sf_dir)
