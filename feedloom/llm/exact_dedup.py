"""Exact dedup by two-pass Bloom filtering, with DataFrame functions alone.

Pass 1 reduces every normalised text to a 64-bit hash, combined in each task before it is shuffled, and inserts
the hashes met twice or more into a Bloom filter. Pass 2 tests each row against the filter: only rows that it
holds may be repeated, so only those shuffle; every other row passes straight through. The filter is as
large as the repeated texts are many, whatever the number of unique ones. False positives cost a shuffle of the
row and never change the result, which rests on SHA-256.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, group_facts

#: Bits per repeated hash, and the filter's largest size. 2**30 bits are 128 MB when broadcast and hold 67 million
#: repeated hashes at full strength (1.4 % of unique rows shuffle); beyond, more unique rows shuffle, and no more.
BITS_PER_HASH, MAX_BITS, HASHES = 16, 1 << 30, 2
_WORD = 32_768  # bits of one bitmap row


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def repeated_hashes(keys: DataFrame, hash_col: str) -> DataFrame:
    """Pass 1: the hashes that two or more rows have, as one column of that name."""
    n = fresh([hash_col], "_n")
    return cut(keys.groupBy(hash_col).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).select(hash_col))


def _cells(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def _hit(cell: Column, map_: Column) -> Column:
    at = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring(map_, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


def maybe_repeated(df: DataFrame, hash_col: str, twice: DataFrame, flag: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Pass 2: adds ``flag``, false only for rows whose hash is certainly not in ``twice`` (a checkpointed column).

    Other columns of df stay as they are, whatever their names. A filter of max_bits is broadcast at most.
    """
    bits = max(_WORD, min(max_bits, 1 << math.ceil(math.log2(max(1, twice.count()) * BITS_PER_HASH))))
    cells = twice.select(F.explode(F.array(*_cells(F.col(hash_col), bits))).alias("cell"))
    maps = cells.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("map"))
    names, hits = df.columns, F.lit(True)
    for i, cell in enumerate(_cells(F.col(hash_col), bits)):
        c, b, m = (fresh(df.columns, f"_{x}{i}") for x in "cbm")
        df = df.withColumn(c, cell).join(F.broadcast(maps.select(F.col("bucket").alias(b), F.col("map").alias(m))), F.bitmap_bucket_number(F.col(c)) == F.col(b), "left")
        hits = hits & _hit(F.col(c), F.col(m))
    return df.select(*(n for n in names if n.lower() != flag.lower()), hits.alias(flag))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ASCII white space; a null text is an empty one and empty texts
    are equal to each other. The row with the most code points stays, then the smallest id; a null id
    ranks last. Rows that repeat both id and text share one verdict. An empty table gives no rows; other
    columns, whatever their names, are not read.
    """
    sha = F.unhex(F.sha2(normalised(F.col(text_col)), 256))
    digests = cut(docs.select(F.col(id_col).alias("_id"), F.length(F.coalesce(text_col, F.lit(""))).alias("_chars"), sha.alias("_sha")).withColumn("_h", F.xxhash64("_sha")))
    tested = maybe_repeated(digests, "_h", repeated_hashes(digests, "_h"), "_maybe")
    alone = tested.where("not _maybe").select("_id", F.col("_id").alias("_keep"), F.lit(1).cast("bigint").alias("_size"), "_sha")
    rows, facts = group_facts(tested.where("_maybe").select("_id", "_chars", "_sha"), ["_sha"], F.col("_id"), {"_best": (F.max, _rank()), "_size": (F.sum, F.lit(1).cast("bigint"))}, salts)
    grouped = rows.join(facts, ["_sha", "_salt"]).select("_id", F.col("_best._id").alias("_keep"), "_size", "_sha")
    return alone.unionByName(grouped).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def _rank() -> Column:
    return F.struct("_chars", F.bitwise_not(F.col("_id").cast("bigint")).alias("_rank"), "_id")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64) -> DataFrame:
    """The rows of docs that stay, all columns as they are: one row for each distinct normalised text.

    Follows exact_groups; of rows that repeat both id and text one stays. Nulls and empty texts count as one text,
    an empty table gives no rows, and columns may have any names. Only possibly repeated rows shuffle, by (text
    digest, id), so that no group of copies meets in one task.
    """
    sha, h, flag = (fresh(docs.columns, x) for x in ("_sha", "_h", "_maybe"))
    plain = normalised(F.col(text_col))
    digest = F.unhex(F.sha2(plain, 256))
    digests = cut(docs.select(F.col(id_col).alias("_id"), F.length(F.coalesce(text_col, F.lit(""))).alias("_chars"), digest.alias("_sha"), F.xxhash64(plain).alias("_h")))
    twice = repeated_hashes(digests, "_h")
    _, facts = group_facts(maybe_repeated(digests, "_h", twice, "_maybe").where("_maybe"), ["_sha"], F.col("_id"), {"_best": (F.max, _rank())}, salts)
    stay = facts.select(F.col("_sha").alias(sha), F.col("_best._id").alias(h)).distinct()
    # unique rows need the short hash alone
    tested = maybe_repeated(docs.withColumn(h, F.xxhash64(plain)), h, twice.withColumnRenamed("_h", h), flag)
    maybe = tested.where(flag).select(*docs.columns, digest.alias(sha))
    kept = maybe.join(stay, (maybe[sha] == stay[sha]) & maybe[id_col].eqNullSafe(stay[h]), "left_semi").dropDuplicates([sha, id_col])
    return tested.where(~F.col(flag)).select(*docs.columns).unionByName(kept.select(*docs.columns))


__all__ = ["exact_dedup", "exact_groups", "maybe_repeated", "normalised", "repeated_hashes"]
