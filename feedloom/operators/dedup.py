"""Key-based duplicate removal: first per key, gap filling, prefix limits, history joins.

All of them order rows by an explicit ordinal, so that a partitioning never changes the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """The earliest row of each key; rows without a key go."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.where(F.coalesce(F.col(key), F.lit("")) != "").withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def gap_fill_merge(df: DataFrame, key: str, order: list[str], fields: list[str]) -> DataFrame:
    """The earliest row of each key, with ``fields`` filled from the first later row that has them.

    min_by over the non-empty values is a partial aggregate, so a hot key is combined before the shuffle.
    """
    at = F.struct(*order)
    lead = F.min_by(F.struct(*(c for c in df.columns if c not in (key, *fields))), at).alias("_lead")

    def first_value(c: str) -> Column:
        v = F.col(c)
        filled = v.isNotNull() & (v != "") if dict(df.dtypes)[c] == "string" else v.isNotNull()
        some = F.min_by(F.when(filled, v), F.when(filled, at))
        return F.coalesce(some, F.lit("") if dict(df.dtypes)[c] == "string" else F.lit(None)).alias(c)

    out = df.groupBy(key).agg(lead, *(first_value(c) for c in fields))
    return out.select(*(F.col(c) if c in (key, *fields) else F.col(f"_lead.{c}").alias(c) for c in df.columns))


def max_items_prefix(df: DataFrame, key: str, order: list[str], limit: int) -> DataFrame:
    """The rows read before ``limit`` distinct keys are full; 0 or less reads all.

    A row is read if fewer than limit keys are new before it: rows after that neither merge nor count. Only
    the first places of the first limit keys matter, so the cut is found by a top-n of the keys' first
    places and no global window runs over all rows.
    """
    if limit <= 0:
        return df
    at = F.struct(*order)
    firsts = df.groupBy(key).agg(F.min(at).alias("_first")).orderBy("_first").limit(limit)
    last = firsts.agg(F.max("_first").alias("_last"), F.count(F.lit(1)).alias("_n"))
    out = df.join(F.broadcast(last))  # one row
    return out.where((F.col("_n") < limit) | (at <= F.col("_last"))).drop("_last", "_n")


def without_history(df: DataFrame, history: DataFrame, key: str) -> DataFrame:
    return df.join(history.select(key).distinct(), key, "left_anti")


def known(df: DataFrame, history: DataFrame, key: str) -> DataFrame:
    return df.join(history.select(key).distinct(), key, "left_semi")


def partition(df: DataFrame, history: DataFrame, key: str, *order: str) -> DataFrame:
    """df plus status: invalid (no key), duplicate (in history or later in the batch) or fresh.

    First places are minima, which combine before the shuffle, and come back by a join that Spark can split, so a hot
    key needs no task of its own. Rows of a key that share its first place are first together.
    """
    place = F.struct(*order)
    seen = history.select(F.col(key).alias("_seen")).distinct()
    valid = df.where(F.coalesce(F.col(key), F.lit("")) != "")
    first = valid.groupBy(F.col(key).alias("_key")).agg(F.min(place).alias("_first")).join(seen, F.col("_key") == F.col("_seen"), "left")
    status = F.when(F.col("_seen").isNotNull() | (place != F.col("_first")), "duplicate").otherwise("fresh")
    judged = valid.join(first, F.col(key) == F.col("_key")).select(*df.columns, status.alias("status"))
    return judged.unionByName(df.where(F.coalesce(F.col(key), F.lit("")) == "").withColumn("status", F.lit("invalid")))
