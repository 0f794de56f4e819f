"""Quota selection: at most so many rows of each origin, free places filled from what is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP_N, MIN_PER_SOURCE = 15, 3


def quota_top_n(df: DataFrame, origin: str, order: list[Column], top_n: int = TOP_N, least: int = MIN_PER_SOURCE) -> DataFrame:
    """The selected rows with index 0..n-1: rows within the cap by rank, then overflow by rank, cut at top_n.

    cap = max(least, top_n // origins). Only the best top_n rows of an origin can be selected: each origin is
    cut to them first, in parallel and with a rank limit that Spark applies before the shuffle. The final order
    is taken by top-n and not by sorting all rows.
    """
    o = F.coalesce(F.nullif(F.col(origin), F.lit("")), F.lit("?"))
    best = df.withColumn("_o", o).withColumn("_rn", F.row_number().over(Window.partitionBy("_o").orderBy(*order))).where(F.col("_rn") <= top_n)
    n = df.select(o.alias("_o")).distinct().agg(F.count(F.lit(1)).alias("_origins"))
    capped = best.join(F.broadcast(n))  # one row
    cap = F.greatest(F.lit(least), F.floor(F.lit(top_n) / F.greatest(F.lit(1), F.col("_origins"))))
    flagged = capped.withColumn("_over", F.col("_rn") > cap)
    top = flagged.orderBy("_over", *order).limit(top_n)
    return top.withColumn("index", F.row_number().over(Window.orderBy("_over", *order)) - 1).drop("_o", "_rn", "_origins", "_over")
