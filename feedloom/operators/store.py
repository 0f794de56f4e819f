"""The keyed history store: upsert, window, retention, statistics.

The state is a table of schemas.ARTICLE. Every function takes and returns a DataFrame; a caller writes the
result to a new version and swaps it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.url import store_key
from feedloom.operators import dedup

DAYS, LIMIT = 30, 400


def upsert(state: DataFrame, batch: DataFrame, order: str = "ord") -> DataFrame:
    """state with the batch's rows: the first of each url_key in the batch counts.

    On a known key run_date and pushed_at are refreshed, source, title and raw only where the new value is not
    empty, and url never changes. Rows without a key are left out. One partial aggregate per key, no join.
    """
    old = state.select("url_key", F.lit(0).alias("_new"), F.lit(0).cast("bigint").alias("_at"), F.struct("url", "run_date", "source", "title", "raw", "pushed_at").alias("_r"))
    new = batch.where(F.coalesce("url_key", F.lit("")) != "").select("url_key", F.lit(1).alias("_new"), F.col(order).cast("bigint").alias("_at"), F.struct("url", "run_date", "source", "title", "raw", "pushed_at").alias("_r"))
    both = old.unionByName(new).groupBy("url_key").agg(F.min_by("_r", F.when(F.col("_new") == 0, F.col("_at"))).alias("o"), F.min_by("_r", F.when(F.col("_new") == 1, F.col("_at"))).alias("n"))
    keep = lambda c: F.coalesce(F.nullif(F.col(f"n.{c}"), F.lit("")), F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c)
    return both.select("url_key", F.coalesce("o.url", "n.url").alias("url"), F.coalesce("n.run_date", "o.run_date").alias("run_date"), keep("source"), keep("title"), keep("raw"), F.coalesce("n.pushed_at", "o.pushed_at").alias("pushed_at"))


def window(state: DataFrame, as_of: Column, days: int = DAYS, limit: int = LIMIT) -> DataFrame:
    """The newest ``limit`` rows of the last ``days`` days, by run_date, pushed_at and key."""
    return state.where(F.col("run_date") >= F.date_sub(as_of, days)).orderBy(F.desc("run_date"), F.desc("pushed_at"), "url_key").limit(limit)


def prune(state: DataFrame, as_of: Column, days: int = DAYS) -> DataFrame:
    """state without rows older than the window."""
    return state.where(F.col("run_date") >= F.date_sub(as_of, days))


def stats_by_day(state: DataFrame) -> DataFrame:
    return state.groupBy("run_date").agg(F.count(F.lit(1)).alias("articles"), F.countDistinct("source").alias("sources"))


def stats_by_source(state: DataFrame) -> DataFrame:
    return state.groupBy("source").agg(F.count(F.lit(1)).alias("articles"), F.min("run_date").alias("first_day"), F.max("run_date").alias("last_day"))


def totals(state: DataFrame) -> DataFrame:
    return state.agg(F.count(F.lit(1)).alias("articles"), F.min("run_date").alias("first_day"), F.max("run_date").alias("last_day"))


def is_seen(state: DataFrame, url_key: str) -> bool:
    return bool(state.where(F.col("url_key") == url_key).limit(1).count())


def commit_new(state: DataFrame, batch: DataFrame, order: str = "ord") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fresh rows, the next state, one row of counts) of a batch with url_key: what is not known and first in it is
    recorded, so a caller that has not delivered must not write the state."""
    judged = dedup.partition(batch, state, "url_key", order)
    fresh = judged.where("status = 'fresh'").drop("status")
    tell = judged.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("fresh", "duplicate", "invalid"))).withColumn("recorded", F.col("fresh"))
    return fresh, upsert(state, fresh, order), tell


def from_history(rows: DataFrame, run_date: Column) -> DataFrame:
    """A legacy list (url, date, title) as state; every row gets the day of the import, as its own day is not kept."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    keyed = rows.select(store_key("url").alias("url_key"), "url", text("title")).where("url_key <> ''")
    first = keyed.groupBy("url_key").agg(F.min_by(F.struct("url", "title"), "url").alias("r"))
    return first.select("url_key", "r.url", run_date.alias("run_date"), F.lit("").alias("source"), "r.title", F.lit("").alias("raw"), run_date.cast("timestamp").alias("pushed_at"))


def merged_history(old: DataFrame, pushed: DataFrame, date: str) -> DataFrame:
    """The legacy list (url, date, title) after a delivery: pushed urls leave their old places and stand with the date."""
    now = pushed.select("url", F.lit(date).alias("date"), F.coalesce("title", F.lit("")).alias("title")).dropDuplicates(["url"])
    return old.select("url", "date", "title").join(now.select("url"), "url", "left_anti").unionByName(now)
