"""The daily plan: feeds to items, URL dedup, history, quota, similarity dedup, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import looks_like_report, strip_wrappers
from feedloom.functions.url import store_key
from feedloom.operators import dedup, digest, select, similar


def candidates(items: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """items (with ord) by their store key, first per key, without keys of history (url_key)."""
    keyed = items.withColumn("url", store_key("url"))
    if history is not None:
        keyed = dedup.without_history(keyed.withColumnRenamed("url", "url_key"), history, "url_key").withColumnRenamed("url_key", "url")
    return dedup.first_per_key(keyed, "url", "ord")


def selection(items: DataFrame, history: DataFrame | None = None) -> DataFrame:
    order = [F.desc("weight"), F.desc("score"), F.asc("ord")]
    return select.quota_top_n(candidates(items, history), "origin", order)


#: Sources in the order in which their items are united, and the names of their counts (fixed values).
SOURCES = {"HN": "hn_raw", "OpenAI Blog": "openai_raw", "量子位": "qbitai_raw"}


def united(feeds: list[DataFrame]) -> DataFrame:
    """Items of all feeds in the order of the list; ord tells a feed's place first, then the item's own."""
    some = [f.withColumn("ord", F.lit(i << 40).cast("bigint") + F.col("ord")) for i, f in enumerate(feeds)]
    out = some[0]
    for f in some[1:]:
        out = out.unionByName(f)
    return out


def stats(items: DataFrame, kept: DataFrame, selected: DataFrame, origins: dict[str, str] | None = None, warnings: list[str] | None = None) -> DataFrame:
    """One row: raw counts per origin, rows after URL dedup, selected rows, origins without rows, and warnings."""
    origins = SOURCES if origins is None else origins
    raw = items.agg(*(F.count_if(F.col("origin") == o).alias(c) for o, c in origins.items()), F.count(F.lit(1)).alias("merged_raw"))
    missing = F.array_compact(F.array(*(F.when(F.col(c) == 0, F.lit(f"{o}(0)")) for o, c in origins.items())))
    own = F.coalesce(F.nullif("origin", F.lit("")), F.lit("?"))
    by = selected.groupBy(own.alias("origin")).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("origin", "n")))).alias("selected_by_source"), F.coalesce(F.sum("n"), F.lit(0)).alias("selected"))
    rows = raw.withColumn("missing_sources", missing).join(kept.agg(F.count(F.lit(1)).alias("after_url_dedup"))).join(by)
    told = F.array(*map(F.lit, warnings)) if warnings else F.array().cast("array<string>")
    return rows.withColumn("dropped", F.greatest(F.lit(0), F.col("merged_raw") - F.col("after_url_dedup"))).withColumn("warnings", told)


def decided(selected: DataFrame, history: DataFrame | None = None, embeddings: DataFrame | None = None) -> DataFrame:
    """The selected items with the verdicts of similarity dedup; history: (ord, title, url, origin, raw)."""
    rows = selected.withColumnRenamed("ord", "source_ord").withColumn("ord", F.col("index").cast("bigint"))
    return similar.semantic_dedup(rows, history, lambda d: similar.vectors_for(d, embeddings))


def deduplicated(selected: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """The selected items that similarity dedup keeps, marked."""
    return decided(selected, history).where("action <> 'drop'")


def report(written: Column | None, kept: DataFrame, run_date: str) -> DataFrame:
    """(report, markdown): the writer's text if it is a report, else the plain one."""
    plain = digest.fallback_report(kept, run_date, "输出为空").select(F.lit(1).alias("report"), "markdown")
    if written is None:
        return plain
    text = strip_wrappers(written)
    other = digest.fallback_report(kept, run_date, "输出不是分档日报").select(F.lit(1).alias("report"), F.col("markdown").alias("other"))
    return plain.join(other, "report").select("report", F.when(looks_like_report(text), text).when(text == "", F.col("markdown")).otherwise(F.col("other")).alias("markdown"))
