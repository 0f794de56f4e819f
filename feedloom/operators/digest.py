"""Digest assembly: ranking, tiers, the plain report, links back to items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.text import importance
from feedloom.functions.url import extract_urls

TOP_N = 12
#: The report's words.
HEADINGS = ["今日头条", "重要进展", "值得关注"]
NOTHING, NO_TITLE, NO_SNIPPET, NO_SOURCE = "今日无", "(无标题)", "（摘要缺失，仅保留标题与链接）", "无"


def ranked(items: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """The best items with a URL, with rank (from 1) and tier (1, 2 or 3), by weight, score and ordinal."""
    order = [F.desc(F.coalesce("weight", F.lit(0))), F.desc(F.coalesce("score", F.lit(0))), F.asc("ord")]
    top = items.where(F.coalesce("url", F.lit("")) != "").orderBy(*order).limit(top_n)
    rank = F.row_number().over(Window.orderBy(*order))
    return top.withColumn("rank", rank).withColumn("tier", F.when(F.col("rank") == 1, 1).when(F.col("rank") <= 3, 2).otherwise(3))


def ordered_join(line: Column, order: Column, keep: Column, sep: str = "\n") -> Column:
    """Text of the rows to keep, in order; for groups of a bounded size."""
    got = F.array_sort(F.collect_list(F.when(keep, F.struct(order.alias("o"), line.alias("l")))))
    return F.array_join(F.transform(got, lambda x: x["l"]), sep)


def fallback_report(items: DataFrame, run_date: str, reason: str) -> DataFrame:
    """One row (markdown): the report made from the items when no writer gave one."""
    rows = ranked(items)
    title = F.coalesce(F.nullif("title", F.lit("")), F.lit(NO_TITLE))
    snippet = F.coalesce(F.nullif(F.trim("raw"), F.lit("")), F.lit(NO_SNIPPET))
    origin, stars = F.coalesce("origin", F.lit("")), importance(F.col("weight")).cast("string")
    block = F.concat(F.lit("### "), title, F.lit(" · 重要性 "), stars, F.lit("/5\n"), snippet, F.lit("\n来源："), origin, F.lit(" · [原文]("), F.col("url"), F.lit(")\n"))
    link = F.concat(F.lit("- ["), title, F.lit("]("), F.col("url"), F.lit(") — "), origin, F.lit(" · "), stars, F.lit("/5"))
    parts = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.array_sort(F.collect_set(F.when(origin != "", origin))), " / ").alias("sources"),
        *(ordered_join(block, F.col("rank"), F.col("tier") == i).alias(f"t{i}") for i in (1, 2, 3)),
        ordered_join(link, F.col("rank"), F.lit(True)).alias("links"),
    )
    head = F.concat(F.lit(f"# AI 日报 · {run_date}\n\n> 共 "), F.col("n").cast("string"), F.lit(" 条 · 来源："), F.when(F.col("sources") == "", NO_SOURCE).otherwise(F.col("sources")), F.lit(f"\n\n<!-- 保底渲染（{reason}）：LLM 这次没给出可用的日报正文 -->\n"))
    body = [F.concat(F.lit(f"\n## {h}\n\n"), F.when(F.col(f"t{i}") == "", NOTHING + "\n").otherwise(F.col(f"t{i}"))) for i, h in enumerate(HEADINGS, 1)]
    return parts.select(F.rtrim(F.regexp_replace(F.concat(head, *body, F.lit("\n## 链接汇总\n\n"), F.col("links")), r"\s+\z", "")).alias("markdown"))


def pushed_items(reports: DataFrame, items: DataFrame, markdown: str = "markdown", last: Column | str = "ord") -> DataFrame:
    """(report, pos, url, title, origin, raw): the links of each report in order, as the items' own URLs.

    reports: (report, markdown). A link is an item's if they agree without trailing slashes, the last item (by
    ``last``) winning; a link of no item stays with an empty title. A report without links has all items.
    """
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    good = items.where(F.coalesce("url", F.lit("")) != "")
    by_bare = good.groupBy(bare(F.col("url")).alias("_bare")).agg(F.max_by("url", last).alias("_url"))
    by_url = good.groupBy(F.col("url")).agg(F.max_by(F.struct("title", "origin", "raw"), last).alias("_item"))
    links = reports.select("report", F.posexplode(extract_urls(markdown)).alias("at", "link"))
    mapped = links.join(by_bare, bare(F.col("link")) == F.col("_bare"), "left").select("report", "at", F.coalesce("_url", "link").alias("url"))
    none = reports.where(F.size(extract_urls(markdown)) == 0).select("report")
    every = good.groupBy("url").agg(F.min("ord").alias("at"))
    mapped = mapped.unionByName(none.join(every).select("report", F.col("at").cast("int").alias("at"), "url"))
    first = mapped.groupBy("report", "url").agg(F.min("at").alias("at"))
    out = first.join(by_url, "url", "left").withColumn("pos", F.row_number().over(Window.partitionBy("report").orderBy("at")) - 1)
    some = lambda f: F.coalesce(F.col(f"_item.{f}"), F.lit(""))
    return out.select("report", "pos", "url", some("title").alias("title"), some("origin").alias("origin"), F.left(some("raw"), F.lit(200)).alias("raw"))
