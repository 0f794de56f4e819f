"""Run-log reporting: funnel, source quality, similarity figures, issues, and their Markdown."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import ratio_text

#: Source marks, their display names, their count fields, and other names in logs.
LABELS = {"hn": "Hacker News", "openai": "OpenAI Blog", "jqzx": "量子位"}
RAW_FIELDS = {"hn": ["hn_raw"], "openai": ["openai_raw"], "jqzx": ["qbitai_raw", "jqzx_raw"]}
ALIASES = {"hn": "hn", "hacker news": "hn", "openai": "openai", "openai blog": "openai", "jqzx": "jqzx", "量子位": "jqzx", "机器之心": "jqzx"}


def in_window(runs: DataFrame, as_of: Column, days: int) -> DataFrame:
    return runs if not days else runs.where(F.coalesce("date", F.lit("")) >= F.date_format(F.date_sub(as_of, days), "yyyy-MM-dd"))


def stage_counts(runs: DataFrame) -> DataFrame:
    """runs plus merged, after_url, chosen, has_semantic, kept, cut and pushed; absent stages take the stage before."""
    n = lambda c: F.coalesce(F.col(f"stats.{c}"), F.lit(0)).cast("bigint")
    has = F.col("stats.semantic_kept").isNotNull() | F.col("stats.semantic_dropped").isNotNull()
    chosen = F.coalesce(F.col("stats.selected"), n("after_url_dedup")).cast("bigint")
    return runs.select(
        "*",
        n("merged_raw").alias("merged"),
        n("after_url_dedup").alias("after_url"),
        chosen.alias("chosen"),
        has.alias("has_semantic"),
        F.when(has, n("semantic_kept")).otherwise(chosen).alias("kept"),
        n("semantic_dropped").alias("cut"),
        F.coalesce("count", F.lit(0)).alias("pushed"),
    )


def summary(runs: DataFrame) -> DataFrame:
    """One row of run counts, tokens, time and the funnel."""
    ok, push = F.coalesce(F.col("status") == "succeeded", F.lit(False)), F.coalesce(F.col("push.ok"), F.lit(False))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return stage_counts(runs).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        F.count_if(push).alias("push_ok"),
        F.count_if(~push & F.col("push").isNotNull()).alias("push_failed"),
        total("total_tokens").alias("total_tokens"),
        F.round(F.coalesce(F.sum("elapsed_seconds"), F.lit(0.0)), 1).alias("elapsed_seconds"),
        *(total(c).alias(n) for c, n in (("merged", "merged_raw"), ("after_url", "after_url_dedup"), ("chosen", "selected"), ("kept", "semantic_kept"), ("cut", "semantic_dropped"), ("pushed", "pushed"))),
    )


def by_run(runs: DataFrame) -> DataFrame:
    """One row per run."""
    return stage_counts(runs).select("date", "status", F.col("merged").alias("merged_raw"), F.col("after_url").alias("after_url_dedup"), F.col("chosen").alias("selected"), F.col("cut").alias("semantic_dropped"), "pushed", "history_used", F.coalesce("push.ok", F.lit(False)).alias("push_ok"))


def sources(runs: DataFrame) -> DataFrame:
    """(source, raw, selected, missing_runs, days): days and missing_runs count the runs that report the source."""
    marks = F.array(*(F.struct(F.lit(v).alias("source"), F.coalesce(*(F.col(f"stats.{c}") for c in RAW_FIELDS[k])).alias("n")) for k, v in LABELS.items()))
    raw = runs.select(F.inline(marks)).groupBy("source").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("raw"), F.count_if(F.col("n") == 0).alias("missing_runs"), F.count("n").alias("days"))
    name = F.element_at(F.create_map(*(F.lit(x) for k, v in ALIASES.items() for x in (k, LABELS[v]))), F.lower(F.trim("name")))
    chosen = runs.select(F.explode("stats.selected_by_source").alias("name", "n")).select(name.alias("source"), "n").where("source is not null").groupBy("source").agg(F.sum("n").alias("selected"))
    every = runs.sparkSession.createDataFrame([(v,) for v in LABELS.values()], "source string")
    out = every.join(raw, "source", "left").join(chosen, "source", "left")
    return out.select("source", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("raw", "selected", "missing_runs", "days")))


def semantic(runs: DataFrame) -> DataFrame:
    """One row: runs with and without similarity figures, their sums, and the largest history scores."""
    s = stage_counts(runs)
    has = F.col("has_semantic")
    score = F.when(has & (F.col("stats.max_history_score") != 0), F.round("stats.max_history_score", 4))
    return s.agg(
        F.count_if(has).alias("runs_with_data"),
        F.count_if(~has).alias("runs_without_data"),
        F.coalesce(F.sum(F.when(has, F.col("cut"))), F.lit(0)).alias("dropped"),
        F.coalesce(F.sum(F.when(has, F.coalesce("stats.semantic_suspect", F.lit(0)))), F.lit(0)).alias("suspect"),
        F.max(score).alias("top_history_score"),
        F.avg(score).alias("mean_history_score"),
    )


def semantic_details(runs: DataFrame) -> DataFrame:
    """(date, kind, pos, detail): the rounded history scores and the dropped and suspect items that the runs tell."""
    score = runs.where(F.coalesce("stats.max_history_score", F.lit(0.0)) != 0).select("date", F.lit("score").alias("kind"), F.lit(0).alias("pos"), F.round("stats.max_history_score", 4).cast("string").alias("detail"))
    for kind in ("dropped", "suspect"):
        score = score.unionByName(runs.select("date", F.lit(kind).alias("kind"), F.posexplode(f"stats.{kind}_detail").alias("pos", "detail")))
    return score


def issues(runs: DataFrame) -> DataFrame:
    """(date, kind, detail): warnings, sources without rows, failed runs and failed deliveries."""
    ok = F.coalesce(F.col("status") == "succeeded", F.lit(False))
    each = lambda field, kind: runs.select("date", F.lit(kind).alias("kind"), F.explode(f"stats.{field}").alias("detail"))
    failed = runs.where(~ok).select("date", F.lit("failed").alias("kind"), F.coalesce(F.nullif("error", F.lit("")), "status").alias("detail"))
    unsent = runs.where(ok & ~F.coalesce(F.col("push.ok"), F.lit(False))).select("date", F.lit("push").alias("kind"), F.col("push.detail").alias("detail"))
    return each("warnings", "warning").unionByName(each("missing_sources", "missing")).unionByName(failed).unionByName(unsent)


def render(runs: DataFrame) -> str:
    """The report's Markdown, from the small result frames."""
    s = summary(runs).select("*", ratio_text(F.col("after_url_dedup"), F.col("merged_raw")).alias("r1"), ratio_text(F.col("pushed"), F.col("selected")).alias("r2")).first()
    lines = [f"# Report on {s['runs']} runs", "", f"{s['succeeded']} succeeded, {s['failed']} failed; {s['push_ok']} delivered; {s['total_tokens']} tokens; {s['elapsed_seconds']} s", "", "| stage | rows |", "| --- | --- |"]
    lines += [f"| {k} | {s[k]} |" for k in ("merged_raw", "after_url_dedup", "selected", "semantic_kept", "pushed")]
    lines += ["", f"After URL dedup {s['r1']} of the raw rows; {s['r2']} of the selected rows delivered.", "", "| source | raw | selected | zero runs | runs |", "| --- | --- | --- | --- | --- |"]
    lines += [f"| {r['source']} | {r['raw']} | {r['selected']} | {r['missing_runs']} | {r['days']} |" for r in sources(runs).orderBy("source").collect()]
    lines += ["", "## Issues", ""]
    lines += [f"- {r['date']} {r['kind']}: {r['detail']}" for r in issues(runs).orderBy("date", "kind", "detail").limit(200).collect()] or ["none"]
    return "\n".join(lines)


def as_json(runs: DataFrame, details: int = 200) -> str:
    """The report as JSON: the same frames as render(), and at most ``details`` scores and items of each kind."""
    rows = lambda df, *order: [json.loads(r[0]) for r in df.orderBy(*order).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]
    told = semantic_details(runs)
    parts = {
        "summary": rows(summary(runs), "runs")[0],
        "runs": rows(by_run(runs), "date", "status"),
        "sources": rows(sources(runs), "source"),
        "semantic": rows(semantic(runs), "runs_with_data")[0] | {k: rows(told.where(F.col("kind") == k).orderBy("date", "pos").limit(details), "date", "pos") for k in ("score", "dropped", "suspect")},
        "issues": rows(issues(runs).orderBy("date", "kind", "detail").limit(details), "date", "kind", "detail"),
    }
    return json.dumps(parts, ensure_ascii=False, indent=2)
