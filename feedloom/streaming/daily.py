"""The daily run and its micro-batch: new items, delivery, then state; state only moves after a delivery."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom import schemas
from feedloom.operators import digest, similar, store
from feedloom.plans import daily
from feedloom.sources import feeds, sinks
from feedloom.sources.state import cut, versions

#: Delivers one report; true, or true and what to note, if it arrived.
Deliver = Callable[[str], "bool | tuple[bool, str]"]
#: Writes a report from the items' JSON; the text and the tokens it took.
Writer = Callable[[str], "tuple[str, int]"]
#: Characters of a snippet that history gives to similarity dedup (fixed value).
SNIPPET = 128


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of the store, or an empty one."""
    done = versions(spark, path)
    if not done:
        return spark.createDataFrame([], schemas.ARTICLE)
    return spark.read.schema(schemas.ARTICLE).parquet(f"{path}/v{done[-1]:012d}")


def write_state(state: DataFrame, path: str) -> None:
    """The version after the newest; a run that is repeated finds its items known."""
    done = versions(state.sparkSession, path)
    sinks.write_state(state, f"{path}/v{(done[-1] if done else -1) + 1:012d}")


def _mirror(spark: SparkSession, path: str | None, run_date: str, days: int) -> DataFrame | None:
    if path is None:
        return None
    try:
        return feeds.history_mirror(spark, path, F.to_date(F.lit(run_date)), days)
    except AnalysisException:  # no mirror yet
        return None


def history(spark: SparkSession, state_path: str, mirror_path: str | None, run_date: str, days: int = store.DAYS) -> DataFrame:
    """(url_key, url, title, origin, raw) of the window, from the store; from the mirror, without snippets, where the
    store cannot be read or holds nothing in the window."""
    try:
        rows = store.window(read_state(spark, state_path), F.to_date(F.lit(run_date)), days).select("url_key", "url", "title", F.col("source").alias("origin"), F.left("raw", F.lit(SNIPPET)).alias("raw"))
        if rows.limit(1).count():
            return rows
    except Exception as e:  # noqa: BLE001 - a broken store must not stop the day
        print(f"the store cannot be read ({type(e).__name__}); its mirror serves")
        rows = spark.createDataFrame([], "url_key string, url string, title string, origin string, raw string")
    old = _mirror(spark, mirror_path, run_date, days)
    return rows if old is None else store.from_history(old, F.current_date()).select("url_key", "url", "title", F.col("source").alias("origin"), "raw")


def merged_stats(parsed: dict, semantic: dict) -> dict:
    """Counts of both steps; those of similarity dedup fill gaps only."""
    return semantic | parsed


def run_day(
    items: list[DataFrame],
    run_date: str,
    state_path: str,
    outbox_path: str,
    deliver: Deliver,
    mirror_path: str | None = None,
    log_path: str | None = None,
    embeddings: DataFrame | None = None,
    writer: Writer | None = None,
    warnings: list[str] | None = None,
    days: int = store.DAYS,
    dry_run: bool = False,
    push: bool = True,
    use_history: bool = True,
    sources: dict[str, str] | None = None,
) -> dict:
    """One daily run over the feeds' items, in their fixed order: select, dedup, write, deliver, record. Its run record.

    dry_run only reads history. push=False makes the report and leaves state, mirror and log alone. use_history=False
    ignores what was pushed. A failure of any step before delivery is logged and changes nothing else; a failed delivery
    goes to the outbox and leaves the state, so its items come again. Where the state cannot be written the mirror is.
    """
    spark, began = items[0].sparkSession, time.time()
    record: dict = {"date": run_date}
    known = cut(history(spark, state_path, mirror_path, run_date, days)) if use_history else None
    record["history_used"] = known.count() if known is not None else 0
    if dry_run:
        return record | {"status": "dry-run"}
    try:
        every = cut(daily.united(items))
        kept = daily.candidates(every, None if known is None else known.select("url_key"))
        selected = cut(daily.selection(every, None if known is None else known.select("url_key")))
        past = None if known is None else known.where("title <> ''").select(F.xxhash64("url_key").bitwiseAND((1 << 59) - 1).alias("ord"), "title", "url", "origin", "raw")
        judged = cut(daily.decided(selected, past, embeddings))
        vec = [None if x is None else similar.vectors_for(x, embeddings) for x in (selected.select(F.col("index").cast("bigint").alias("ord"), "title", "url", "origin", "raw"), past)]
        parsed = json.loads(daily.stats(every, kept, selected, sources, warnings).select(F.to_json(F.struct("*"))).first()[0])
        semantic = json.loads(similar.dedup_stats(judged, vec[1], vec[0]).select(F.to_json(F.struct("*"))).first()[0])
        semantic |= {f"{k}_detail": [json.dumps(x, ensure_ascii=False) for x in semantic.get(f"{k}_detail", [])] for k in ("dropped", "suspect")}
        semantic |= {"semantic_history": record["history_used"], "semantic_encoder": "lexical" if embeddings is None else "embedding+lexical", "dup_threshold": similar.DUP, "gray_low": similar.GRAY}
        stays = judged.where("action <> 'drop'")
        text, tokens = None, 0
        if writer is not None:
            listed = stays.orderBy("ord").select(F.to_json(F.struct("ord", "title", "url", "origin", "weight", "score", "raw", "action", "similarity"))).collect()
            written, tokens = writer("[" + ",".join(r[0] for r in listed) + "]")
            text = F.lit(written)
        markdown = daily.report(text, stays, run_date).first()["markdown"]
        pushed = cut(digest.pushed_items(spark.createDataFrame([(1, markdown)], "report int, markdown string"), stays))
        urls = [r["url"] for r in pushed.orderBy("pos").select("url").collect()]
    except Exception as e:  # noqa: BLE001 - any failure is a record
        record |= {"status": "exception", "error": f"{type(e).__name__}: {str(e)[:500]}"}
        if push and log_path:
            sinks.append_record(spark, record, log_path)
        return record
    record |= {"status": "succeeded", "elapsed_seconds": round(time.time() - began, 1), "total_tokens": tokens, "count": len(urls), "pushed_urls": urls}
    record["stats"] = json.dumps(merged_stats(parsed, semantic), ensure_ascii=False)
    if not push:
        return record | {"push": {"ok": True, "detail": "no push"}, "markdown": markdown}
    got = deliver(markdown)
    ok, detail = got if isinstance(got, tuple) else (bool(got), "")
    record["push"] = {"ok": ok, "detail": detail}
    if not ok:
        sinks.write_outbox(spark.createDataFrame([(run_date, markdown)], "date string, markdown string"), outbox_path)
        record["outbox"] = outbox_path
    elif urls:
        _commit(spark, pushed, run_date, state_path, mirror_path, days)
    if log_path:
        sinks.append_record(spark, record, log_path)
    return record


def _commit(spark: SparkSession, pushed: DataFrame, run_date: str, state_path: str, mirror_path: str | None, days: int) -> None:
    as_of = F.to_date(F.lit(run_date))
    rows = pushed.select(F.col("url").alias("url_key"), "url", as_of.alias("run_date"), F.col("origin").alias("source"), "title", "raw", F.to_timestamp(F.lit(run_date)).alias("pushed_at"), F.col("pos").alias("ord"))
    old = _mirror(spark, mirror_path, run_date, days)
    try:
        state = read_state(spark, state_path)
        if old is not None and not versions(spark, state_path):  # the first run takes the legacy list over
            state = store.from_history(old, as_of)
        write_state(store.prune(store.upsert(state, rows), as_of, days), state_path)
        if mirror_path:
            sinks.write_mirror(cut(store.window(read_state(spark, state_path), as_of, days)), mirror_path)
    except Exception as e:  # noqa: BLE001 - what was delivered must be remembered somewhere
        if not mirror_path:
            raise
        print(f"the store cannot be written ({type(e).__name__}); its mirror is")
        old = spark.createDataFrame([], "url string, date string, title string") if old is None else old
        sinks.write_legacy(cut(store.merged_history(old, pushed, run_date)), mirror_path)


def process(batch: DataFrame, batch_id: int, state_path: str, outbox_path: str, deliver: Deliver, run_date: str, days: int = store.DAYS, dry_run: bool = False, **options) -> dict:
    """One batch of items as a daily run. A replayed batch finds what it delivered in the state."""
    out = run_day([batch], run_date, state_path, outbox_path, deliver, days=days, push=not dry_run, **options)
    if out["status"] == "exception":
        raise RuntimeError(out["error"])
    return out | {"delivered": not dry_run and out["push"]["ok"]}


def run(items: DataFrame, state_path: str, outbox_path: str, checkpoint: str, deliver: Deliver, run_date: str, **options) -> StreamingQuery:
    """Processes all new items of a stream once."""
    return (
        items.writeStream.foreachBatch(lambda df, i: process(df, i, state_path, outbox_path, deliver, run_date, **options) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
