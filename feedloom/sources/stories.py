"""Stories from JSON payloads of unknown shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.text import clip, collapse
from feedloom.functions.time import MAX_SHOWN, format_local, format_utc, unix_seconds
from feedloom.functions.url import feed_key, host_of
from feedloom.operators.dedup import gap_fill_merge, max_items_prefix

#: Where a payload's list may be, and the names that a field may have, best first.
LISTS = ["hits", "stories", "items", "results", "data", "list", "articles"]
NAMES = {
    "title": ["title", "story_title", "name", "headline"],
    "url": ["url", "story_url", "link", "permalink", "href"],
    "id": ["id", "objectID", "object_id", "story_id"],
    "time": ["time", "created_at_i", "timestamp", "published_at", "published", "date", "created_at"],
    "author": ["by", "author", "user", "username"],
    "score": ["score", "points", "votes"],
    "comments": ["descendants", "num_comments", "comments_count", "comments"],
    "source": ["source", "site", "publisher", "domain"],
    "text": ["story_text", "text", "description", "summary", "content"],
}
MAX_DEPTH = 4
PAGE_OF_ID, NO_HOST = "https://news.ycombinator.com/item?id=", "Hacker News"
MERGED = ["time", "time_iso", "time_unix", "source", "id", "author", "score", "comments"]


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _text(v: Column, name: str) -> Column:
    """A scalar field as clean text; booleans, null and containers are empty."""
    x = F.try_variant_get(v, f"$.{name}", "variant")
    kind = F.coalesce(_kind(x), F.lit("VOID"))
    plain = ~kind.startswith("OBJECT") & ~kind.startswith("ARRAY") & ~kind.isin("VOID", "BOOLEAN")
    number = F.try_variant_get(v, f"$.{name}", "string")
    # a double keeps its fraction mark
    whole = kind.isin("DOUBLE", "FLOAT") & ~number.rlike(r"[.eE]")
    return F.when(plain, collapse(F.when(whole, F.concat(number, F.lit(".0"))).otherwise(number))).otherwise("")


def field(v: Column, what: str) -> Column:
    """The first name of the field that has a non-empty scalar."""
    return F.coalesce(*(F.nullif(_text(v, n), F.lit("")) for n in NAMES[what]), F.lit(""))


def payload_items(bodies: DataFrame, body: str, keys: list[str], max_depth: int = MAX_DEPTH) -> DataFrame:
    """(keys, pos, item variant): the entries of each JSON payload, in order.

    A payload is a list, an object with a list under one of LISTS, an object of objects, or one item; a JSON
    string inside stands for its content. A payload is unwrapped inside its row, up to max_depth levels, and its
    entries come out of one generator at the end; what is not JSON has no entries.
    """
    none = F.lit(None)
    level = bodies.select(*keys, F.try_parse_json(F.col(body)).alias("raw"), none.cast("variant").alias("found"), none.cast("string").alias("state"))
    for depth in range(max_depth + 1):
        quoted = F.try_parse_json(F.try_variant_get("raw", "$", "string"))
        level = settled(level, v=F.when((_kind(F.col("raw")) == "STRING") & F.lit(depth < max_depth), quoted).otherwise(F.col("raw"))).drop("raw")
        level = settled(level, kind=F.coalesce(_kind(F.col("v")), F.lit("VOID")), titled=F.coalesce(*(F.try_variant_get("v", f"$.{n}", "variant") for n in NAMES["title"] + NAMES["url"] + NAMES["id"])).isNotNull(), **{f"in_{n}": F.try_variant_get("v", f"$.{n}", "variant") for n in LISTS})
        level = settled(level, inner=F.coalesce(*(F.when(_kind(F.col(f"in_{n}")).rlike("^(ARRAY|OBJECT)"), F.col(f"in_{n}")) for n in LISTS)))
        is_object = F.col("kind").startswith("OBJECT")
        wraps = is_object & F.col("inner").isNotNull()
        here = F.when(F.col("kind").startswith("ARRAY"), "list").when(is_object & ~F.col("titled"), "objects").when(is_object, "item").otherwise("none")
        # what was settled at an earlier level has a null here from then on
        ends = F.col("state").isNull() & ~wraps
        level = level.select(*keys, F.when(wraps, F.col("inner")).alias("raw"), F.when(ends, F.col("v")).otherwise(F.col("found")).alias("found"), F.when(ends, here).otherwise(F.col("state")).alias("state"))
    state, v = F.col("state"), F.col("found")
    entries = F.when(state == "item", F.array("found")).when(state == "list", F.try_variant_get(v, "$", "array<variant>")).when(state == "objects", F.map_values(F.try_variant_get(v, "$", "map<string,variant>")))
    out = level.select(*keys, "state", F.posexplode(entries).alias("i", "item"))
    return out.where((F.col("state") != "objects") | _kind(F.col("item")).startswith("OBJECT")).select(*keys, F.array("i").alias("pos"), "item")


def settled(df: DataFrame, **cols: Column) -> DataFrame:
    """Adds columns behind a generator, so that later steps refer to them and the optimizer does not repeat their expressions."""
    made = F.explode(F.array(F.struct(*(c.alias(n) for n, c in cols.items()))))
    return df.select("*", made.alias("_made")).select(*(c for c in df.columns if c not in cols), "_made.*")


def build_stories(items: DataFrame, keys: list[str], offset_hours: float = 8.0, strftime: str = "%Y-%m-%d %H:%M") -> DataFrame:
    """items plus the story fields; ``ok`` is false for entries without a title, or with neither URL nor id."""
    v = F.col("item")
    raw = settled(items, _object=_kind(v).startswith("OBJECT"))
    for n in NAMES:  # one by one, which keeps the generated code of each step small
        raw = settled(raw, **{"_" + n: field(v, n)})
    raw = raw.drop("item")
    made = F.col("_url") == ""
    url = F.when(made & (F.col("_id") != ""), F.concat(F.lit(PAGE_OF_ID), F.col("_id"))).otherwise(F.col("_url"))
    raw = settled(raw, url=url, _sec=unix_seconds("_time"))
    source = F.when(F.col("_source") != "", F.col("_source")).when(made, NO_HOST).otherwise(F.coalesce(F.nullif(host_of("url"), F.lit("")), F.lit(NO_HOST)))
    number = lambda c: F.col(c).try_cast("double").cast("bigint")
    return raw.select(
        *keys,
        "pos",
        (F.col("_object") & (F.col("_title") != "") & (F.col("url") != "")).alias("ok"),
        F.col("_title").alias("title"),
        "url",
        format_local("_time", offset_hours, strftime).alias("time"),
        source.alias("source"),
        F.col("_id").alias("id"),
        F.col("_author").alias("author"),
        F.when(F.abs(F.col("_score").try_cast("double")) < 9e18, number("_score")).alias("score"),
        F.when(F.abs(F.col("_comments").try_cast("double")) < 9e18, number("_comments")).alias("comments"),
        clip("_text").alias("text"),
        format_utc("_time").alias("time_iso"),
        F.when(F.abs("_sec") < 9e18, F.col("_sec").cast("bigint")).alias("time_unix"),
    )


def parse(bodies: DataFrame, body: str = "body", offset_hours: float = 8.0, strftime: str = "%Y-%m-%d %H:%M", max_items: int = 0) -> DataFrame:
    """Stories of one payload table (one row per payload is one feed), merged by their feed key, with ord from 0."""
    b = bodies.withColumn("_feed", F.lit(0)) if "_feed" not in bodies.columns else bodies
    built = build_stories(payload_items(b, body, ["_feed"]), ["_feed"], offset_hours, strftime).where("ok")
    keyed = built.withColumn("_key", F.concat(F.lit("url:"), feed_key("url"))).drop("ok")
    read = max_items_prefix(keyed, "_key", ["_feed", "pos"], max_items)
    merged = gap_fill_merge(read, "_key", ["_feed", "pos"], MERGED)
    # places inside each payload, after the stories of the payloads before it: one row per payload meets in a task
    before = merged.groupBy("_feed").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.sum("_n").over(Window.orderBy("_feed")) - F.col("_n"))
    placed = merged.withColumn("_rn", F.row_number().over(Window.partitionBy("_feed").orderBy("pos"))).join(before, "_feed")
    return placed.withColumn("ord", (F.col("_before") + F.col("_rn") - 1).cast("int")).drop("_key", "_feed", "pos", "_rn", "_n", "_before")


def counts(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row: entries, skipped entries, stories and merged duplicates of all payloads."""
    b = bodies.withColumn("_feed", F.lit(0)) if "_feed" not in bodies.columns else bodies
    built = build_stories(payload_items(b, body, ["_feed"]), ["_feed"])
    key = F.when(F.col("ok"), feed_key("url"))
    return built.agg(F.count(F.lit(1)).alias("entries"), F.count_if(~F.col("ok")).alias("skipped"), F.countDistinct(key).alias("count"), (F.count_if("ok") - F.countDistinct(key)).alias("deduplicated"))


__all__ = ["MAX_SHOWN", "build_stories", "counts", "field", "parse", "payload_items"]
