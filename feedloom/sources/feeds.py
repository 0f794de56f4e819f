"""RSS and Atom feeds, history lists, embeddings, run logs, pages and the inbox."""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions.text import clean_markup, clip, collapse, looks_like_html
from feedloom.operators import html

#: What is said of a feed that is a web page (fixed value).
PAGE_WARNING = " 返回的是网页不是 RSS，feed 地址可能已经失效"
ATOM = "{http://www.w3.org/2005/Atom}"


def feed_items(feeds: DataFrame) -> DataFrame:
    """Items of (origin, weight, body) feeds: RSS items first, then Atom entries; malformed XML has none.

    A strict XML parser rejects a document with text after its root, which the built-in reader does not, so
    the tree is read by the standard library; cleaning stays native.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for origin, weight, body in zip(pdf["origin"], pdf["weight"], pdf["body"], strict=True):
                try:
                    root = ET.fromstring((body or "").strip())
                except ET.ParseError:
                    continue
                text = lambda n, tag: n.findtext(tag) or ""
                found = [(text(n, "title"), text(n, "link"), text(n, "pubDate"), text(n, "description")) for n in root.iter("item")]
                for n in root.iter(ATOM + "entry"):
                    link = n.find(ATOM + "link")
                    found.append((text(n, ATOM + "title"), "" if link is None else link.get("href") or "", text(n, ATOM + "updated"), text(n, ATOM + "summary")))
                rows += [(origin, weight, i, *f) for i, f in enumerate(found)]
            yield pd.DataFrame(rows, columns=["origin", "weight", "pos", "title", "url", "published", "raw"])

    raw = feeds.select("origin", "weight", "body").mapInPandas(run, "origin string, weight int, pos bigint, title string, url string, published string, raw string")
    clean = raw.select(clean_markup("title").alias("title"), F.trim("url").alias("url"), "origin", F.trim("published").alias("published"), clip(clean_markup("raw")).alias("raw"), "weight", F.lit(0).cast("bigint").alias("score"), F.col("pos").alias("ord"))
    return clean.where("title <> '' and url <> ''")


def story_items(stories: DataFrame, origin: str = "HN", weight: int = 3) -> DataFrame:
    """Stories as items."""
    out = stories.select(
        clean_markup("title").alias("title"),
        F.trim("url").alias("url"),
        F.lit(origin).alias("origin"),
        F.coalesce(F.nullif("time_iso", F.lit("")), "time").alias("published"),
        clip(clean_markup("text")).alias("raw"),
        F.lit(weight).alias("weight"),
        F.coalesce("score", F.lit(0)).alias("score"),
        F.col("ord").cast("bigint").alias("ord"),
    )
    return out.where("title <> '' and url <> ''")


def history_rows(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(pos, url, title, raw, origin) of history texts: a JSON array, one object, or JSON Lines; bad lines are skipped."""
    whole = F.try_parse_json(F.col(body))
    kind = F.coalesce(F.schema_of_variant(whole), F.lit(""))
    listed = F.try_variant_get(whole, "$", "array<variant>")
    lines = F.transform(F.split(F.coalesce(F.col(body), F.lit("")), "\n"), lambda x: F.try_parse_json(x))
    rows = F.when(kind.startswith("ARRAY"), listed).when(kind.startswith("OBJECT"), F.array(whole)).otherwise(lines)
    got = bodies.select(F.posexplode(rows).alias("pos", "v")).where(F.coalesce(F.schema_of_variant("v"), F.lit("")).startswith("OBJECT"))
    text = lambda n: collapse(F.try_variant_get("v", f"$.{n}", "string")).alias(n)
    return got.select("pos", text("url"), text("title"), text("raw"), text("origin"))


def embedding_rows(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(url, vector) of JSON objects from URL to a list, or to an object of numbered entries; zero vectors are left out."""
    flat = F.from_json(F.col(body), "map<string,array<double>>")
    keyed = F.from_json(F.col(body), "map<string,map<string,double>>")
    a = bodies.select(F.explode(flat).alias("url", "vector"))
    b = bodies.select(F.explode(keyed).alias("url", "m")).where("m is not null")
    entries = F.array_sort(F.transform(F.map_entries("m"), lambda e: F.struct(e["key"].try_cast("int").alias("i"), e["value"].alias("x"))))
    b = b.select("url", F.transform(entries, lambda e: e["x"]).alias("vector"))
    both = a.where("vector is not null").unionByName(b)
    return both.where(F.exists("vector", lambda x: x != 0) & F.forall("vector", lambda x: x.isNotNull()))


def run_logs(spark: SparkSession, path: str) -> DataFrame:
    """Run logs of a folder of JSON files, stats parsed, broken files left out, ordered columns date and file."""
    raw = spark.read.text(path, wholetext=True).select(
        F.from_json("value", schemas.RUN_LOG + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"),
        F.col("_metadata.file_name").alias("file"),
    )
    ok = raw.where("r is not null and r._bad is null").select("r.*", "file").drop("_bad")
    return ok.withColumn("stats", F.coalesce(F.from_json("stats", schemas.RUN_STATS), F.from_json(F.lit("{}"), schemas.RUN_STATS)))


def history_mirror(spark: SparkSession, path: str, as_of: Column, days: int) -> DataFrame:
    rows = spark.read.schema("url string, date string, title string").json(path)
    return rows.where(F.coalesce("date", F.lit("")) >= F.date_format(F.date_sub(as_of, days), "yyyy-MM-dd"))


def page_text(content: Column, content_type: Column, encoding: Column) -> Column:
    """The text of bytes as served: unpacked, in the charset of the header, else of the first 4096 bytes, else UTF-8."""

    @F.pandas_udf("string")
    def text(content: pd.Series, kind: pd.Series, encoding: pd.Series) -> pd.Series:
        return pd.Series([None if b is None else decoded(bytes(b), k or "", e or "") for b, k, e in zip(content, kind, encoding, strict=True)], dtype=object)

    return text(content, F.coalesce(content_type, F.lit("")), F.coalesce(encoding, F.lit("")))


def decoded(raw: bytes, content_type: str = "", encoding: str = "") -> str:
    """See page_text; bytes that are not packed as they say are read as they are."""
    try:
        if "gzip" in encoding:
            raw = zlib.decompress(raw, zlib.MAX_WBITS | 16)
        elif "deflate" in encoding:
            raw = zlib.decompress(raw, zlib.MAX_WBITS if raw[:1] and raw[0] & 15 == 8 and not int.from_bytes(raw[:2], "big") % 31 else -zlib.MAX_WBITS)
    except zlib.error:
        pass
    found = re.search(r"charset=([\w-]+)", content_type, re.I) or re.search(r"charset=[\"']?([\w-]+)", raw[:4096].decode("latin-1"), re.I)
    name = found[1].lower() if found else "utf-8"
    try:
        return raw.decode("gb18030" if name in ("gb2312", "gbk") else name, "replace")
    except LookupError:
        return raw.decode("utf-8", "replace")


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) of a folder of page files."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("url"), page_text(F.col("content"), F.lit(""), F.lit("")).alias("html"))


def feed_report(feeds: DataFrame, items: DataFrame) -> DataFrame:
    """(origin, raw, warning): items of each feed (origin, body), and a warning where a feed is a web page."""
    n = items.groupBy("origin").agg(F.count(F.lit(1)).alias("raw"))
    page = F.max(looks_like_html("body")).alias("_page")
    return feeds.groupBy("origin").agg(page).join(n, "origin", "left").select("origin", F.coalesce("raw", F.lit(0)).alias("raw"), F.when(F.col("_page"), F.concat("origin", F.lit(PAGE_WARNING))).alias("warning"))


#: Links of an XML page that are shown (fixed value).
SHOWN = 80


def page_records(pages: DataFrame, most: int = 200_000) -> DataFrame:
    """Records of schemas.PAGE of (url, content_type, body): JSON as a block, XML as a list of links, else the article.

    JSON that does not parse is plain text. A null body is an empty page.
    """
    p = pages.select("url", F.coalesce("content_type", F.lit("")).alias("content_type"), F.coalesce("body", F.lit("")).alias("body"))
    p = p.withColumn("kind", content_kind(F.col("content_type"), F.col("body")))
    none = lambda *names: [F.lit("").alias(n) for n in names]
    blank = none("title", "site_name", "description", "author", "published", "canonical")

    @F.pandas_udf("string")
    def pretty(s: pd.Series) -> pd.Series:
        def one(x: str) -> str | None:
            try:
                return json.dumps(json.loads(x), ensure_ascii=False, indent=2)
            except ValueError:
                return None

        return s.map(one)

    block = p.where("kind = 'json'").withColumn("_json", pretty("body"))
    shown = F.when(F.col("_json").isNull(), F.left("body", F.lit(most))).otherwise(F.concat(F.lit("```json\n"), F.left("_json", F.lit(most)), F.lit("\n```")))
    as_json = block.select("url", *blank, F.when(F.col("_json").isNull(), "text").otherwise("json").alias("kind"), shown.alias("markdown"), shown.alias("text"), F.length("body").cast("bigint").alias("char_count"))
    tag = lambda t: F.regexp_extract_all("body", F.lit(rf"(?s)<{t}[^>]*>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</{t}>"), F.lit(1))
    titles, links = tag("title"), tag("link")
    n = F.least(F.size(titles), F.size(links))
    line = F.transform(F.slice(F.arrays_zip(titles.alias("t"), links.alias("l")), 1, F.least(n, F.lit(SHOWN))), lambda x: F.concat(F.lit("- ["), collapse(_unescaped(x["t"])), F.lit("]("), F.trim(x["l"]), F.lit(")")))
    listed = F.left(F.concat_ws("\n", F.concat(F.lit("# RSS/XML："), n.cast("string"), F.lit(" 条")), F.lit(""), line), F.lit(most))
    as_xml = p.where("kind = 'xml'").select("url", *blank, "kind", listed.alias("markdown"), F.length("body").cast("bigint").alias("char_count"))
    as_xml = as_xml.withColumn("text", F.col("markdown"))
    article = html.extract(p.where("kind = 'html'").select("url", "kind", F.col("body").alias("html")), most=most)
    columns = [f.split()[0] for f in schemas.PAGE.split(", ")]
    return article.select(*columns).unionByName(as_json.select(*columns)).unionByName(as_xml.select(*columns))


def _unescaped(c: Column) -> Column:
    """The five references that XML defines, the ampersand last."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(char))
    return c


def inbox(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Pages pushed as JSON Lines, with received_at; as a stream if asked."""
    schema = "received_at string, url string, title string, markdown string, text string, selection string, lang string"
    return (spark.readStream if streaming else spark.read).schema(schema).json(path)


def offline_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """(name, body) of the feed files of a folder."""
    return spark.read.text(folder, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^(.*?)\.[^.]*$", 1).alias("name"), F.col("value").alias("body"))


def content_kind(content_type: Column, body: Column) -> Column:
    """json, xml or html, by the content type or the first letter."""
    t, head = F.lower(F.coalesce(content_type, F.lit(""))), F.left(F.regexp_replace(F.coalesce(body, F.lit("")), r"(?U)^\s+", ""), F.lit(5))
    return F.when(t.contains("json") | head.rlike(r"^[{\[]"), "json").when((t.contains("xml") & ~t.contains("html")) | (head == "<?xml"), "xml").otherwise("html")
