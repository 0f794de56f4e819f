"""Text functions, all native column expressions unless noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNIPPET = 400
#: Words without meaning for similarity.
STOPWORDS_LATIN = "the a an of for and or to in on at by with from is are was were be it its this that as new how why what your you we".split()
STOPWORDS_CJK = list("的了是在和与对就都而及")
#: Entities in the order in which they are replaced.
ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]
#: Section words of a report.
SECTIONS = ["今日头条", "重要进展", "值得关注", "链接汇总"]

_LATIN = r"[a-z0-9]+(?:[.\-_/][a-z0-9]+)*"
_CJK = r"[一-鿿]+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse(c: Column | str) -> Column:
    """Runs of Unicode white space become one space; ends are trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)\s+", " "))


def clean_markup(c: Column | str) -> Column:
    """Tags become spaces, six entities are decoded in order, white space collapses."""
    out = F.regexp_replace(F.coalesce(col(c), F.lit("")), "<[^>]+>", " ")
    for name, char in ENTITIES:
        out = F.replace(out, F.lit(name), F.lit(char))
    return collapse(out)


def clip(c: Column | str, n: int = SNIPPET) -> Column:
    return F.left(col(c), F.lit(n))


def latin_tokens(c: Column | str, collapsed: bool = False) -> Column:
    found = F.regexp_extract_all(F.lower(col(c) if collapsed else collapse(c)), F.lit(_LATIN), F.lit(0))
    return F.filter(found, lambda w: (F.length(w) >= 2) & ~w.isin(STOPWORDS_LATIN))


def cjk_tokens(c: Column | str, collapsed: bool = False) -> Column:
    """Per run of CJK letters: its letters but stopwords, then its overlapping pairs."""

    def of(run: Column) -> Column:
        letters = F.filter(F.split(run, ""), lambda x: (x != "") & ~x.isin(STOPWORDS_CJK))
        n = F.length(run)
        pairs = F.when(n >= 2, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(run, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
        return F.concat(letters, pairs)

    return F.flatten(F.transform(F.regexp_extract_all(col(c) if collapsed else collapse(c), F.lit(_CJK), F.lit(0)), of))


def tokens(c: Column | str, collapsed: bool = False) -> Column:
    return F.concat(latin_tokens(c, collapsed), cjk_tokens(c, collapsed))


def strip_wrappers(c: Column | str) -> Column:
    """Drops reasoning blocks, comments, an outer code fence and escaped closing brackets after links."""
    ends = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    body = ends(F.coalesce(col(c), F.lit("")))
    body = F.regexp_replace(body, r"(?is)<think>.*?</think>", " ")
    body = ends(F.regexp_replace(body, r"(?is)<!--.*?-->", " "))
    bare = F.regexp_replace(F.regexp_replace(body, r"^```[a-zA-Z]*[ \t]*\r?\n", ""), r"\r?\n?```[ \t]*\n?\z", "")
    body = F.when(body.startswith("```"), bare).otherwise(body)
    return ends(F.regexp_replace(body, r"(https?://[^\s)]*?)\\\)", "$1)"))


def looks_like_html(c: Column | str) -> Column:
    head = F.lower(F.left(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)^\s+", ""), F.lit(200)))
    return head.startswith("<!doctype html") | head.startswith("<html")


def looks_like_report(c: Column | str) -> Column:
    """Holds a link and at least two section words."""
    from .url import extract_urls

    found = sum((F.coalesce(col(c), F.lit("")).contains(w).cast("int") for w in SECTIONS[1:]), F.coalesce(col(c), F.lit("")).contains(SECTIONS[0]).cast("int"))
    return (F.size(extract_urls(c)) > 0) & (found >= 2)


def as_list(c: Column | str) -> Column:
    """A JSON list of strings, else the string itself as the only entry; blank gives none."""
    return F.when(F.trim(F.coalesce(col(c), F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.coalesce(F.from_json(col(c), "array<string>"), F.array(col(c))))


def ratio_text(part: Column, whole: Column) -> Column:
    """A percentage with one decimal, or a dash where the whole is not positive."""
    ok = whole.isNotNull() & part.isNotNull() & (whole > 0)
    return F.when(ok, F.format_string("%.1f%%", F.try_divide(part.cast("double"), whole.cast("double")) * 100)).otherwise("—")


def importance(weight: Column) -> Column:
    """The weight clamped to 1..5; null and 0 count as 3."""
    return F.least(F.lit(5), F.greatest(F.lit(1), F.coalesce(F.nullif(weight, F.lit(0)), F.lit(3)))).cast("int")
