"""URL keys and links as native column expressions.

Two canonical forms exist. The feed form has no scheme, folds host prefixes and aliases, keeps ports and blank
parameters and sorts parameters. The store form has https, drops only www and ports, drops blank parameters
and keeps their order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, collapse

#: Parameters that only track, for the feed form and (besides any utm_*) for the store form.
TRACKING_FEED = "utm_source utm_medium utm_campaign utm_term utm_content utm_id utm_name fbclid gclid igshid mc_cid mc_eid ref ref_src spm".split()
TRACKING_STORE = "ref fbclid gclid spm from source share_token".split()
#: Host names that mean another host, after the prefix is gone.
HOST_ALIASES = {
    "x.com": "twitter.com",
    "mobile.twitter.com": "twitter.com",
    "m.twitter.com": "twitter.com",
    "old.reddit.com": "reddit.com",
    "np.reddit.com": "reddit.com",
    "www.reddit.com": "reddit.com",
}
#: Punctuation that ends a sentence after a link, not the link.
TRAILING = ".,;:!?、。；：！？\\"

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"
_AUTHORITY = r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
_REST = r"(?s)^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//[^/?#]*"


def with_scheme(c: Column) -> Column:
    """https:// before a URL that has no // in front of its query."""
    return F.when(F.substring_index(c, "?", 1).contains("//"), c).otherwise(F.concat(F.lit("https://"), c))


def authority(c: Column) -> Column:
    """Host and port, without user info."""
    return F.regexp_replace(F.regexp_extract(c, _AUTHORITY, 1), r"(?s)^.*@", "")


def raw_host(c: Column) -> Column:
    a = authority(c)
    v6 = F.regexp_extract(a, r"^\[([^\]]*)\]", 1)
    return F.lower(F.when(v6 != "", v6).otherwise(F.substring_index(a, ":", 1)))


def port(c: Column) -> Column:
    """The port as text, empty if there is none, it is 0 or no number."""
    p = F.regexp_extract(authority(c), r":(\d+)$", 1)
    n = F.try_to_number(F.when(p == "", F.lit(None)).otherwise(F.right(p, F.lit(9))), F.lit("999999999")).cast("int")
    return F.coalesce(F.when((n > 0) & (n <= 65535), n.cast("string")), F.lit(""))


def path(c: Column) -> Column:
    """Without trailing slashes; / if nothing is left."""
    p = F.regexp_replace(F.regexp_extract(F.regexp_replace(c, _REST, ""), r"(?s)^([^?#]*)", 1), "/+$", "")
    return F.when(p == "", "/").otherwise(p)


def query(c: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(c, _REST, ""), r"(?s)^[^?#]*\?([^#]*)", 1)


def pairs(c: Column) -> Column:
    """The query's (key, value) pairs in order, decoded; a bare key has an empty value."""
    decode = lambda x: F.coalesce(F.try_url_decode(x), F.replace(x, F.lit("+"), F.lit(" ")))

    def of(p: Column) -> Column:
        at = F.instr(p, "=")
        key = F.when(at > 0, F.substring(p, F.lit(1), at - 1)).otherwise(p)
        value = F.when(at > 0, F.substring(p, at + 1, F.length(p))).otherwise("")
        return F.struct(decode(key).alias("k"), decode(value).alias("v"))

    return F.transform(F.filter(F.split(query(c), "&"), lambda p: p != ""), of)


def encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def form(ps: Column) -> Column:
    return F.array_join(F.transform(ps, lambda p: F.concat(encode(p["k"]), F.lit("="), encode(p["v"]))), "&")


def fold_host(h: Column) -> Column:
    """Without the first matching device prefix, then by alias."""
    bare = F.regexp_replace(h, r"^(?:www|m|mobile|amp|web)\.(?=.)", "")
    out = bare
    for a, b in HOST_ALIASES.items():
        out = F.when(bare == a, b).otherwise(out)
    return out


def host_of(c: Column | str) -> Column:
    """The host to show; empty for an empty URL."""
    text = collapse(c)
    return F.when(text == "", "").otherwise(fold_host(raw_host(with_scheme(text))))


def feed_key(c: Column | str) -> Column:
    """host[:port]/path[?sorted query]; a URL without a host is lower-cased without trailing slashes."""
    text = collapse(c)
    full = with_scheme(text)
    host = fold_host(raw_host(full))
    kept = F.filter(pairs(full), lambda p: ~F.lower(p["k"]).isin(TRACKING_FEED))
    q = form(F.array_sort(kept))
    p = port(full)
    key = F.concat(host, F.when(p != "", F.concat(F.lit(":"), p)).otherwise(""), path(full), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return F.when(text == "", "").when(host == "", F.regexp_replace(F.lower(full), "/+$", "")).otherwise(key)


def store_key(c: Column | str) -> Column:
    """https://host/path[?query]; a URL without a host stays as it is."""
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"(?U)^\s+|\s+$", "")
    full = with_scheme(text)
    host = F.regexp_replace(raw_host(full), r"^www\.(?=.)", "")
    kept = F.filter(pairs(full), lambda p: (p["v"] != "") & ~F.lower(p["k"]).startswith("utm_") & ~F.lower(p["k"]).isin(TRACKING_STORE))
    q = form(kept)
    key = F.concat(F.lit("https://"), host, path(full), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return F.when(text == "", "").when(host == "", full).otherwise(key)


def absolute(c: Column | str, base: Column | str) -> Column:
    """A link of a page at base; script, data, about and blob links are empty."""
    raw, b = F.trim(F.coalesce(col(c), F.lit(""))), F.coalesce(col(base), F.lit(""))
    origin = F.regexp_extract(b, r"^(https?://[^/]+)", 1)
    return (
        F.when((raw == "") | raw.rlike(r"(?i)^(javascript|data|about|blob):"), "")
        .when(raw.rlike(r"(?i)^https?://"), raw)
        .when(raw.startswith("//"), F.concat(F.lit("https:"), raw))
        .when(raw.startswith("/") & (b != ""), F.concat(origin, raw))
        .when(b != "", F.concat(F.regexp_replace(b, r"/[^/]*$", ""), F.lit("/"), raw))
        .otherwise(raw)
    )


def extract_urls(c: Column | str) -> Column:
    """Distinct links in order of first occurrence, without trailing punctuation."""
    found = F.regexp_extract_all(F.coalesce(col(c), F.lit("")), F.lit(r"""https?://[^\s)\]>（），。；、"']+"""), F.lit(0))
    ends = "[" + TRAILING.replace("\\", "\\\\") + "]+$"
    return F.array_distinct(F.filter(F.transform(found, lambda u: F.regexp_replace(u, ends, "")), lambda u: u != ""))
