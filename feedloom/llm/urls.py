"""URL filters: host and path rules, else a weighted vocabulary counted by one Aho-Corasick pass.

A strict term rejects alone; soft terms reject when several distinct ones occur whose weights reach a limit. A hit
counts only between boundaries: the neighbours of the term are no ASCII letters or digits. The vocabulary is the
built-in one or a file of any size, one term a line with its weight and category.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, frugal

#: (host, path, verdict): fixed values.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: The built-in vocabulary, written for this filter: categories, their strict terms, and their soft terms by weight
#: (fixed values). A weight of 1 halves what a rejection needs.
VOCABULARY = {
    "adult": (
        "adult porn porno xxx hentai camgirls camgirl escort escorts milf bdsm nsfw redtube xvideos sexcam sexchat onlyfans fetish hardcore-sex".split(),
        {1.0: "sex nude nudes hot erotic erotica lingerie dating hookup swingers webcam strip stripper babes teens amateur busty naked kinky".split(), 0.5: "girls models singles date chat live".split()},
    ),
    "gambling": ("casino casinos sportsbook".split(), {1.0: "bet bets betting poker slots slot win roulette blackjack baccarat lottery lotto jackpot bingo odds bookmaker gamble gambling".split(), 0.5: "bonus spin lucky vip".split()}),
    "pharmacy": ("viagra cialis levitra phentermine tramadol".split(), {1.0: "pills cheap pharmacy drugs rx diet weightloss steroids valium xanax".split(), 0.5: "discount buy sale order".split()}),
    "spam": (["seo-spam"], {1.0: "free spam ads track farm loan loans payday forex cashadvance replica replicas coupon coupons adserver popunder clickbank mlm".split(), 0.5: "money cash rich earn offer promo deals".split()}),
    "harm": ("malware phishing ransomware botnet keylogger".split(), {1.0: "crack cracked warez keygen torrent torrents serialz nulled hack hacks cheats pirated".split(), 0.5: "download exe apk mirror".split()}),
}
STRICT_TERMS = [t for strict, _ in VOCABULARY.values() for t in strict]
SOFT_WEIGHTS = {t: w for _, soft in VOCABULARY.values() for w, terms in soft.items() for t in terms}
SOFT_TERMS = list(SOFT_WEIGHTS)
#: Distinct soft terms, and the sum of their weights, that reject.
SOFT_HITS, SOFT_LIMIT = 2, 2.0
#: Terms and their characters that a vocabulary file may hold, so that the automaton fits every worker.
MAX_TERMS, MAX_TERM = 1_000_000, 200


def load_terms(spark: SparkSession, path: str) -> tuple[list[str], dict[str, float]]:
    """(strict terms, weights of soft terms) of a text file: term, tab, ``strict`` or a weight, tab, category.

    Lines that are empty or begin with # say nothing; a term that repeats counts with its last line. A file of more
    than MAX_TERMS lines, or with a longer term, is refused rather than cut.
    """
    lines = spark.read.text(path).where("trim(value) <> '' and value not like '#%'")
    if lines.limit(MAX_TERMS + 1).count() > MAX_TERMS:
        raise ValueError(f"a vocabulary holds {MAX_TERMS} terms at most")
    kinds = dict(tuple(r["value"].split("\t")[:2]) for r in lines.collect())
    if any(not 0 < len(t) <= MAX_TERM for t in kinds):
        raise ValueError(f"a term has 1 to {MAX_TERM} characters")
    return [t for t, k in kinds.items() if k == "strict"], {t: float(k) for t, k in kinds.items() if k != "strict"}


def automaton(strict: list[str], soft: list[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):  # a term of both lists is strict
        for t in terms:
            a.add_word(t.lower(), (t.lower(), kind))
    a.make_automaton()
    return a


def hits(a: ahocorasick.Automaton, url: str | None) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms of the url, ASCII letters lower-cased, between boundaries."""
    found: dict[str, set[str]] = {"strict": set(), "soft": set()}
    if not url or not len(a):
        return set(), set()
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url)
    inside = lambda c: "a" <= c <= "z" or "0" <= c <= "9"
    for end, (term, kind) in a.iter(low):
        start = end - len(term) + 1
        if (start == 0 or not inside(low[start - 1])) and (end + 1 == len(low) or not inside(low[end + 1])):
            found[kind].add(term)
    return found["strict"], found["soft"]


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=None) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, or null."""
    pick = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, v in sorted(RULES if rules is None else rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        pick = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))).otherwise(pick)
    return pick


def judge(pages: DataFrame, url_col: str = "url", rules=None, strict: list[str] | None = None, soft: list[str] | dict[str, float] | None = None, soft_hits: int = SOFT_HITS, soft_limit: float = SOFT_LIMIT) -> DataFrame:
    """pages plus host, path, rule, n_strict, n_soft, soft_weight and verdict; a column with such a name is replaced.

    A null url, or one without ://, has an empty host and path, fits no rule and is judged by its terms
    alone: without any it is allowed. Soft terms given as a list weigh 1 each. Every row is judged by itself, so
    repeated rows repeat; an empty table gives no rows. The urls are read whole; nothing shuffles.
    """
    strict, soft = STRICT_TERMS if strict is None else strict, SOFT_WEIGHTS if soft is None else soft
    weights = {t.lower(): w for t, w in soft.items()} if isinstance(soft, dict) else {t.lower(): 1.0 for t in soft}

    @F.pandas_udf("n_strict bigint, n_soft bigint, soft_weight double")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a = automaton(strict, list(weights))
        for s in batches:
            found = [hits(a, u) for u in s]
            yield pd.DataFrame([(len(x), len(y), float(sum(map(weights.__getitem__, y)))) for x, y in found], columns=["n_strict", "n_soft", "soft_weight"])

    made = ("host", "path", "rule", "n_strict", "n_soft", "soft_weight", "verdict")
    rest = [c for c in pages.columns if c.lower() not in made or c == url_col]
    u, m, r = (fresh(pages.columns, x) for x in ("_url", "_hits", "_rule"))
    out = frugal(pages).withColumn(u, F.col(url_col)).select(*rest, u).withColumn(m, counted.asNondeterministic()(F.col(u)))
    out = out.withColumn("host", host_of(F.col(u))).withColumn("path", path_of(F.col(u))).withColumn(r, rule_of(F.col("host"), F.col("path"), rules))
    bad = (F.col(f"{m}.n_strict") >= 1) | ((F.col(f"{m}.n_soft") >= soft_hits) & (F.col(f"{m}.soft_weight") >= soft_limit))
    verdict = F.coalesce(F.col(f"{r}.verdict"), F.when(bad, "block").otherwise("allow"))
    return out.select(*rest, "host", "path", F.col(f"{r}.rule").alias("rule"), f"{m}.n_strict", f"{m}.n_soft", f"{m}.soft_weight", verdict.alias("verdict"))
