"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, langid, licenses, mixing, near_dedup, quality, substring, toxicity, urls
from .common import table

SP = r"[\x20\x09-\x0D]"


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts; null and empty texts have no ids, repeated rows repeat."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return coded.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdicts of all documents; a null text has no words and fails, null sources are one host. The prior is
    that of beta_prior(), which SQL can state."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.judge(docs, prior=quality.beta_prior).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("host_rate", 9).alias("host_rate"), "host_strict")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document; nulls are empty texts, ties go to the least id, repeated rows share a verdict."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document; texts without words are classes of their own."""
    return near_dedup.near_classes(table(spark, sf_dir, "documents"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by their Poisson counts at equal weights of all sources; a null source is one; copies have replica numbers."""
    return mixing.mix(table(spark, sf_dir, "documents"), facts=True)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all pages; a null url, or one without ://, has an empty host and path and is judged by its terms."""
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents; a null or empty text has no words, no places and no labels."""
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without words of windows that start earlier too. Three batches go through an index
    that compacts whenever it holds two runs. Null, empty and short texts lose nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs, batches=3, max_runs=1).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of the rows that are not held out; null and empty texts have the least evidence."""
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.train(docs, labels, F.crc32(F.col("_id").cast("string")) % 4 != 2)
    out = toxicity.score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by models of the rows that are not held out; und and 0 without a letter."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = langid.train(langid.sample(docs, ~held, "doc_id", "lang"), "text", "lang")
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


QUERIES = {"op6_substring_dedup": op6_substring_dedup, "op7_toxicity": op7_toxicity, "op8_language_id": op8_language_id, "op1_near_dedup": op1_near_dedup, "op2_mix": op2_mix, "op5_url_filter": op5_url_filter, "op10_license_scan": op10_license_scan, "op3_bpe": op3_bpe, "op4_quality_rules": op4_quality_rules, "op9_exact_dedup": op9_exact_dedup}

_HOST = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LOW = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _counted(terms: list[str], weights: dict[str, float] | None = None) -> str:
    return " + ".join(f"(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)'))::int" + (f" * {weights[t]}::double" if weights else "") for t in terms)


_SOFT = [t for t in urls.SOFT_TERMS if t not in urls.STRICT_TERMS]


def _rules_sql() -> str:
    out = "case"
    for h, p, v in sorted(urls.RULES, key=lambda r: -len(r[0] + r[1])):
        out += f" when (host = '{h}' or suffix(host, '.{h}')) and prefix(path, '{p}') then '{h}{p}'"
    return out + " end"


def _verdict_sql() -> str:
    return "case rule " + " ".join(f"when '{h}{p}' then '{v}'" for h, p, v in urls.RULES) + f" else case when n_strict >= 1 or (n_soft >= {urls.SOFT_HITS} and soft_weight >= {urls.SOFT_LIMIT}) then 'block' else 'allow' end end"


ORACLE = {
    "op5_url_filter": f"""
        with u as (select page_id, {_HOST} as host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path, {_LOW} as low from pages),
        r as (select *, {_rules_sql()} as rule, ({_counted(urls.STRICT_TERMS)})::bigint as n_strict, ({_counted(_SOFT)})::bigint as n_soft, ({_counted(_SOFT, urls.SOFT_WEIGHTS)})::double as soft_weight from u)
        select page_id, host, path, rule, {_verdict_sql()} as verdict, n_strict, n_soft, soft_weight from r""",
    "op2_mix": """
        with n as (select coalesce(source, '') as s, count(*) as n from documents group by 1),
        r as (select s, (select sum(n) from n)::double / (select count(*) from n) / n as rate from n),
        c as (select s, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) over (partition by s order by k) as cdf
              from r, (select unnest(range(0, 200)) as k) where k <= rate + 12 * sqrt(rate) + 30),
        u as (select *, (('0x' || md5('0:' || coalesce(doc_id::varchar, '~'))[1:13])::bigint)::double / 4503599627370496 as u from documents),
        d as (select u.*, (select count(*) from c where c.s = coalesce(u.source, '') and cdf <= u) as repetitions from u)
        select d.* exclude (u), rate as mean_rate, md5('order 0:' || coalesce(doc_id::varchar, '~') || ':' || replica)[1:16] as shuffle_key
        from (select *, unnest(range(0, repetitions)) as replica from d) d join r on r.s = coalesce(d.source, '')""",
    "op9_exact_dedup": f"""
        with d as (select doc_id, length(coalesce(text, '')) as n, sha256(regexp_replace(coalesce(text, ''), '{SP}+', '', 'g')) as h from documents)
        select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by h) as group_size,
               doc_id = first_value(doc_id) over w as kept, h as text_sha256
        from d window w as (partition by h order by n desc, doc_id)""",
    "op4_quality_rules": f"""
        with d as (select doc_id, coalesce(source, '') as host, coalesce(text, '') as t from documents),
        w as (select doc_id, host, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as ws,
                     list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from d),
        g as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as k from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)),
        r as (select doc_id, i from g qualify count(*) over (partition by doc_id, k) > 1),
        c as (select doc_id, count(distinct j) as n from (select doc_id, unnest([i, i + 1, i + 2]) as j from r) group by doc_id),
        m as (select w.doc_id, host, len(ws) as n_words, length(regexp_replace(t, '{SP}+', '', 'g')) as word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
                     len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words
              from w left join c using (doc_id)),
        f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
                     10 * n_symbols > n_words or n_dup_lines > 5 or word_chars > 20 * n_words or word_chars < 2 * n_words as soft from m),
        h as (select host, count(*) as n, count(*) filter (base_failed or soft) as failed from f group by host),
        p as (select coalesce(avg(failed / n), 0.5) as m, coalesce(var_samp(failed / n), 0) as v from h where n >= {quality.PRIOR_LEAST}),
        q as (select m, case when v > 1e-12 and v < m * (1 - m) then m * (1 - m) / v - 1 else 2 end as s from p),
        v as (select host, (failed + m * s) / (n + s) > {quality.STRICT_RATE} as host_strict, (failed + m * s) / (n + s) as host_rate from h, q)
        select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines,
               n_repeat_words::bigint as n_repeat_words, base_failed, not (base_failed or (host_strict and soft)) as kept,
               round(host_rate, 9) as host_rate, host_strict
        from f join v using (host)""",
}
