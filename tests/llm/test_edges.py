"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import hashlib
import math
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import bpe, exact_dedup, langid, licenses, mixing, near_dedup, quality, substring, toxicity, urls

LONG = " ".join(f"word{i}" for i in range(30_000))
A = " ".join(f"alpha{i}" for i in range(60))
ROWS = [
    (1, None, "en", "s0", None),
    (2, "", None, "s0", 0),
    (3, " \t\n", "en", None, 3),
    (4, A, "en", "s1", 5),
    (5, A, "en", "s1", 5),
    (5, A, "en", "s1", 5),
    (6, A.replace(" ", "\n"), "fr", "s0", 5),
    (7, LONG, "en", "s0", 9),
    (8, "tiny", None, None, None),
    (None, A + " tail", "en", "s0", 1),
    (9, A + " tail", "en", "s0", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside or return.
CLASH = ["_c0", "_c1", "_key", "_b0", "_m0", "_gone", "_strict", "_strict__m", "_soft__m", "_h", "_sha", "_best", "_chars", "_spans", "_bpe", "_salt", "_id", "kept", "_keep", "n_words", "score", "IDS", "_maybe", "_n", "_rate", "id", "first", "_m", "class_id", "keep_id", "replica", "labels", "host"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASH})


def own_values(out, given):
    """Columns of the input that the output still has hold their own values, but those that are results."""
    results = {"kept", "n_words", "score", "host"}
    for c in set(CLASH) & set(given.columns) & set(out.columns) - results:
        assert out.where(~F.col(c).eqNullSafe(F.lit(f"own {c}"))).count() == 0, c


def test_exact_groups(spark, docs, clashing):
    for d in (docs, clashing):
        got = exact_dedup.exact_groups(d).collect()
        assert len(got) == len(ROWS)
        by = {}
        for r in got:
            by.setdefault(r.doc_id, []).append(r)
        assert {(r.keep_id, r.group_size) for i in (1, 2, 3) for r in by[i]} == {(3, 3)}  # three characters beat none
        assert {(r.keep_id, r.group_size, r.kept) for r in by[4]} == {(4, 4, True)}
        assert [r.kept for i in (5, 6) for r in by[i]] == [False] * 3
        assert by[None][0].keep_id == 9 and not by[None][0].kept and by[9][0].kept
        assert by[7][0].text_sha256 == hashlib.sha256(LONG.replace(" ", "").encode()).hexdigest()
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_exact_dedup_keeps_columns(docs, clashing):
    for d in (docs, clashing):
        out = exact_dedup.exact_dedup(d)
        assert out.columns == d.columns
        own_values(out, d)
        assert sorted(r.doc_id for r in out.collect()) == [3, 4, 7, 8, 9]
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_exact_dedup_of_repeated_rows(spark):
    d = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "z"), (None, "z")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in exact_dedup.exact_dedup(d).collect()) == [(0, "z"), (1, "x y")]


def test_bloom_filter_has_no_false_negatives(spark):
    d = spark.range(3000).select(F.xxhash64(F.col("id") % 2500).alias("k"), F.lit("own").alias("_c0"), F.lit("own").alias("_m1"))
    again = exact_dedup.repeated_hashes(d, "k")
    assert again.count() == 500
    for most in (1 << 30, 1):  # a filter that is far too small stays right
        tested = exact_dedup.maybe_repeated(d, "k", again, "maybe", most)
        assert tested.columns == ["k", "_c0", "_m1", "maybe"] and tested.where("_c0 = 'own' and _m1 = 'own'").count() == 3000
        assert tested.where("not maybe").join(again, "k").count() == 0
        assert tested.where("maybe").count() < 1200 or most == 1


def test_quality(docs, clashing):
    for d in (docs, clashing):
        out = {r.doc_id: r for r in quality.judge(d).collect()}
        assert out[1].n_words == out[2].n_words == out[3].n_words == 0 and not out[1].kept
        assert (out[4].n_words, out[4].word_chars, out[4].kept) == (60, len(A) - 59, True)
        assert out[7].n_words == 30_000 and out[8].base_failed
        kept = quality.keep_good(d)
        assert kept.columns == d.columns
        own_values(kept, d)
        own_values(quality.judge(d), d)
        assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 5, 5, 6, 7, 9]
    assert quality.judge(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0


def naive_repeats(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    hit = {j for i, t in enumerate(tri) if tri.count(t) > 1 for j in (i, i + 1, i + 2)}
    return len(hit)


def test_quality_measures_against_brute_force():
    import random

    rng = random.Random(5)
    texts = ["".join(rng.choices(["a", "b", "c", " ", "\n", "\t", "\x1c", " ", "#", "é"], k=rng.randint(0, 60))) for _ in range(400)]
    got = quality.measure(texts, quality.WordTable())
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert got["n_words"][i] == len(re.findall(r"[^\x20\x09-\x0D]+", t))
        assert got["word_chars"][i] == sum(map(len, re.findall(r"[^\x20\x09-\x0D]+", t)))
        assert got["n_dup_lines"][i] == sum(x in lines[:k] for k, x in enumerate(lines))
        assert got["n_repeat_words"][i] == naive_repeats(t)


def test_strict_host_rejects_only_soft_failures(spark):
    good, soft, bad = A, A + " $$$$$$$$$$", "x"
    rows = [(i, bad, "h", None, 1) for i in range(80)] + [(100, good, "h", None, 1), (101, soft, "h", None, 1)] + [(200 + i, good, f"g{i % 3}", None, 1) for i in range(90)] + [(300, soft, "g0", None, 1)]
    d = spark.createDataFrame([(i, t, None, h, n) for i, t, h, _, n in rows], SCHEMA)
    out = {r.doc_id: r for r in quality.judge(d).collect()}
    assert out[100].kept and out[100].host_strict and not out[101].kept and out[300].kept and not out[300].host_strict
    kept = {r.doc_id for r in quality.keep_good(d).collect()}
    assert kept == {i for i, r in out.items() if r.kept}


def test_small_hosts_shape_the_prior(spark):
    good, soft = A, A + " $$$$$$$$$$"
    rows = [(i, soft if i in (3, 50) else good, f"one{i}" if i < 40 else f"four{i % 10}") for i in range(80)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = quality.judge(d).collect()
    assert sum(r.soft_failed for r in out) == 2 and all(r.kept and not r.host_strict for r in out)
    assert quality.keep_good(d).count() == 80
    rng = np.random.default_rng(3)
    n = rng.integers(1, 20, 4000)
    hosts = spark.createDataFrame([(int(a), int(b)) for a, b in zip(n, rng.binomial(n, rng.beta(2, 6, 4000)), strict=True)], "n long, failed long")
    alpha, beta = quality.fitted_prior(hosts)
    assert abs(alpha - 2) < 0.4 and abs(beta - 6) < 1.2
    assert quality.fitted_prior(hosts.limit(0)) == (1.0, 1.0)


def test_near_dedup(docs, clashing):
    for d in (docs, clashing):
        out = near_dedup.near_classes(d).collect()
        assert len(out) == len(ROWS)
        by = {r.doc_id: r.class_id for r in out}
        assert by == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, 9: 4, None: None}
        kept = near_dedup.near_dedup(d)
        assert kept.columns == d.columns
        own_values(kept, d)
        assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 7, 8]
    assert near_dedup.near_classes(docs.limit(0)).count() == 0


def test_mixing(docs, clashing):
    for d in (docs, clashing):
        out = mixing.mix(d, total=400)
        assert out.columns == d.columns
        own_values(out, d)
        assert out.count() > 200
        facts = mixing.mix(d, total=400, facts=True)
        per = facts.groupBy("doc_id", "replica").count().collect()
        assert all(r["count"] == (2 if r.doc_id == 5 else 1) for r in per)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs, weights={}).count() == 0
    only = mixing.mix(docs, weights={"s1": 2.0}, total=50).select("source").distinct().collect()
    assert [r.source for r in only] == ["s1"]
    with pytest.raises(ValueError):
        mixing.mix(docs, total=1e9)


def test_mixing_hits_the_weights(spark):
    d = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    got = {r.source: r["count"] for r in mixing.mix(d, weights={"a": 3.0, "b": 1.0}).groupBy("source").count().collect()}
    assert abs(got["a"] - 4500) < 300 and abs(got["b"] - 1500) < 180
    again = mixing.mix(d.repartition(7), weights={"a": 3.0, "b": 1.0}, facts=True)
    assert again.count() == sum(got.values())


def test_mixing_repeats_a_rare_source_at_any_rate(spark):
    d = spark.range(60_001).select(F.col("id").alias("doc_id"), F.when(F.col("id") > 0, F.concat(F.lit("s"), F.col("id") % 4)).alias("source"))
    got = mixing.mix(d, facts=True).where("source is null").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("replica").alias("replicas"), F.max("replica").alias("last"), F.first("repetitions").alias("reps")).first()
    assert got.n == got.replicas == got.last + 1 == got.reps and abs(got.n - 60_001 / 5) < 6 * (60_001 / 5) ** 0.5


def test_poisson_quantile_by_definition():
    u = np.random.default_rng(7).uniform(size=40)
    for rate in (1e-9, 0.02, 0.7, 3.0, 40.5, 190.0, 12_000.2, 750_000.0):
        wide = int(15 * rate**0.5 + 40)
        at = range(max(0, int(rate) - wide), int(rate) + wide)
        below = np.cumsum([math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1)) for k in at])
        want = [at[0] + int((below <= x).sum()) for x in u]
        assert mixing.poisson_quantile(np.full(40, rate), u, {}).tolist() == want
    assert mixing.poisson_quantile(np.zeros(40), u, {}).tolist() == [0] * 40


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://WWW.Example.COM/en/x?q"), (5, "http://example.com/en/"), (6, "http://a.com"), (7, "http://a.com/"), (8, "https://x.org/adult?x"), (9, "https://x.org/adulthood"), (10, "https://x.org/free-bets"), (11, "https://x.org/free-free"), (12, "https://b.net/fr/adult"), (13, "https://xcom/"), (14, "a://b://c/d"), (14, "a://b://c/d"), (15, "x" * 100_000 + "://org-casino-x/")]
    d = spark.createDataFrame(rows, "page_id long, url string")
    out = {r.page_id: r for r in urls.judge(d).collect()}
    assert (out[1].host, out[1].path, out[1].rule, out[1].verdict) == ("", "", None, "allow")
    assert out[3].host == "" and out[2].verdict == "allow"
    assert (out[4].host, out[4].path, out[4].rule, out[4].verdict) == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert (out[5].rule, out[5].verdict) == ("example.com/en/", "block")
    assert (out[6].rule, out[7].rule) == (None, "com/")
    assert [out[i].verdict for i in (8, 9, 10, 11, 12)] == ["block", "allow", "block", "allow", "block"]
    assert out[13].rule is None and (out[14].host, out[14].path) == ("b:", "//c/d") and out[15].verdict == "block"
    clash = urls.judge(d.withColumns({c: F.lit("own") for c in ("host", "RULE", "_url", "_hits", "_rule")}))
    assert clash.where("host = 'own'").count() == 0 and clash.where("_url = 'own'").count() == len(rows)
    assert urls.judge(d.limit(0)).count() == 0
    weak = spark.createDataFrame([(1, "http://a.org/girls-chat"), (2, "http://a.org/girls-chat-live-date"), (3, "http://a.org/sex-girls"), (4, "http://a.org/sex-bet")], "page_id long, url string")
    assert [(r.n_soft, r.soft_weight, r.verdict) for r in urls.judge(weak).orderBy("page_id").collect()] == [(2, 1.0, "allow"), (4, 2.0, "block"), (2, 1.5, "allow"), (2, 2.0, "block")]


def test_vocabulary_file(spark, tmp_path):
    (tmp_path / "terms.tsv").write_text("# made here\nalpha\tstrict\tx\n\nbeta\t0.75\tx\ngamma\t1.25\ty\nword" + "".join(f"\t1\tz\nword{i}" for i in range(5000)) + "\t1\tz\n")
    strict, soft = urls.load_terms(spark, str(tmp_path / "terms.tsv"))
    assert strict == ["alpha"] and soft["beta"] == 0.75 and len(soft) == 5003
    d = spark.createDataFrame([(1, "x/alpha"), (2, "x/beta"), (3, "x/beta.gamma"), (4, "x/word17,word4999"), (5, "x/adult")], "page_id long, url string")
    assert [r.verdict for r in urls.judge(d, strict=strict, soft=soft).orderBy("page_id").collect()] == ["block", "allow", "block", "block", "allow"]


def test_substring(docs, clashing):
    for d in (docs, clashing):
        out = substring.remove_repeats(d)
        got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in out.collect())
        assert (1, 0, 0) in got and (2, 0, 0) in got and (8, 1, 0) in got and (7, 30_000, 0) in got
        assert (4, 60, 0) in got and (6, 60, 60) in got and (9, 61, 60) in got and (0, 61, 0) in got
        assert [x for x in got if x[0] == 5] == [(5, 60, 60)] * 2
    assert substring.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 2])
def test_substring_of_repeated_rows(spark, parts):
    """Rows that repeat an id and a text are one place, whether they lie in one chunk or in two partitions."""
    once, inside, other = (" ".join(f"{x}{i}" for i in range(40)) for x in ("once", "inside", "other"))
    rows = [(1, once), (2, inside + " " + inside), (3, other + " " + once)]
    d = spark.createDataFrame(spark.sparkContext.parallelize(rows * 2, parts), "doc_id long, text string")
    assert d.rdd.getNumPartitions() == parts
    got = sorted((r.doc_id, r.n_removed, r.kept) for r in substring.remove_repeats(d, batches=1).collect())
    assert got == sorted([(1, 0, once), (2, 40, inside), (3, 40, other)] * 2)


def test_toxicity(docs, clashing, spark):
    labels = spark.createDataFrame([(4, 0), (7, 1), (9, None)], "doc_id long, toxic int")
    for d in (docs, clashing):
        model = toxicity.train(d, labels, F.lit(True))
        out = toxicity.score(d, model).collect()
        assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    none = toxicity.train(docs, labels.limit(0), F.lit(True))
    assert toxicity.score(docs.limit(0), none).count() == 0
    probe = spark.createDataFrame([(1, "you are an idiot and worthless scum"), (2, "a calm day at the sea")], "doc_id long, text string")
    a, b = (r.score for r in toxicity.score(probe, none).orderBy("doc_id").collect())
    assert a > 0.3 > b


def test_language(docs, clashing, spark):
    for d in (docs, clashing):
        model = langid.train(langid.sample(d, F.lit(True), "doc_id", "lang"), "text", "lang")
        out = {r.doc_id: r for r in langid.identify(d, model).collect()}
        assert out[1].lang_pred == out[2].lang_pred == out[3].lang_pred == "und" and out[7].lang_pred == "en"
    empty = langid.train(docs.limit(0), "text", "lang")
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}
    assert langid.identify(docs.limit(0), model).count() == 0


def test_licenses(docs, clashing):
    for d in (docs, clashing):
        out = {r.doc_id: r for r in licenses.scan(d).collect()}
        assert (out[1].n_words, out[1].first_word, out[1].labels, out[1].score) == (0, None, "", 0.0)
        assert out[7].n_words == 30_000
    assert licenses.scan(docs.limit(0)).count() == 0


def test_bpe_names(clashing):
    out = bpe.encode(clashing, public_tokenizers.path("byte_bpe_50k.json"))
    assert "IDS" not in out.columns and "kept" in out.columns and out.count() == len(ROWS)


def test_pipeline_stages(spark, docs, clashing):
    for d in (docs, clashing):
        at = d
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, "")
            assert at.columns == d.columns
        out = corpus_pipeline.STAGES[-1][1](spark, at, "").collect()
        assert all(r.round_trip for r in out) and {r.doc_id for r in out} <= {None, 4, 6, 7, 9}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0
