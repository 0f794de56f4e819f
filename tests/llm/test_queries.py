"""The registered queries and the pipeline on the smallest tables: against their SQL, plain versions, and for leaks."""

import hashlib
import math
import os
import re
import sys
from itertools import combinations
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from feedloom.llm import near_dedup, queries
from feedloom.llm.common import WordTable

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from test_catalog import rows  # noqa: E402

SF = os.environ.get("FEEDLOOM_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(duck):
    return duck.sql("select doc_id, text, source from documents order by doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), duck.sql(queries.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) > 0
    assert rows(got) == rows(want)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def test_bpe_query_equals_the_library(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in queries.op3_bpe(spark, SF).collect()}
    assert len(got) == len(documents)
    for i, t, _ in documents:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[i].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_substring_query_equals_brute_force(spark, documents):
    seen, want = set(), {}
    for i, t, _ in documents:
        w, gone = re.findall(r"[^\x20\x09-\x0D]+", t or ""), set()
        for k in range(len(w) - 19):
            if (x := tuple(w[k : k + 20])) in seen:
                gone.update(range(k, k + 20))
            seen.add(x)
        want[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op6_substring_dedup(spark, SF).collect()}
    assert got == want and sum(n for _, n, _ in want.values()) > 0


def test_license_query_equals_brute_force(spark, documents):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    got = {r.doc_id: r for r in queries.op10_license_scan(spark, SF).collect()}
    for i, t, _ in documents:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        at = [(k, label) for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert (got[i].n_words, got[i].n_base, got[i].base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (got[i].first_word, got[i].last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))


def near_classes(ids, texts, weights):
    """The least id of each text's class, by all pairs."""
    table, up = WordTable(10**9), {i: i for i in ids}
    sets = [near_dedup.shingles([t], table, weights)[:3] for t in texts]

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(ids)), 2):
        if near_dedup.similarity(sets[a], sets[b]) >= near_dedup.THRESHOLD:
            x, y = sorted((find(ids[a]), find(ids[b])))
            up[y] = x
    return {i: find(i) for i in ids}


def test_near_query_equals_all_pairs(spark, documents):
    frame = spark.createDataFrame([(i, t) for i, t, _ in documents], "doc_id long, text string")
    want = near_classes([i for i, _, _ in documents], [t for _, t, _ in documents], near_dedup.Weights.learn(frame, "text"))
    got = {r.doc_id: r.class_id for r in queries.op1_near_dedup(spark, SF).collect()}
    missed = {i for i in want if got[i] != want[i]}
    assert len(want) - len(set(want.values())) > 3 and not missed


def swapped(spark, at, table, column, held, other):
    """A copy of the tables in which the held-out rows of one column say something else."""
    for t in ("documents", "labels"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if t == table:
            df = df.withColumn(column, F.when(held, other).otherwise(F.col(column)).cast(df.schema[column].dataType))
        df.write.parquet(f"{at}/{t}.parquet")
    return str(at)


def test_held_out_rows_teach_nothing(spark, tmp_path):
    crc = F.crc32(F.col("doc_id").cast("string"))
    for name, at, table, column, held, other in (
        ("op7_toxicity", tmp_path / "a", "labels", "toxic", crc % 4 == 2, 1 - F.col("toxic")),
        ("op8_language_id", tmp_path / "b", "documents", "lang", crc % 3 == 1, F.lit("zz")),
    ):
        lied = swapped(spark, at, table, column, held, other)
        a, b = (sorted(map(tuple, queries.QUERIES[name](spark, x).collect())) for x in (SF, lied))
        assert a == b and any(r[1] for r in a), name


def plain_quality(documents):
    """Documents that the quality rules keep, by the definitions."""
    judged = []
    for i, t, s in documents:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        twice = {x for x in tri if tri.count(x) > 1} if len(tri) < 3000 else {x for x, n in __import__("collections").Counter(tri).items() if n > 1}
        repeated = len({k + j for k, x in enumerate(tri) if x in twice for j in range(3)})
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        base = len(w) < 50 or 100 * repeated > 50 * len(w)
        soft = 10 * len(re.findall(r"[#*$%&|<>]", t)) > len(w) or len(lines) - len(set(lines)) > 5 or not 2 * len(w) <= sum(map(len, w)) <= 20 * len(w)
        judged.append((i, t, s, base, soft))
    hosts = {}
    for _, _, s, base, soft in judged:
        n, f = hosts.get(s or "", (0, 0))
        hosts[s or ""] = (n + 1, f + (base or soft))
    n, f = np.array(list(hosts.values()), float).T
    m, room = f.sum() / n.sum(), n.sum() - (n * n).sum() / n.sum() - (len(n) - 1)
    size = 2.0
    if 0 < m < 1 and room > 1e-9:
        between = (((f * f / n).sum() - f.sum() * m) / (m * (1 - m)) - (len(n) - 1)) / room
        size = 1 / min(max(between, 1 / n.sum()), 1 / 3) - 1
    strict = {h for h, (k, x) in hosts.items() if (x + m * size) / (k + size) > 0.5}
    return [(i, t, s) for i, t, s, base, soft in judged if not base and not (soft and (s or "") in strict)]


def test_pipeline_equals_brute_force(spark, documents):
    kept = plain_quality(documents)
    groups = {}
    for i, t, s in kept:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", t), []).append((-len(t), i, t, s))
    kept = sorted((i, t, s) for _, i, t, s in map(min, groups.values()))
    frame = spark.createDataFrame([(i, t) for i, t, _ in kept], "doc_id long, text string")
    least = near_classes([i for i, _, _ in kept], [t for _, t, _ in kept], near_dedup.Weights.learn(frame, "text"))
    kept = [x for x in kept if least[x[0]] == x[0]]
    per = {}
    for _, _, s in kept:
        per[s or ""] = per.get(s or "", 0) + 1
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, t, s in kept:
        rate = len(kept) / len(per) / per[s or ""]
        u = int(hashlib.md5(f"0:{i}".encode()).hexdigest()[:13], 16) / 2**52
        term = total = math.exp(-rate)
        n = 0
        while total <= u:
            n += 1
            term *= rate / n
            total += term
        if n:
            want[i] = (n, np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes())
    got = {}
    for r in corpus_pipeline.run(spark, SF).collect():
        assert r.round_trip and r.n_tokens == len(r.ids) // 4
        n, ids = got.get(r.doc_id, (0, bytes(r.ids)))
        assert ids == bytes(r.ids)
        got[r.doc_id] = (n + 1, ids)
    assert got == want and 20 < len(got) < len(documents)
