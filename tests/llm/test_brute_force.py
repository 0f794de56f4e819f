"""Operators that SQL does not express, against plain versions on small corpora."""

import hashlib
import random
import re
from itertools import combinations, product
from re import _parser as parser

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import langid, licenses, near_dedup, substring, toxicity
from feedloom.llm.common import Scratch, WordTable


def corpus(seed, n=160):
    """Texts with exact and near copies, a passage that many share, and repeats inside."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocab, k=45)
    texts = []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.15:
            t = rng.choice(texts)
        elif texts and kind < 0.45:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(1, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
            t = " ".join(w)
        else:
            w = rng.choices(vocab, k=rng.choice([0, 3, 15, 60, 150]))
            if rng.random() < 0.4:
                at = rng.randint(0, len(w))
                w[at:at] = passage[rng.randint(0, 10) :]
            if rng.random() < 0.2:
                w += w[:40]
            t = " ".join(w)
        texts.append(t)
    return texts


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)


def classes(docs, weights, texts):
    table = WordTable(10**9)
    sets = [near_dedup.shingles([t], table, weights)[:3] for t in texts]
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if near_dedup.similarity(sets[a], sets[b]) >= near_dedup.THRESHOLD:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_classes(spark, seed):
    texts = corpus(seed)
    docs = frame(spark, texts)
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == classes(docs, near_dedup.Weights.learn(docs, "text"), texts)


@pytest.mark.parametrize("block,most", [(512, 10_000), (10, 10_000), (10, 20)])
def test_large_bucket(spark, monkeypatch, block, most):
    """A bucket over the small limit with several classes inside is compared block against block, a larger one by rare shingles."""
    monkeypatch.setattr(near_dedup, "_BLOCK_DOCS", block)
    monkeypatch.setattr(near_dedup, "_REGROUP", most)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(3):
        head = base[:80] + [f"x{rng.randrange(10**6)}" for _ in range(40)]
        for _ in range(14):
            w = list(head)
            w[rng.randrange(80, 120)] = f"y{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    docs = frame(spark, texts)
    weights = near_dedup.Weights.learn(docs, "text")
    members = docs.select(F.lit(1).cast("long").alias("key"), F.col("doc_id").alias("id"))
    labels = near_dedup.near_links(members, docs.select(F.col("doc_id").alias("id"), "text"), weights, near_dedup.THRESHOLD)
    got = {r.id: r.label for r in labels.collect()}
    want = classes(docs, weights, texts)
    assert [got.get(i, i) for i in range(len(texts))] == want and len(set(want)) > 1


def test_rarest_features_meet():
    """Texts that reach the threshold share a rare feature, whatever the counts say; boilerplate alone shares none."""
    texts = corpus(5)
    weights, table = near_dedup.Weights(np.random.default_rng(1).uniform(0, 1, 2 * near_dedup.CELLS)), WordTable(10**9)
    sets = [near_dedup.shingles([t], table, weights) for t in texts]
    for seen in (np.zeros(near_dedup.CELLS, np.float32), np.random.default_rng(2).integers(0, 9, near_dedup.CELLS).astype(np.float32)):
        rare = [set(near_dedup.rarest(s, seen, near_dedup.THRESHOLD)[1].tolist()) for s in sets]
        near = [(a, b) for a, b in combinations(range(len(texts)), 2) if near_dedup.similarity(sets[a][:3], sets[b][:3]) >= near_dedup.THRESHOLD]
        assert near and all(rare[a] & rare[b] for a, b in near)


def test_regroup_of_boilerplate(spark):
    """A bucket that only boilerplate fills leaves no group; two near copies in it meet."""
    rng = random.Random(3)
    shared = [f"b{i}" for i in range(60)]
    texts = [" ".join(shared + [f"u{rng.randrange(10**9)}" for _ in range(60)]) for _ in range(40)]
    texts.append(texts[7] + " end")
    docs = frame(spark, texts)
    weights = near_dedup.Weights.learn(docs, "text")
    members = docs.select(F.lit(1).cast("long").alias("key"), F.col("doc_id").alias("id"), F.col("doc_id").alias("label"))
    got = near_dedup.regroup(members, docs.select(F.col("doc_id").alias("id"), "text"), weights, near_dedup.THRESHOLD).collect()
    assert {r.id for r in got} == {7, 40} and {r.n for r in got} == {2}


def test_sampler_estimates_weighted_jaccard():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    wa, wb = rng.uniform(1, 2, 300), rng.uniform(1, 2, 300)
    wa[:60], wb[-60:] = 0, 0
    s = near_dedup.Sampler(2000)
    a = s.sign(h[wa > 0], wa[wa > 0], np.ones(240, np.int64), np.array([0, 240]))
    b = s.sign(h[wb > 0], wb[wb > 0], np.ones(240, np.int64), np.array([0, 240]))
    assert abs((a == b).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()) < 0.05


def removed(texts):
    seen, out = set(), []
    for t in texts:
        w = t.split()
        gone = set()
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            if k in seen:
                gone |= set(range(i, i + 20))
            seen.add(k)
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("seed,batches", [(1, 1), (2, 2), (3, 7)])
def test_substring(spark, seed, batches):
    texts = corpus(seed)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(frame(spark, texts), batches=batches, max_runs=2).collect()}
    assert [got[i] for i in range(len(texts))] == removed(texts)


def test_index_compacts_and_holds_each_segment_once(spark):
    texts = corpus(8, 120)
    docs = frame(spark, texts)
    every = docs.select(F.col("doc_id").alias("id"), "text")
    idx, scratch = substring.FingerprintIndex(spark, max_runs=1, buckets=4), Scratch(spark)
    held = []
    for a in range(0, 120, 30):
        idx.add(docs.where(f"doc_id between {a} and {a + 29}"), every.where(f"id < {a + 30}"), scratch)
        held.append(len(idx.runs))
    assert held == [1, 2, 2, 2]  # two runs became one before the third batch and the fourth
    idx.compact()
    (run,) = idx.history()
    assert run.count() == run.select("ah", "sh").distinct().count() > 0
    assert spark.table(idx._name(idx.runs[0])).where("known").count() == 0
    with pytest.raises(ValueError):
        idx.add(docs.where("doc_id = 5"), every, scratch)
    idx.drop()
    scratch.drop()


def test_index_that_stays_takes_later_batches(spark, tmp_path):
    texts, n = corpus(4), 100
    docs = frame(spark, texts)
    root = f"{tmp_path}/index"
    a = substring.remove_repeats(docs.where(f"doc_id < {n}"), batches=2, root=root).collect()
    b = substring.remove_repeats(docs.where(f"doc_id >= {n}"), batches=1, root=root, earlier=docs.where(f"doc_id < {n}"), max_runs=1).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in a + b}
    assert [got[i] for i in range(len(texts))] == removed(texts)
    again = substring.FingerprintIndex(spark, root, window=5)
    assert (again.window, again.high, len(again.runs)) == (20, len(texts) - 1, 2)  # compacted before the last batch
    again.drop()


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def test_license_base():
    rng = random.Random(2)
    parts = ["under", "the", "MIT", "license", "Apache", "License,", "Version", "2", "2.0", "cc", "BY-NC", "by", "nc", "é", "-", "x", "\n", "GNU General Public License"]
    scanner = licenses.Scanner()
    for _ in range(1500):
        t = " ".join(rng.choices(parts, k=rng.randint(0, 30)))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for p, label in PHRASES.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
        r = scanner.scan(t)
        assert (r["n_words"], r["n_base"]) == (len(ws), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({p for _, p in places}))
        assert {p for _, p in places} <= set(r["labels"].split(",")) or not places
        assert 0 <= r["score"] <= 1


def test_license_rules():
    scan = licenses.Scanner().scan
    assert scan("Licensed under the GNU Lesser General Public License v3")["labels"] == "lgpl-3"
    assert scan("SPDX-License-Identifier: MIT")["labels"] == "mit"
    assert scan("Licensed under the Apache License, Version 2.0.")["labels"] == "apache-2"
    assert scan("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by-nc"
    assert scan("This work is licensed under the GNU General Public License, version 3.")["labels"] == "gpl-3"
    assert scan("nothing to see")["labels"] == ""
    assert len(licenses.SIGNATURES) > 110 and len(licenses.rules()) > 400
    assert scan("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction")["labels"] == "mit"
    assert scan("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal with the Software without restriction")["labels"] == "ncsa"
    assert scan("Redistribution and use in source and binary forms, with or without modification, are permitted. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products")["labels"] == "bsd-3,bsd-any"
    assert scan("it under the terms; this program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")["labels"] == "gpl-3"
    assert scan("see https://creativecommons.org/licenses/by-nc-sa/4.0/")["labels"] == "cc-by-nc-sa"


def plain_english(pattern):
    """Texts that a signature matches, one for each choice among its alternatives."""
    return spelled(pattern.replace(r"\S+ ", "word ").replace(r"{1,14}", "").replace(r"{1,8}", "").replace(r"{1,6}", "").replace(r"\d{4}", "1999").replace("(?! provided)", ""))


def test_every_signature_passes_its_own_gate():
    scanner = licenses.Scanner()
    for label, _, _, keyword, pattern in licenses.SIGNATURES:
        assert any(k in pattern for k in keyword.split("|")) or label.startswith("openrail"), (keyword, pattern)
        for text in plain_english(pattern):
            low = f" {text} ".encode()
            assert any(k.encode() in low for k in keyword.split("|")), (keyword, low)
            assert label in {r.label for r, _, _ in scanner.detect(low)} or any(r.priority > 50 for r, _, _ in scanner.detect(low)), (label, low)


def spelled(pattern):
    """Texts that a pattern of the license tables matches: one for each choice among its alternatives."""

    def of(items):
        return ["".join(x) for x in product(*map(one, items))]

    def one(item):
        op, arg = str(item[0]), item[1]
        if op == "LITERAL":
            return [chr(arg)]
        if op == "BRANCH":
            return [x for branch in arg[1] for x in of(branch)]
        if op == "SUBPATTERN":
            return of(arg[3])
        if op == "MAX_REPEAT":
            return ["", *of(arg[2])] if arg[0] == 0 else of(arg[2])
        if op == "IN":
            return ["1" if str(arg[0][0]) == "CATEGORY" else chr(arg[0][1])]
        raise ValueError(op)

    return of(parser.parse(pattern))


def test_license_keywords_lose_no_detection():
    scanner = licenses.Scanner()
    every = licenses.rules()
    n = 0
    for _, _, name in licenses.LICENSES:
        for written in spelled(name):
            for phrase in ("spdx license identifier {}", "licensed under the {}", "released under the {}", "{} licence", "license is the {}"):
                low = f" {phrase.format(written)} ".encode()
                hits = [(r, m.start(), m.end()) for r in every for m in r.pattern.finditer(low)]
                hits.sort(key=lambda h: (-h[0].priority, h[1] - h[2], h[1], h[0].label))
                assert hits and scanner.detect(low) == licenses.suppress(hits), low
                n += 1
    assert n > 1000
    assert scanner.scan("Licensed under the Common Development and Distribution License")["labels"] == "cddl-1"
    assert scanner.scan("released under the zero clause BSD license")["labels"] == "0bsd"
    assert scanner.scan("licensed under the GNU Library General Public License, version 2")["labels"] == "lgpl-2"


def test_suppression_against_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        hits = []
        for i in range(rng.randint(0, 14)):
            a = rng.randint(0, 12)
            hits.append((i, a, a + rng.randint(1, 6)))
        kept = []
        for h in hits:
            if not any(k[1] <= h[1] and h[2] <= k[2] for k in kept):
                kept.append(h)
        assert licenses.suppress(hits) == sorted(kept, key=lambda h: (h[1], h[2]))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_lexicon_against_brute_force():
    rng = random.Random(6)
    terms = [("abcde", False, 3.0), ("abcabcabca", False, 2.0), ("bcdef", True, 1.0), ("abcdef", True, 2.5), ("abc", False, 4.0), ("cab", True, 1.0)]
    lex = toxicity.FuzzyLexicon(terms, most=50)
    for _ in range(6000):
        w = "".join(rng.choices("abcdef", k=rng.randint(0, 11)))
        best = None
        for i, (t, stem, weight) in enumerate(terms):
            ends = range(len(w) + 1) if stem else [len(w)]
            d = min(distance(w[:n], t) for n in ends)
            if d <= toxicity.edits(t, stem):
                best = min(best or (99,), (d, -weight, i))
        assert lex.find(w) == (None if best is None else (best[2], best[0])), w


def test_long_terms_match():
    term = "verylong" * 9
    matcher = toxicity.Matcher(toxicity.FuzzyLexicon([(term, False, 4.0)]))
    assert matcher[term.encode()] and matcher[(term[:-1] + "x").encode()] and not matcher[(term + "tail").encode()]


def test_quotation_scores_below_abuse():
    matcher = toxicity.Matcher(toxicity.FuzzyLexicon([(t, False, 4.0) for t in toxicity.SEED_TERMS]))
    plain = toxicity.features("you are an idiot and always were one", matcher)
    quoted = toxicity.features('the paper called him an "idiot" in its headline', matcher)
    wrong = toxicity.features("you are an idiiot and always were one", matcher)
    assert plain[0] > 0 and quoted[0] == 0 < quoted[1] and wrong[2] > 0 and plain[3] > quoted[3]


def plain_bits(train, text):
    """PPM code length of text by the definition."""
    counts = {}
    for t in train:
        x = b"\n\n\n" + t
        for i in range(3, len(x)):
            for k in range(4):
                d = counts.setdefault(x[i - k : i], {})
                d[x[i]] = d.get(x[i], 0) + 1
    x, bits = b"\n\n\n" + text, 0.0
    for i in range(3, len(x)):
        for k in (3, 2, 1, 0):
            d = counts.get(x[i - k : i])
            if not d:
                continue
            total = sum(d.values()) + len(d)
            if x[i] in d:
                bits += np.log2(total / d[x[i]])
                break
            bits += np.log2(total / len(d))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("dense", [3000, 0])
def test_ppm_code_lengths(monkeypatch, dense):
    monkeypatch.setattr(langid, "_DENSE", dense)
    rng = random.Random(3)
    make = lambda abc, n: bytes(rng.choices(abc, k=n))
    train = {"a": [make(b"abc d", 80) for _ in range(4)], "b": [make(b"bcde ", 60) for _ in range(4)]}
    grams = []
    for ts in train.values():
        w = np.concatenate([langid.windows(np.frombuffer(langid._PAD + t, np.uint8)) for t in ts])
        g, n = np.unique(w, return_counts=True)
        grams.append((g, n.astype(float)))
    model = langid.PPM(["a", "b"], grams)
    texts = [make(b"abcdef xyz", rng.randint(0, 50)) for _ in range(60)]
    got = model.code_lengths(texts)
    for t, row in zip(texts, got, strict=True):
        for j, ts in enumerate(train.values()):
            assert abs(row[j] - plain_bits(ts, t)) < 1e-3 * max(1, len(t))
