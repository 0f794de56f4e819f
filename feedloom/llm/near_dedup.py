"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of shingles of five words. A shingle weighs its count times
1 + the mean of its words' inverse document frequencies over ln(documents), so weights per occurrence lie in
1..2 at every corpus size. Frequencies of all words of all documents are held in a count-min sketch of a fixed
size: what collides makes a rare word look a little more frequent, for all documents alike. Each of BANDS * ROWS samples picks a shingle with probability proportional to
weight (Ioffe 2010); documents that agree on all ROWS samples of a band meet in a bucket. Pairs from buckets
are verified on whole texts by weighted Jaccard similarity, and verified links form the classes.

Large buckets. Only connectivity matters, and 1 - weighted Jaccard is a metric. So a bucket's members are
first compared with one leader; pairs already connected, and pairs that the triangle inequality excludes,
need no comparison. Of what remains, small buckets are compared pair by pair, and large ones block against
block, in matrix products of which only links leave the task. Beyond some blocks a bucket's members are first
regrouped by their rarest shingles: a pair that reaches the threshold shares one of those that make up the
first 1 - threshold of either weight, so boilerplate that fills a bucket compares nothing. No link among bucket
mates is lost.
"""

from __future__ import annotations

import math
from collections import Counter, OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SHORT_SHUFFLES, Rolling, WordTable, begin, chunks, cut, fresh, frugal, give_back, group_facts, mix64, settings, signed, words

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 16, 4
#: Cells of each of the two rows of the sketch of document frequencies: 8 MB together, whatever the vocabulary.
CELLS = 1 << 20
_CELL_BLOCK = 1 << 12
_POOL = 1 << 16
_SMALL = 16
#: Documents and characters of a block of a large bucket.
_BLOCK_DOCS, _BLOCK_CHARS = 512, 4_000_000
#: Open members of a bucket from which on they are regrouped by rare shingles: 16 blocks would be 16 copies of a text.
_REGROUP = 16 * _BLOCK_DOCS
_BROADCAST_ROWS = 500_000


def sketch_cells(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cells of words in the two rows of the sketch, the second row behind the first."""
    x = mix64(h)
    return (x % np.uint64(CELLS)).astype(np.int64), ((x >> np.uint64(32)) % np.uint64(CELLS)).astype(np.int64) + CELLS


def document_frequencies(docs: DataFrame, text_col: str, most: int = 150_000) -> DataFrame:
    """(cell, df) over all documents; a task holds about ``most`` words at once, besides those of one text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("near_dedup")
        seen, table = Counter(), WordTable(most)

        def out():
            h = table.hash_of(np.fromiter(map(table.__getitem__, seen), np.int64, len(seen)))
            n = np.fromiter(seen.values(), np.int64, len(seen))
            df = pd.DataFrame({"cell": np.concatenate(sketch_cells(h)), "df": np.concatenate([n, n])})
            seen.clear()
            table.room()
            return df

        for pdf in batches:
            for t in pdf.iloc[:, 0]:
                seen.update(set(words(t)))
                if len(seen) >= most:
                    yield out()
        yield out()
        table.clear()
        give_back()

    return frugal(docs).select(text_col).mapInPandas(run, "cell bigint, df bigint").groupBy("cell").agg(F.sum("df").alias("df"))


class Weights:
    """Scaled idf of all words: the greater of two cells of the sketch, 1 for a word that no document holds."""

    def __init__(self, idf: np.ndarray):
        self.idf = idf.astype(np.float32)

    @classmethod
    def learn(cls, docs: DataFrame, text_col: str) -> Weights:
        """The sketch reaches the driver as packed blocks of floats, 8 MB at most. Null texts hold no words."""
        n = docs.count()
        scale = 1 / math.log(n) if n > 1 else 0.0

        def pack(pdf: pd.DataFrame) -> pd.DataFrame:
            idf = np.ones(_CELL_BLOCK, np.float32)
            if scale:
                idf[pdf["cell"].to_numpy() % _CELL_BLOCK] = np.log(n / np.clip(pdf["df"].to_numpy(float), 1, n)) * scale
            return pd.DataFrame({"block": [int(pdf["cell"].iloc[0]) // _CELL_BLOCK], "idf": [idf.tobytes()]})

        cells = document_frequencies(docs, text_col)
        rows = cells.groupBy(F.floor(F.col("cell") / _CELL_BLOCK)).applyInPandas(pack, "block int, idf binary").collect()
        idf = np.ones((2 * CELLS // _CELL_BLOCK, _CELL_BLOCK), np.float32)
        for r in rows:
            idf[r["block"]] = np.frombuffer(r["idf"], np.float32)
        return cls(idf.ravel())

    def of(self, h: np.ndarray) -> np.ndarray:
        a, b = sketch_cells(h)
        return np.maximum(self.idf[a], self.idf[b])


def shingles(texts: list, table: WordTable, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, counts, weights, starts): the distinct shingles of each text, sorted by hash.

    A text of one to four words is a single shingle; one without words has none.
    """
    ids, starts = table.encode(texts)
    h = table.hash_of(ids)
    idf = np.concatenate([[0.0], np.cumsum(weights.of(h), dtype=np.float64)])
    roll = Rolling(h)
    out_h, out_c, out_w, at = [], [], [], np.zeros(len(texts) + 1, np.int64)
    for i in range(len(texts)):
        a, b = starts[i], starts[i + 1]
        if a == b:
            at[i + 1] = at[i]
            continue
        s = np.arange(a, max(a + 1, b - SHINGLE + 1))
        e = np.minimum(s + SHINGLE, b)
        u, first, n = np.unique(roll.span(s, e), return_index=True, return_counts=True)
        s, e = s[first], e[first]
        # rounded, so that the same shingle weighs the same wherever it stands in a chunk
        w = np.round(1 + (idf[e] - idf[s]) / (e - s), 5)
        out_h.append(u)
        out_c.append(n)
        out_w.append(n * w)
        at[i + 1] = at[i] + len(u)
    cat = lambda x, t: np.concatenate(x).astype(t, copy=False) if x else np.zeros(0, t)
    return cat(out_h, np.uint64), cat(out_c, np.int64), cat(out_w, np.float64), at


class Sampler:
    """Improved consistent weighted sampling with a pool of 65,536 parameter triples.

    A hash of (shingle, sample) picks the triple (r, c, beta). The pool is ordered by the least value that
    a weight in 1..2 can give, so that per document only the few shingles that can win are evaluated.
    """

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 11):
        rng = np.random.default_rng(seed)
        r, c, b = rng.gamma(2, 1, _POOL), rng.gamma(2, 1, _POOL), rng.random(_POOL)
        value = lambda lw: np.log(c) - r * (np.floor(lw / r + b) - b + 1)
        order = np.argsort(value(math.log(2) + 1e-9), kind="stable")
        low, high = value(math.log(2) + 1e-9)[order], value(0.0)[order]
        self.r, self.c, self.b = r[order], np.log(c)[order], b[order]
        self.reach = np.searchsorted(low, high, side="right").astype(np.uint32)
        self.mult = (rng.integers(0, 1 << 31, samples, dtype=np.uint64) * 2 + 1).astype(np.uint32)
        self.plus = rng.integers(0, 1 << 32, samples, dtype=np.uint64).astype(np.uint32)

    def sign(self, hashes: np.ndarray, weights: np.ndarray, counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The samples of each non-empty document, one row each, as 64-bit numbers."""
        out = np.zeros((len(starts) - 1, len(self.mult)), np.int64)
        size = np.diff(starts)
        lw = np.log(weights)
        small = (hashes >> np.uint64(32)).astype(np.uint32)
        tie = (hashes & np.uint64(0x7FFFFFFF)).astype(np.int64)
        many = np.flatnonzero(counts > 1)
        doc = np.repeat(np.arange(len(size)), size)
        for j in range(len(self.mult)):
            idx = (small * self.mult[j] + self.plus[j]) >> np.uint32(16)
            best = np.minimum.reduceat(idx, starts[:-1])
            may = idx <= np.repeat(self.reach[best], size)
            may[many] = True
            near = np.flatnonzero(may)
            k = idx[near]
            r, b = self.r[k], self.b[k]
            v = (self.c[k] - r * (np.floor(lw[near] / r + b) - b + 1)).astype(np.float32).view(np.int32)
            key = ((v ^ ((v >> 31) & 0x7FFFFFFF)).astype(np.int64) << 32) | tie[near]
            d = doc[near]
            out[:, j] = np.minimum.reduceat(key, np.flatnonzero(np.diff(d, prepend=-1)))
        return out


def signatures(docs: DataFrame, weights: Weights, id_col: str, text_col: str, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, f1, f2, bands): a 128-bit fingerprint of the weighted set and a key per band, null without words."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("near_dedup")
        table, sampler, w = WordTable(), Sampler(bands * rows), shared.value
        for pdf in batches:
            ids, texts = pdf["id"], pdf["text"].tolist()
            for a, b in chunks(texts):
                table.room()
                h, c, wt, at = shingles(texts[a:b], table, w)
                full = np.flatnonzero(np.diff(at))
                f1, f2, keys = [None] * (b - a), [None] * (b - a), [None] * (b - a)
                for lo in range(0, len(full), 256):
                    some = full[lo : lo + 256]
                    x, y = at[some[0]], at[some[-1] + 1]
                    starts = np.append(at[some], y) - x
                    sig = sampler.sign(h[x:y], wt[x:y], c[x:y], starts)
                    with np.errstate(over="ignore"):
                        n = c[x:y].astype(np.uint64)
                        p1 = signed(np.add.reduceat(mix64(h[x:y]) * n, starts[:-1]))
                        p2 = signed(np.add.reduceat(mix64(h[x:y] ^ np.uint64(0x5851F42D4C957F2D)) * n, starts[:-1]))
                        key = np.zeros((len(some), bands), np.uint64)
                        for r in range(rows):
                            key = mix64(key * np.uint64(3) + sig[:, r::rows].view(np.uint64) + np.arange(bands, dtype=np.uint64))
                    for k, i in enumerate(some):
                        f1[i], f2[i], keys[i] = p1[k], p2[k], signed(key[k])
                yield pd.DataFrame({"id": ids.iloc[a:b].to_numpy(), "f1": pd.array(f1, "Int64"), "f2": pd.array(f2, "Int64"), "bands": keys})
        table.clear()
        give_back()

    src = frugal(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    return src.mapInPandas(run, "id bigint, f1 bigint, f2 bigint, bands array<bigint>")


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard of two (hashes, counts, weights); the lesser count times the weight per occurrence is shared."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    shared = float(np.minimum(a[2][i], b[2][j]).sum())
    return shared / (float(a[2].sum()) + float(b[2].sum()) - shared)


def verify(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """(a, b, sim) for pairs (a, b) of ids, from whole texts (id, text)."""
    need = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    hold = need.count() <= _BROADCAST_ROWS
    texts = texts.join(F.broadcast(need) if hold else need, "id", "left_semi")
    side = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"t{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").sortWithinPartitions("a", "b")
    shared = pairs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, w, cache, held = WordTable(), shared.value, OrderedDict(), 0

        def weighed(key, text):
            nonlocal held
            if key in cache:
                cache.move_to_end(key)
                return cache[key]
            table.room()
            h, c, wt, _ = shingles([text], table, w)
            cache[key] = (h, c, wt)
            held += len(h)
            while held > 1_000_000 and len(cache) > 2:
                held -= len(cache.popitem(last=False)[1][0])
            return h, c, wt

        for pdf in batches:
            sims = [similarity(weighed((a, ta), ta), weighed((b, tb), tb)) for a, ta, b, tb in zip(pdf["a"], pdf["ta"], pdf["b"], pdf["tb"], strict=True)]
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "sim": sims})
        table.clear()
        cache.clear()
        give_back()

    out = frugal(both).select("a", "ta", "b", "tb").mapInPandas(run, "a bigint, b bigint, sim double")
    return out.groupBy("a", "b").agg(F.max("sim").alias("sim"))


def components(links: DataFrame) -> DataFrame:
    """(id, label): the least id of each component of links (a, b). Labels travel and jump until none changes."""
    both = cut(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = labels.join(seen, "id").select("id", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        jump = labels.select(F.col("id").alias("to"), F.col("label").alias("far"))
        moved = cut(step.join(jump, "to", "left").select("id", F.least("to", F.coalesce("far", "to")).alias("label"), "was"))
        changed = moved.where("label < was").limit(1).count()
        labels = moved.select("id", "label")
        if not changed:
            return labels


def occurrences(b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, weight of each feature; weight of each text) of (hashes, counts, weights, starts).

    A shingle that occurs c times is c features of its weight per occurrence.
    """
    h, c, w, at = b
    doc = np.repeat(np.repeat(np.arange(len(at) - 1), np.diff(at)), c)
    nth = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
    with np.errstate(over="ignore"):
        f = mix64(np.repeat(h, c) + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return doc, f, np.repeat(w / c, c), np.array([w[i:j].sum() for i, j in zip(at[:-1], at[1:], strict=True)])


def rarest(b: tuple, seen: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, weight of the text) for the features of which any partner must share one.

    All texts order features alike, by the cells of seen and then by hash. A text shares at least threshold times its
    own weight with a partner, so the first feature both have lies where no more than the rest stands before it.
    """
    doc, f, w, total = occurrences(b)
    order = np.lexsort((f, seen[(f % np.uint64(CELLS)).astype(np.int64)], doc))
    doc, f, w = doc[order], f[order], w[order]
    sums = np.concatenate([[0.0], np.cumsum(w)])
    before = sums[:-1] - sums[np.searchsorted(doc, doc)]
    keep = before <= (1 - threshold) * total[doc] + 1e-6
    return doc[keep], f[keep], total[doc[keep]]


def regroup(open_: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """(key, id, label, total, n): members (key, id, label) of very large buckets, grouped by their rarest features.

    The order of features comes from a sketch of CELLS counts, 4 MB; a blurred count changes the order for all alike
    and loses nothing. Of features that the same members share one is kept. Groups of one label go.
    """
    ids = cut(open_.select("id", "label").distinct())
    held = texts.join(F.broadcast(ids) if ids.count() <= _BROADCAST_ROWS else ids, "id").select("id", "label", "text")
    sc = open_.sparkSession.sparkContext
    shared = sc.broadcast(weights)

    def parts(pdf: pd.DataFrame, table: WordTable) -> Iterator[tuple[int, int, tuple]]:
        texts_ = pdf["text"].tolist()
        for a, b in chunks(texts_):
            table.room()
            yield a, b, shingles(texts_[a:b], table, shared.value)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, n = WordTable(), np.zeros(CELLS, np.int64)
        for pdf in batches:
            for _, _, b in parts(pdf, table):
                cell, k = np.unique(occurrences(b)[1] % np.uint64(CELLS), return_counts=True)
                n[cell.astype(np.int64)] += k
        cell = np.flatnonzero(n)
        yield pd.DataFrame({"cell": cell, "n": n[cell]})

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros(_CELL_BLOCK, np.float32)
        n[pdf["cell"].to_numpy() % _CELL_BLOCK] = pdf["n"].to_numpy()
        return pd.DataFrame({"block": [int(pdf["cell"].iloc[0]) // _CELL_BLOCK], "n": [n.tobytes()]})

    cells = frugal(held).mapInPandas(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    seen = np.zeros((CELLS // _CELL_BLOCK, _CELL_BLOCK), np.float32)
    for r in cells.groupBy(F.floor(F.col("cell") / _CELL_BLOCK)).applyInPandas(pack, "block int, n binary").collect():
        seen[r["block"]] = np.frombuffer(r["n"], np.float32)
    rank = sc.broadcast(seen.ravel())

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = WordTable()
        for pdf in batches:
            for a, _, b in parts(pdf, table):
                doc, f, total = rarest(b, rank.value, threshold)
                at = doc + a
                yield pd.DataFrame({"key": signed(f), "id": pdf["id"].to_numpy()[at], "label": pdf["label"].to_numpy()[at], "total": total})
        table.clear()
        give_back()

    posts = cut(frugal(held).mapInPandas(pick, "key bigint, id bigint, label bigint, total double"))
    mark = lambda *c: F.xxhash64(*c).cast("decimal(20,0)")
    aggs = {"n": (F.sum, F.lit(1).cast("bigint")), "lo": (F.min, F.col("label")), "hi": (F.max, F.col("label")), "s1": (F.sum, mark("id")), "s2": (F.sum, mark("id", F.lit(1)))}
    rows, facts = group_facts(posts, ["key"], F.col("id"), aggs, salts=16)
    facts = cut(facts.where("lo < hi").select("key", "_salt", "n", "s1", "s2"))
    one = facts.groupBy("n", "s1", "s2").agg(F.min("key").alias("key")).select("key")
    return rows.join(facts.join(one, "key", "left_semi"), ["key", "_salt"]).select("key", "id", "label", "total", "n")


def block_links(x: tuple, y: tuple, threshold: float) -> np.ndarray:
    """The pairs of rows (i of x, j of y) whose weighted Jaccard reaches the threshold.

    x and y are (hashes, counts, weights, starts) of blocks. Shared weight is one product of 0/1 matrices over
    the features of both.
    """
    (dx, fx, wx, tx), (dy, fy, _, ty) = occurrences(x), occurrences(y)
    both, first = np.unique(fx, return_index=True)
    keep = np.isin(both, fy)
    both, weight = both[keep], wx[first[keep]]
    shared = np.zeros((len(tx), len(ty)))
    for lo in range(0, len(both), 4096):  # bounds the matrices
        part, w = both[lo : lo + 4096], weight[lo : lo + 4096]
        m = []
        for d, f, n in ((dx, fx, len(tx)), (dy, fy, len(ty))):
            at = np.minimum(np.searchsorted(part, f), len(part) - 1)
            hit = part[at] == f
            m.append(np.zeros((n, len(part))))
            m[-1][d[hit], at[hit]] = 1.0
        shared += (m[0] * w) @ m[1].T
    total = tx[:, None] + ty[None, :]
    return np.argwhere((shared > 0) & (shared >= threshold * (total - shared) - 1e-9))


def large_links(open_: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """(a, b) links among the members (key, id, label) of large buckets, found block against block.

    A bucket is cut into blocks of a bounded size; each pair of blocks is one row, compared inside one task
    by matrix products, and only links leave it. Every pair of different labels is compared.
    """
    spark = open_.sparkSession
    held = open_.join(texts, "id")
    held = held.withColumn("chars", F.length("text"))
    rows, facts = group_facts(held, ["key"], F.col("id"), {"m": (F.sum, F.lit(1).cast("bigint")), "c": (F.sum, F.col("chars").cast("bigint"))}, salts=16)
    cells = F.greatest(F.ceil(F.col("m") / _BLOCK_DOCS), F.ceil(F.col("c") / _BLOCK_CHARS))
    rows = rows.join(facts, ["key", "_salt"]).withColumn("blocks", cells).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    # a block goes to each of its pairs of blocks; side tells which half of the pair it is
    each = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    pairs = each.select("key", lo.alias("lo"), hi.alias("hi"), (F.col("block") > F.col("other")).alias("side"), "id", "label", "text")
    met = pairs.groupBy("key", "lo", "hi").agg(F.collect_list(F.struct("side", "id", "label", "text")).alias("docs")).select("lo", "hi", "docs")
    shared = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, w = WordTable(), shared.value
        for pdf in batches:
            for same, docs in zip(pdf["lo"] == pdf["hi"], pdf["docs"], strict=True):
                table.room()
                sides = [[d for d in docs if d["side"] == s] for s in (False, True)]
                if same:
                    sides[1] = sides[0]
                if not sides[0] or not sides[1]:
                    continue
                x = shingles([d["text"] for d in sides[0]], table, w)
                y = x if same else shingles([d["text"] for d in sides[1]], table, w)
                found = [(sides[0][i], sides[1][j]) for i, j in block_links(x, y, threshold)]
                links = sorted({(min(p["id"], q["id"]), max(p["id"], q["id"])) for p, q in found if p["label"] != q["label"]})
                yield pd.DataFrame(links, columns=["a", "b"]).astype("int64")
        table.clear()
        give_back()

    return frugal(met).mapInPandas(run, "a bigint, b bigint").distinct()


def near_links(members: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """(id, label) of all ids that have a link, for bucket members (key, id)."""
    rows, facts = group_facts(members, ["key"], F.struct("id", "key"), {"n": (F.sum, F.lit(1).cast("bigint"))}, salts=16)
    mates = cut(rows.join(facts.where("n > 1"), ["key", "_salt"]).select("key", "id", "n"))
    # the leader of a bucket is its member with the most mates in all bands: in a group of copies that is the
    # text closest to the others, most of which it links at once
    known = mates.groupBy("id").agg(F.sum("n").alias("mates"))
    rows, facts = group_facts(mates.join(known, "id"), ["key"], F.struct("id", "key"), {"best": (F.max, F.struct("mates", F.bitwise_not("id").alias("o"), "id"))}, salts=16)
    active = cut(rows.join(facts, ["key", "_salt"]).select("key", "id", F.col("best.id").alias("lead")))
    first = active.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    checked = cut(verify(cut(first), texts, weights))
    labels = components(checked.where(F.col("sim") >= threshold))
    # what the leaders leave open: mates of different labels that the distance to the leader does not exclude
    d = checked.select(F.col("a").alias("lead"), F.col("b").alias("id"), (1 - F.col("sim")).alias("d"))
    rest = active.where("id <> lead").join(d, ["lead", "id"]).join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    head = labels.select(F.col("id").alias("lead"), F.col("label").alias("head"))
    rest = rest.join(head, "lead", "left").withColumn("home", F.col("label") == F.coalesce("head", "lead"))
    rows, facts = group_facts(rest, ["key"], F.struct("id", "key"), {"lo": (F.min, F.col("label")), "hi": (F.max, F.col("label")), "n": (F.sum, F.lit(1).cast("bigint")), "gap": (F.min, F.when(~F.col("home"), F.col("d")))}, salts=16)
    open_ = rows.join(facts.where("lo < hi"), ["key", "_salt"])
    open_ = cut(open_.where(~F.col("home") | (F.col("d") >= F.col("gap") - (1 - threshold) - 1e-9)).select("key", "id", "d", "label", "n"))
    x, y = (open_.where(f"n <= {_SMALL}").select("key", *(F.col(c).alias(c + s) for c in ("id", "d", "label"))) for s in "xy")
    may = (F.col("labelx") != F.col("labely")) & (F.abs(F.col("dx") - F.col("dy")) <= 1 - threshold + 1e-9) & (F.col("idx") < F.col("idy"))
    pairs = cut(x.join(y, "key").where(may).select(F.col("idx").alias("a"), F.col("idy").alias("b")).distinct())
    large = open_.where(f"n > {_SMALL}").select("key", "id", "label")
    sizes = large.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    vast = cut(large.join(sizes.where(F.col("m") > _REGROUP), "key", "left_semi"))
    if vast.limit(1).count():
        large = large.join(sizes.where(F.col("m") <= _REGROUP), "key", "left_semi")
        met = cut(regroup(vast, texts, weights, threshold))
        large = large.unionByName(met.where(f"n > {_SMALL}").select("key", "id", "label"))
        x, y = (met.where(f"n <= {_SMALL}").select("key", *(F.col(c).alias(c + s) for c in ("id", "label", "total"))) for s in "xy")
        near = F.least("totalx", "totaly") >= threshold * F.greatest("totalx", "totaly") - 1e-6
        more = x.join(y, "key").where((F.col("labelx") != F.col("labely")) & (F.col("idx") < F.col("idy")) & near)
        pairs = cut(pairs.unionByName(more.select(F.col("idx").alias("a"), F.col("idy").alias("b"))).distinct())
    found = verify(pairs, texts, weights).where(F.col("sim") >= threshold).select("a", "b")
    found = cut(found.unionByName(large_links(large, texts, weights, threshold)))
    if found.limit(1).count() == 0:
        return labels
    return components(labels.select(F.col("label").alias("a"), F.col("id").alias("b")).union(found))


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: the id, class_id (the least id of its class) and kept (whether it is that id).

    Texts with the same weighted shingle set fall together first; only one of each enters the buckets. A
    null or empty text, or one of white space, has no shingles and is a class of its own. Rows that repeat
    an id count as one document with several texts. A row without an id has class null and is kept. An empty
    table gives no rows. Texts are read whole; other columns are not read.
    """
    with settings(docs.sparkSession, SHORT_SHUFFLES):
        return _near_classes(docs, id_col, text_col, threshold)


def _near_classes(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    weights = Weights.learn(docs, text_col)
    sig = cut(signatures(docs, weights, id_col, text_col))
    full = sig.where("f1 is not null")
    rows, facts = group_facts(full.select("id", "f1", "f2"), ["f1", "f2"], F.col("id"), {"rep": (F.min, F.col("id"))})
    facts = cut(facts)
    reps = facts.select("f1", "f2", F.col("rep").alias("id")).distinct()
    members = full.join(reps, ["f1", "f2", "id"], "left_semi").select("id", F.explode("bands").alias("key")).distinct()
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    labels = near_links(members.select("key", "id"), texts, weights, threshold)
    named = facts.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("f1", "f2", "_salt", F.coalesce("label", "rep").alias("class_id"))
    out = rows.join(named, ["f1", "f2", "_salt"]).select("id", "class_id")
    out = out.union(sig.where("f1 is null").select("id", F.col("id").alias("class_id")))
    out = out.union(docs.where(F.col(id_col).isNull()).select(F.lit(None).cast("bigint"), F.lit(None).cast("bigint")))
    return out.select(F.col("id").alias(id_col), "class_id", F.col("id").eqNullSafe(F.col("class_id")).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that near_classes keeps, all columns as they are: one document of each class."""
    g = fresh(docs.columns, "_gone")
    gone = cut(near_classes(docs, id_col, text_col, threshold).where("not kept").select(F.col(id_col).alias(g)).distinct())
    hold = gone.count() <= _BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if hold else gone, F.col(id_col) == F.col(g), "left_anti")
