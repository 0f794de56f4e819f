"""Language ID by prediction by partial matching (PPM, escape method C) over bytes.

Per language a context tree of up to ORDER bytes gives each next byte a probability: count / (total +
distinct) where the context has seen it, else an escape of distinct / (total + distinct) to the next shorter
context, down to a uniform byte. Statistics are frozen after training, so a text's code length is a sum of
table entries: each 4-byte window is looked up once for all languages together, and windows that no training
text holds fall back through the same escapes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, cut, fresh, frugal, give_back

ORDER = 3
#: The model is fitted on about so many rows of each language, chosen by a hash of their ids: this bounds it.
TRAIN_ROWS = 2_000
_PAD = b"\n\n\n"
_BLOCK = 1 << 20
_DENSE = 3_000
_LETTER = re.compile(r"[^\W\d_]")


def windows(data: np.ndarray) -> np.ndarray:
    """The code of each byte from the fourth on with the three before it."""
    x = data.astype(np.uint32)
    return (x[:-3] << np.uint32(24)) | (x[1:-2] << np.uint32(16)) | (x[2:-1] << np.uint32(8)) | x[3:]


def sample(docs: DataFrame, allowed: Column, id_col: str, lang_col: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """About ``rows`` labelled rows of each language. A row's place depends on its id alone, a null id's is that of an
    empty one; rows without a language are left out, and a row that ``allowed`` is null for too."""
    good = docs.where(allowed & F.col(lang_col).isNotNull())
    key, n = fresh(docs.columns, "_lang"), fresh(docs.columns, "_n")
    sizes = cut(good.groupBy(F.col(lang_col).alias(key)).agg(F.count(F.lit(1)).alias(n)))
    place = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return good.join(F.broadcast(sizes), F.col(lang_col) == F.col(key)).where(place * F.col(n) < rows).drop(key, n)


class PPM:
    """Frozen statistics of all languages as tables of code lengths in bits."""

    def __init__(self, langs: list[str], grams: list[tuple[np.ndarray, np.ndarray]]):
        """grams: for each language its 4-byte windows and their counts."""
        self.langs = langs
        k = len(langs)
        self.keys, self.cost, self.contexts, self.escape = [], [], [], []
        lower = np.full((256, k), 8.0)
        for order in range(ORDER + 1):
            mask = np.uint64((1 << 8 * (order + 1)) - 1)
            per = []
            for g, n in grams:
                u, at = np.unique(g.astype(np.uint64) & mask, return_inverse=True)
                per.append((u, np.bincount(at, weights=n, minlength=len(u)) if len(u) else np.zeros(0)))
            keys = np.unique(np.concatenate([u for u, _ in per])) if per else np.zeros(0, np.uint64)
            ctx = np.unique(keys >> np.uint64(8))
            esc, cost = np.zeros((len(ctx), k)), np.zeros((len(keys), k))
            up = self._below(keys, order, lower)
            for j, (u, n) in enumerate(per):
                c = np.searchsorted(ctx, u >> np.uint64(8))
                total, kinds = np.bincount(c, weights=n, minlength=len(ctx)), np.bincount(c, minlength=len(ctx))
                seen = total > 0
                esc[seen, j] = np.log2((total[seen] + kinds[seen]) / kinds[seen])
                cost[:, j] = up[:, j] + esc[np.searchsorted(ctx, keys >> np.uint64(8)), j]
                cost[np.searchsorted(keys, u), j] = np.log2((total + kinds)[c] / n)
            self.keys.append(keys)
            self.cost.append(cost)
            self.contexts.append(ctx)
            self.escape.append(esc)
        self.cost[-1] = self.cost[-1].astype(np.float32)
        self._index()

    def _below(self, codes: np.ndarray, order: int, base: np.ndarray | None = None) -> np.ndarray:
        """Bits of the last byte of each code given the context one byte shorter."""
        if order == 0:
            return np.full((len(codes), len(self.langs)), 8.0)
        return self._bits(codes & np.uint64((1 << 8 * order) - 1), order - 1)

    def _bits(self, codes: np.ndarray, order: int) -> np.ndarray:
        keys = self.keys[order]
        at = np.minimum(np.searchsorted(keys, codes), max(0, len(keys) - 1))
        found = keys[at] == codes if len(keys) else np.zeros(len(codes), bool)
        out = np.empty((len(codes), len(self.langs)))
        out[found] = self.cost[order][at[found]]
        if not found.all():
            rest = codes[~found]
            bits, ctx = self._below(rest, order), self.contexts[order]
            if len(ctx):
                c = rest >> np.uint64(8)
                i = np.minimum(np.searchsorted(ctx, c), len(ctx) - 1)
                bits = bits + np.where((ctx[i] == c)[:, None], self.escape[order][i], 0.0)
            out[~found] = bits
        return out

    def _index(self) -> None:
        """Two pairs of bytes address a dense table of rows where few pairs occur."""
        keys = self.keys[-1]
        first, last = (keys >> np.uint64(16)).astype(np.int64), (keys & np.uint64(0xFFFF)).astype(np.int64)
        pairs = np.unique(np.concatenate([first, last]))
        self.pair = np.zeros(1 << 16, np.int32)
        self.pair[pairs] = np.arange(1, len(pairs) + 1)
        self.width = len(pairs) + 1
        self.dense = None
        if self.width <= _DENSE:
            self.dense = np.full(self.width * self.width, -1, np.int32)
            self.dense[self.pair[first] * self.width + self.pair[last]] = np.arange(len(keys))

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """The row of each window in the last table, or -1."""
        if self.dense is not None:
            return self.dense[self.pair[codes >> np.uint32(16)] * np.int32(self.width) + self.pair[codes & np.uint32(0xFFFF)]]
        keys = self.keys[-1]
        at = np.minimum(np.searchsorted(keys, codes.astype(np.uint64)), len(keys) - 1)
        return np.where(keys[at] == codes, at, -1)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        data = np.frombuffer(b"".join(x for t in texts for x in (_PAD, t)), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        if not len(self.keys[-1]) or not sizes.sum():
            return out
        # the windows that end in a text's bytes; those of the padding are left out
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        at = np.arange(len(doc)) + 3 * doc.astype(np.int64)
        for lo in range(0, len(doc), _BLOCK):
            a, d = at[lo : lo + _BLOCK], doc[lo : lo + _BLOCK]
            codes = windows(data[a[0] : a[-1] + 4])[a - a[0]]
            row = self.rows(codes)
            bits = self.cost[-1][row]
            lost = np.flatnonzero(row < 0)
            if len(lost):
                bits[lost] = self._bits(codes[lost].astype(np.uint64), ORDER)
            starts = np.flatnonzero(np.diff(d, prepend=-1))
            np.add.at(out, d[starts], np.add.reduceat(bits, starts, axis=0, dtype=np.float64))
        return out

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        """(language, its posterior under equal priors); und and 0 for a null text or one without a letter."""
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        bits = self.code_lengths(raw)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        best = bits.argmin(axis=1)
        gap = np.minimum((bits - bits.min(axis=1, keepdims=True)) * np.log(2), 700)
        score = 1 / np.exp(-gap).sum(axis=1)
        letters = np.array([bool(t and _LETTER.search(t)) for t in texts], bool)
        return [self.langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], np.where(letters, score, 0.0)


def train(labelled: DataFrame, text_col: str, lang_col: str) -> PPM:
    """The model of labelled rows, which should be a bounded sample; only their window counts reach the driver.

    A null text is an empty one, a null language is left out, rows may repeat and count again. Texts are read whole, a
    chunk of them at once. Without rows the model knows no language.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lang, some in pdf.groupby("lang"):
                texts = some["text"].tolist()
                for a, b in chunks(texts):
                    data = np.frombuffer(b"".join(_PAD + t.encode("utf-8", "replace") for t in texts[a:b]), np.uint8)
                    if len(data) > 3:
                        g, n = np.unique(windows(data), return_counts=True)
                        yield pd.DataFrame({"lang": lang, "g": g.astype(np.int64), "n": n})
        give_back()

    src = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = frugal(src).mapInPandas(run, "lang string, g bigint, n bigint").groupBy("lang", "g").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique())
    return PPM(langs, [(x["g"].to_numpy().astype(np.uint32), x["n"].to_numpy(float)) for x in (rows[rows["lang"] == k] for k in langs)])


def identify(docs: DataFrame, model: PPM, text_col: str = "text") -> DataFrame:
    """docs without text_col, plus lang_pred and score; a column of docs with such a name is replaced.

    A null text, or one without a letter, gets und and 0. Every row is scored by itself and whole; rows may
    repeat. Without any training row every text is und.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for s in batches:
            texts = [t if isinstance(t, str) else None for t in s]
            parts = [m.predict(texts[a:b]) for a, b in chunks(texts)]
            yield pd.DataFrame({"lang_pred": [x for p, _ in parts for x in p], "score": np.concatenate([p for _, p in parts]) if parts else np.zeros(0)})

    m = fresh(docs.columns, "_lang")
    rest = [c for c in docs.columns if c != text_col and c.lower() not in ("lang_pred", "score")]
    return frugal(docs).withColumn(m, scored.asNondeterministic()(F.col(text_col))).select(*rest, f"{m}.*")
