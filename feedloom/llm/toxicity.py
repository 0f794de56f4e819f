"""Toxicity: a lexicon matched with misspellings, scored in context windows.

The lexicon is a list of insults plus words and stems that labelled training rows show to be toxic. It is kept
as a trie; its product with Levenshtein automata is determinised as words arrive, so a word is read once,
byte by byte, and most words die after a few letters. Each hit is weighed in its window of words: hits next to
quotation marks or reporting words count as quoted, others as abuse. A logistic model on these window scores,
fitted on labelled training rows, gives the score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, frugal, give_back, words

#: Insults that are terms from the start (fixed values).
SEED_TERMS = """
asshole bastard bitch bullshit cockroach coward cretin cunt degenerate dickhead dimwit disgusting dumbass dumb
dipshit fool fuck fucking garbage halfwit idiot idiotic imbecile jerk loser lowlife maggot moron moronic nitwit
parasite pathetic pig prick retard retarded scum scumbag shit shithead slut stupid subhuman trash twat vermin
whore worthless clown
""".split()
#: Words that report speech, and words of address (fixed values).
REPORTING = frozenset("said says say called calls wrote writes quoted quote quotes alleged claimed reported term word phrase insult slur".split())
ADDRESS = frozenset("you your you're youre u ur are tu toi vous du dich ihr usted".split())
QUOTES = frozenset("\"“”«»„‟")
_STRIP = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~“”«»„‟’‘…¡¿"

#: Words on either side that make a hit's window.
WINDOW = 6
#: The model is fitted on about so many labelled rows, chosen by a hash of their ids.
TRAIN_ROWS = 20_000
#: Terms learned at most, the prefix lengths tried, and the evidence (likelihood ratio) that a term needs.
MAX_TERMS, PREFIXES, EVIDENCE = 400, range(3, 13), 25.0
FEATURES = 7


def edits(term: str, prefix: bool) -> int:
    """Misspellings allowed: none in short terms, two in long words, at most one in stems."""
    n = len(term)
    return 0 if n < (6 if prefix else 5) else 2 if n >= 10 and not prefix else 1


class FuzzyLexicon:
    """The trie of terms times their Levenshtein automata, determinised lazily.

    A state is a set of (trie node, errors) and the best stem met so far. find() gives (term index, errors)
    of the closest term, the heavier first among equals, or None.
    """

    def __init__(self, terms: list[tuple[str, bool, float]], most: int = 100_000):
        """terms: (text, whether any ending may follow, weight)."""
        self.terms, self.most = terms, most
        self.next: list[dict[str, int]] = [{}]
        self.word: list[int] = [-1]
        self.stem: list[int] = [-1]
        self.room = [0]
        for i, (t, prefix, w) in enumerate(terms):
            k, node = edits(t, prefix), 0
            self.room[0] = max(self.room[0], k)
            for c in t:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.word.append(-1)
                    self.stem.append(-1)
                    self.room.append(0)
                node = self.next[node][c]
                self.room[node] = max(self.room[node], k)
            at = self.stem if prefix else self.word
            if at[node] < 0 or terms[at[node]][2] < w:
                at[node] = i
        self._reset()

    def _reset(self) -> None:
        self.ids: dict = {}
        self.sets: list = []
        self.step: dict[tuple[int, str], int] = {}
        self.ends: list = []
        self.start = self._state({(0, 0)}, None)

    def _better(self, a, i: int, e: int):
        if i < 0 or e > edits(*self.terms[i][:2]):
            return a
        rank = lambda h: (h[1], -self.terms[h[0]][2], h[0])
        return (i, e) if a is None or rank((i, e)) < rank(a) else a

    def _state(self, items: set, hit) -> int:
        todo = list(items)
        least: dict[int, int] = {}
        while todo:  # skipping a letter of the term
            node, e = todo.pop()
            if least.get(node, 99) <= e:
                continue
            least[node] = e
            todo += [(n, e + 1) for n in self.next[node].values() if e + 1 <= self.room[n]]
        for node, e in least.items():
            hit = self._better(hit, self.stem[node], e)
        key = (frozenset(least.items()), hit)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            end = hit
            for node, e in least.items():
                end = self._better(end, self.word[node], e)
            self.ends.append(end)
        return self.ids[key]

    def _move(self, state: int, c: str) -> int:
        least, hit = self.sets[state]
        items = set()
        for node, e in least:
            if (n := self.next[node].get(c)) is not None:
                items.add((n, e))
            if e < self.room[node]:
                items.add((node, e + 1))
                items |= {(n, e + 1) for n in self.next[node].values() if e + 1 <= self.room[n]}
        return self._state(items, hit) if items or hit else -1

    def find(self, word: str) -> tuple[int, int] | None:
        if len(self.sets) > self.most:
            self._reset()
        state, step = self.start, self.step
        for c in word:
            to = step.get((state, c))
            if to is None:
                to = step[state, c] = self._move(state, c)
            if to < 0:
                return None
            state = to
        return self.ends[state]


def bare(word: bytes) -> str:
    return word.decode("utf-8", "replace").lower().strip(_STRIP)


class Matcher(dict):
    """From a word of a text to 1 + term index and errors packed, or 0; keeps the words met last."""

    def __init__(self, lexicon: FuzzyLexicon, most: int = 400_000):
        super().__init__()
        self.lexicon, self.most = lexicon, most

    def __missing__(self, word: bytes) -> int:
        hit = self.lexicon.find(bare(word))
        code = 0 if hit is None else (hit[0] + 1) * 4 + hit[1]
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = code
        return code


def features(text: str | None, matcher: Matcher) -> list[float]:
    """Window scores of one text: abuse, quoted, misspelled, the largest window, hits, their density, the heaviest term."""
    ws = words(text)
    codes = np.fromiter(map(matcher.__getitem__, ws), np.int64, len(ws))
    hits = np.flatnonzero(codes)
    if not len(hits):
        return [0.0] * FEATURES
    terms = matcher.lexicon.terms
    weight, errors = np.array([terms[c // 4 - 1][2] for c in codes[hits]]), codes[hits] % 4
    value = weight * np.where(errors == 0, 1.0, np.where(errors == 1, 0.5, 0.25))
    quoted = np.zeros(len(hits), bool)
    direct = np.ones(len(hits))
    for k, i in enumerate(hits):
        near = [w.decode("utf-8", "replace") for w in ws[max(0, i - WINDOW) : i + WINDOW + 1]]
        before = near[: min(i, WINDOW) + 1]
        after = near[min(i, WINDOW) :]
        marks = any(QUOTES & set(w) for w in before) and any(QUOTES & set(w) for w in after)
        quoted[k] = marks or any(w.lower().strip(_STRIP) in REPORTING for w in before[-4:-1])
        if any(w.lower().strip(_STRIP) in ADDRESS for w in near):
            direct[k] = 1.2
    value = value * np.where(quoted, 0.3, direct)
    lo, hi = np.searchsorted(hits, hits - WINDOW), np.searchsorted(hits, hits + WINDOW, side="right")
    sums = np.concatenate([[0.0], np.cumsum(value)])
    exact = errors == 0
    top = (value * exact).max()
    return [math.log1p(float(value[exact & ~quoted].sum())), math.log1p(float(value[quoted].sum())), math.log1p(float(value[~exact & ~quoted].sum())), math.log1p(float((sums[hi] - sums[lo]).max())), math.log1p(int((exact & ~quoted).sum())), math.log1p(100 * len(hits) / len(ws)), float(top)]


class Model:
    def __init__(self, terms: list[tuple[str, bool, float]], coef: np.ndarray):
        self.terms, self.coef = terms, coef

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip(rows @ self.coef[:-1] + self.coef[-1], -30, 30)
        return 1 / (1 + np.exp(-z))


def sample(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """(text, label) of about ``rows`` labelled rows, chosen by a hash of their ids."""
    lab = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).where(allowed)
    share = rows / max(1, lab.count())
    place = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = cut(lab.where(place < share).groupBy("_id").agg(F.max("label").alias("label")))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return cut(texts.join(F.broadcast(chosen), "_id").select("text", "label"))


def learn_terms(rows: DataFrame) -> list[tuple[str, bool, float]]:
    """Words and stems that toxic rows hold far more often than others, by the likelihood ratio of document counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen: Counter = Counter()
            for t, y in zip(pdf["text"], pdf["label"], strict=True):
                some = {w for w in map(bare, set(words(t))) if w}
                mine = {(w, False) for w in some if len(w) <= 40} | {(w[:n], True) for w in some for n in PREFIXES if n < len(w)}
                seen.update((w, p, y) for w, p in mine)
            yield pd.DataFrame([(w, p, n if y else 0, 0 if y else n) for (w, p, y), n in seen.items()], columns=["term", "stem", "a", "b"])

    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        return []
    counts = frugal(rows).mapInPandas(run, "term string, stem boolean, a bigint, b bigint").groupBy("term", "stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    p = pos / (pos + neg)
    a, b = F.col("a"), F.col("b")
    part = lambda x, q: F.when(x > 0, x * F.log(x / ((a + b) * q))).otherwise(0.0)
    odds = F.log((a + 0.5) / (pos + 1.0)) - F.log((b + 0.5) / (neg + 1.0))
    scored = counts.withColumn("g", 2 * (part(a, p) + part(b, 1 - p))).withColumn("w", odds).where((F.col("g") >= EVIDENCE) & (F.col("w") >= 2.5))
    found = scored.orderBy(F.desc("g"), "term", "stem").limit(20 * MAX_TERMS).collect()
    kept: dict[str, float] = {}
    covered: dict[str, int] = {}
    out = []
    # the longest term of equal evidence speaks for its own beginnings, a stem for its purer or equal endings
    for r in sorted(found, key=lambda r: (-r["g"], -len(r["term"]), r["stem"], r["term"])):
        term, purity = r["term"], r["b"] / r["a"]
        if covered.get(term, 0) >= 0.9 * r["a"] or any(term[:n] in kept and kept[term[:n]] <= purity + 0.005 for n in PREFIXES if n <= len(term)):
            continue
        if r["stem"]:
            kept[term] = purity
        for n in range(1, len(term) + 1):
            covered[term[:n]] = max(covered.get(term[:n], 0), r["a"])
        out.append((term, r["stem"], min(8.0, r["w"])))
    return out[:MAX_TERMS]


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 40) -> np.ndarray:
    """Logistic regression by Newton's method; the last coefficient is the intercept."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (p - y) + penalty * w
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(penalty), grad)
        w = w - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """The lexicon and model of a bounded sample of the labelled rows that ``allowed`` (over column _id) admits.

    Without labels of both kinds the model is the seed list with fixed coefficients. Null texts are empty ones; null
    labels, ids without a document and documents without a label teach nothing; of labels that repeat an id the greatest
    counts. At most MAX_TERMS terms are learned, those of the most evidence.
    """
    some = sample(docs, labels, allowed, id_col, text_col, label_col, rows)
    learned = learn_terms(some)
    have = {t for t, stem, _ in learned}
    terms = learned + [(t, False, 4.0) for t in SEED_TERMS if t not in have]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(FuzzyLexicon(terms))
        for pdf in batches:
            yield pd.DataFrame({"x": [features(t, matcher) for t in pdf["text"]], "y": pdf["label"].astype(float)})

    got = frugal(some).mapInPandas(run, "x array<double>, y double").toPandas()
    if got["y"].nunique() < 2:
        return Model(terms, np.array([1.0, 0.2, 0.3, 0.5, 0.5, 0.1, 0.1, -3.0]))
    return Model(terms, fit(np.array(got["x"].tolist()), got["y"].to_numpy()))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs without text_col, plus score in 0..1; a column of docs with that name is replaced.

    Null and empty texts have no hits and get the model's least evidence. Every row is scored by itself and
    whole; rows may repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        matcher = Matcher(FuzzyLexicon(m.terms))
        for s in batches:
            rows = np.array([features(t, matcher) for t in s], float).reshape(-1, FEATURES)
            yield pd.Series(m.score(rows))
        matcher.clear()
        give_back()

    rest = [c for c in docs.columns if c != text_col and c.lower() != "score"]
    s = fresh(docs.columns, "_score")
    return frugal(docs).withColumn(s, scored(F.col(text_col))).select(*rest, F.col(s).alias("score"))
