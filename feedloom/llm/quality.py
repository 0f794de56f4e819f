"""Quality rules at document and host level.

Documents are measured one by one. Rule failures are then summed per host, each host's failure rate is
shrunk towards all hosts' with a beta prior fitted by moments of all hosts, and the host's verdict is joined back:
on a strict host a document that fails any soft rule goes as well. A document that fails no rule stays
on every host.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, CHUNK_CHARS, WordTable, begin, chunks, cut, fresh, frugal, give_back, group_facts

_SYMBOLS = "#*$%&|<>"
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"

#: Soft rules on the measures; a document alone is not rejected by them.
SOFT_RULES: dict[str, str] = {
    "many_symbols": "10 * n_symbols > n_words",
    "dup_lines": "n_dup_lines > 5",
    "odd_word_length": "word_chars > 20 * n_words or word_chars < 2 * n_words",
}
BASE_RULE = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"
#: A host is strict if its shrunk rate of documents that fail any rule exceeds this.
STRICT_RATE = 0.5
#: Hosts of fewer documents do not shape beta_prior(), which the SQL of op4_quality_rules states.
PRIOR_LEAST = 20


def repeated_words(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text, its words inside 3-word windows that occur twice or more in it."""
    n = len(starts) - 1
    out = np.zeros(n, np.int64)
    if len(ids) < 3:
        return out
    size = int(ids.max()) + 1
    doc = np.repeat(np.arange(n), np.diff(starts))
    at = np.flatnonzero(doc[:-2] == doc[2:])
    if not len(at):
        return out
    if size < 1 << 21:
        code = (ids[at] * size + ids[at + 1]) * size + ids[at + 2]
    else:
        pair = np.unique(ids[at] * size + ids[at + 1], return_inverse=True)[1]
        code = pair * size + ids[at + 2]
    order = np.lexsort((code, doc[at]))
    code, where = code[order], at[order]
    same = (code[1:] == code[:-1]) & (doc[where[1:]] == doc[where[:-1]])
    twice = np.zeros(len(code), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(ids), bool)
    for k in range(3):
        hit[where[twice] + k] = True
    return np.bincount(doc[hit], minlength=n)


def measure(texts: list, table: WordTable) -> dict[str, np.ndarray]:
    parts: list[dict] = []
    for a, b in chunks(texts, CHUNK_CHARS):
        table.room()
        some = [t or "" for t in texts[a:b]]
        ids, starts = table.encode(some)
        lines = [[x for x in t.split("\n") if x.strip(ASCII_SPACE)] for t in some]
        parts.append(
            {
                "n_words": np.diff(starts),
                "word_chars": np.array([len(t) - sum(map(t.count, ASCII_SPACE)) for t in some], np.int64),
                "n_symbols": np.array([sum(map(t.count, _SYMBOLS)) for t in some], np.int64),
                "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
                "n_repeat_words": repeated_words(ids, starts),
            }
        )
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}


def measures(text: Column) -> Column:
    """A struct of MEASURES. Marked non-deterministic so that the optimizer does not evaluate it twice."""

    @F.pandas_udf(MEASURES)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        begin("quality")
        table = WordTable()
        for s in batches:
            yield pd.DataFrame(measure([x if isinstance(x, str) else None for x in s], table))
        table.clear()
        give_back()

    return measured.asNondeterministic()(text)


def fitted_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) of a beta-binomial by moments over all hosts, weighted by their documents: two numbers for the driver.

    The mean is the failure rate of all documents. The spread is what the hosts' rates vary beyond chance, so a
    host of one document counts for what it tells. The strength is that of two documents at least, also where
    the spread cannot be told, and that of the whole table at most.
    """
    n, failed = F.col("n").cast("double"), F.col("failed").cast("double")
    row = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(failed).alias("failed"), F.sum(n * n).alias("nn"), F.sum(failed * failed / n).alias("ff")).first()
    if not row["n"]:
        return 1.0, 1.0
    m = row["failed"] / row["n"]
    chance, room = row["k"] - 1, row["n"] - row["nn"] / row["n"] - (row["k"] - 1)
    size = 2.0
    if 0 < m < 1 and room > 1e-9:
        between = ((row["ff"] - row["failed"] * m) / (m * (1 - m)) - chance) / room
        size = 1 / min(max(between, 1 / row["n"]), 1 / 3) - 1
    return m * size, (1 - m) * size


def beta_prior(hosts: DataFrame, least: int = PRIOR_LEAST) -> tuple[float, float]:
    """(alpha, beta) by the method of moments over hosts of at least ``least`` documents: two numbers for the driver.

    With under two such hosts, or rates that hardly vary, the prior is the mean rate (0.5 without such a host)
    with the strength of two documents.
    """
    rate = F.col("failed") / F.col("n")
    row = hosts.where(F.col("n") >= least).agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v")).first()
    m, v = 0.5 if row["m"] is None else row["m"], row["v"] or 0.0
    size = m * (1 - m) / v - 1 if 1e-12 < v < m * (1 - m) else 2.0
    return m * size, (1 - m) * size


def judge(docs: DataFrame, text_col: str = "text", host_col: str = "source", id_col: str = "doc_id", strict_rate: float = STRICT_RATE, prior: Callable[[DataFrame], tuple[float, float]] = fitted_prior) -> DataFrame:
    """docs without text_col, plus the measures, base_failed, host_rate, host_strict and kept.

    A null text has no words and fails the base rule. Null hosts form one host. Rows may repeat. A column
    of docs that has a result's name is replaced by the result. An empty table gives no rows.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "soft_failed", "host_rate", "host_strict", "kept"]
    docs = frugal(docs)
    rest = [c for c in docs.columns if c != text_col and c.lower() not in made]
    m = fresh(docs.columns, "_m")
    doc = docs.withColumn(m, measures(F.col(text_col))).select(*rest, f"{m}.*")
    doc = doc.withColumn("base_failed", F.expr(BASE_RULE)).withColumn("soft_failed", F.expr(" or ".join(f"({r})" for r in SOFT_RULES.values())))
    return with_host_verdict(doc, host_col, id_col, strict_rate, prior)


def shrunk(alpha: float, beta: float) -> Column:
    return (F.col("failed") + alpha) / (F.col("n") + alpha + beta)


def with_host_verdict(doc: DataFrame, host_col: str, id_col: str, strict_rate: float, prior: Callable[[DataFrame], tuple[float, float]]) -> DataFrame:
    doc = cut(doc)
    h, salt = fresh(doc.columns, "_host"), fresh(doc.columns, "_salt")
    failed = (F.col("base_failed") | F.col("soft_failed")).cast("bigint")
    rows, facts = group_facts(doc.withColumn(h, F.coalesce(F.col(host_col).cast("string"), F.lit(""))), [h], F.col(id_col), {"n": (F.sum, F.lit(1).cast("bigint")), "failed": (F.sum, failed)}, salt=salt)
    hosts = facts.groupBy(h).agg(F.max("n").alias("n"), F.max("failed").alias("failed"))
    alpha, beta = prior(hosts)
    rates = facts.select(h, salt, shrunk(alpha, beta).alias("host_rate"))
    out = rows.join(rates, [h, salt]).withColumn("host_strict", F.col("host_rate") > strict_rate)
    return out.withColumn("kept", ~(F.col("base_failed") | (F.col("host_strict") & F.col("soft_failed")))).drop(h, salt)


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source", id_col: str = "doc_id", strict_rate: float = STRICT_RATE) -> DataFrame:
    """The rows of docs that judge() keeps, all columns as they are.

    Null and empty texts fail the base rule and go. Null hosts form one host. Rows may repeat and are judged
    alike; an empty table gives no rows. The texts are measured twice, for the hosts' sums and for the rows that
    stay, so that no text is shuffled or written; the hosts' verdicts come back by a join.
    """
    docs = frugal(docs)
    names = docs.columns
    m, h, is_strict, is_soft = (fresh(names, x) for x in ("_m", "_host", "_strict", "_soft"))
    base, soft = F.expr(BASE_RULE), F.expr(" or ".join(f"({r})" for r in SOFT_RULES.values()))
    verdict = docs.select(F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias(h), measures(F.col(text_col)).alias(m)).select(h, f"{m}.*").select(h, base.alias("b"), soft.alias("s"))
    hosts = cut(verdict.groupBy(h).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("b") | F.col("s")).cast("bigint")).alias("failed")))
    alpha, beta = fitted_prior(hosts)
    strict = hosts.where(shrunk(alpha, beta) > strict_rate).select(h, F.lit(True).alias(is_strict))
    few = strict.count() <= 1_000_000
    doc = docs.withColumn(m, measures(F.col(text_col))).withColumn(h, F.coalesce(F.col(host_col).cast("string"), F.lit("")))
    doc = doc.withColumn(is_soft, F.expr(" or ".join(f"({_on(r, m)})" for r in SOFT_RULES.values()))).where(~F.expr(_on(BASE_RULE, m)))
    doc = doc.join(F.broadcast(strict) if few else strict, h, "left")
    return doc.where(~(F.col(is_soft) & F.coalesce(is_strict, F.lit(False)))).select(*names)


def _on(rule: str, struct: str) -> str:
    for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        rule = rule.replace(k, f"`{struct}`.{k}")
    return rule
