"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate that brings its expected share of the output to its target
weight. A document's count is the Poisson quantile of a uniform number hashed from its id and the seed, so
it depends on nothing else. Documents are exploded by their counts and shuffled globally by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, group_facts

#: A total of more than this many times the rows of the table is refused as a mistake. One source may have any rate.
MAX_RATE = 10_000.0
#: Numbers of the distributions that a worker keeps.
_KEPT = 1 << 20
#: Copies of a row that one array numbers.
_BLOCK = 4096


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of the parts; a null part counts as a bare mark."""
    key = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("~")) for p in parts))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def poisson_window(rate: float) -> tuple[int, np.ndarray]:
    """(k, P(X <= k), P(X <= k + 1), ...) as far as the tails are above 1e-30; the terms are walked from the mode."""
    wide = 12 * np.sqrt(rate) + 30
    low, mode, high = max(0, int(rate - wide)), int(rate), int(rate + wide)
    up = np.cumprod(rate / np.arange(mode + 1, high + 1))
    down = np.cumprod(np.arange(mode, low, -1) / rate)
    sums = np.cumsum(np.concatenate([down[::-1], [1.0], up]))
    return low, sums / sums[-1]


def poisson_quantile(rate: np.ndarray, u: np.ndarray, kept: dict) -> np.ndarray:
    """The number of k with P(X <= k) <= u, for each pair; 0 at rate 0. kept holds distributions between calls."""
    out = np.zeros(len(u), np.int64)
    values, which = np.unique(rate, return_inverse=True)
    order = np.argsort(which, kind="stable")
    for value, rows in zip(values.tolist(), np.split(order, np.cumsum(np.bincount(which, minlength=len(values)))[:-1]), strict=True):
        if not value > 0:
            continue
        if value not in kept:
            if sum(len(c) for _, c in kept.values()) > _KEPT or len(kept) > 10_000:
                kept.clear()
            kept[value] = poisson_window(value)
        low, cdf = kept[value]
        out[rows] = low + np.searchsorted(cdf, u[rows], side="right")
    return out


def repetitions(rate: Column, u: Column) -> Column:
    """Poisson quantiles as a column. Marked non-deterministic so that the optimizer does not evaluate it twice."""

    @F.pandas_udf("bigint")
    def drawn(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        kept: dict = {}
        for r, x in batches:
            yield pd.Series(poisson_quantile(r.to_numpy(np.float64), x.to_numpy(np.float64), kept))

    return drawn.asNondeterministic()(rate, u)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, source_col: str = "source", id_col: str = "doc_id") -> tuple[DataFrame, DataFrame, list[str]]:
    """(salted rows, facts (source, salt, _rate), names of source key and salt).

    Without weights all sources weigh the same; with them, sources not named weigh 0. Weights are taken
    relative to the sources that occur. total is the expected number of rows, by default that of docs.
    """
    s, salt = fresh(docs.columns, "_src"), fresh(docs.columns, "_salt")
    keyed = docs.withColumn(s, F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    rows, facts = group_facts(keyed, [s], F.col(id_col), {"_n": (F.sum, F.lit(1).cast("bigint"))}, salt=salt)
    facts = cut(facts)
    per = facts.groupBy(s).agg(F.max("_n").alias("n"))
    w = F.lit(1.0) if weights is None else F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in weights.items() for x in kv)) if weights else F.create_map().cast("map<string,double>"), F.col(s)).cast("double"), F.lit(0.0))
    sums = per.agg(F.sum("n").alias("rows"), F.sum(w).alias("w")).first()
    all_rows, all_w = sums["rows"] or 0, sums["w"] or 0.0
    aim = float(all_rows if total is None else total)
    if all_rows and aim > MAX_RATE * all_rows:
        raise ValueError(f"the table would have to be repeated more than {MAX_RATE:g} times")
    rate = (w * aim / F.lit(all_w or 1.0)) / F.col("_n")
    return rows, facts.withColumn("_rate", rate).drop("_n"), [s, salt]


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, seed: int = 0, source_col: str = "source", id_col: str = "doc_id", facts: bool = False) -> DataFrame:
    """docs with each row repeated by its Poisson count, in a global random order; all columns as they are.

    With facts=True also repetitions, replica (from 0), mean_rate and shuffle_key. A null source is one
    source. Rows that repeat an id get the same count. Null and empty texts are rows like others; an
    empty table gives no rows. The order is by the hash's partition and then by shuffle_key.
    """
    names = docs.columns
    rows, table, keys = rates(docs, weights, total, source_col, id_col)
    few = table.count() <= 1_000_000
    rate, reps, block, rep, key = (fresh(names, x) for x in ("_rate", "_reps", "_block", "_rep", "_key"))
    table = table.withColumnRenamed("_rate", rate)
    drawn = rows.join(F.broadcast(table) if few else table, keys)
    drawn = drawn.withColumn(reps, repetitions(F.col(rate), uniform(F.lit(seed), F.col(id_col)))).where(F.col(reps) > 0)
    # copies are numbered block by block, so that no array grows with the rate
    out = drawn.withColumn(block, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(reps) - 1, F.lit(_BLOCK).cast("bigint"))))
    out = out.withColumn(rep, F.explode(F.sequence(F.col(block), F.least(F.col(block) + _BLOCK, F.col(reps)) - 1)))
    out = out.withColumn(key, F.substring(F.md5(F.concat_ws(":", F.lit(f"order {seed}"), F.coalesce(F.col(id_col).cast("string"), F.lit("~")), F.col(rep).cast("string"))), 1, 16))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mixed = out.repartition(n, key).sortWithinPartitions(key)
    if not facts:
        return mixed.select(*names)
    made = dict(repetitions=reps, replica=rep, mean_rate=rate, shuffle_key=key)
    return mixed.select(*(c for c in names if c.lower() not in made), *(F.col(v).alias(k) for k, v in made.items()))
