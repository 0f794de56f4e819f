"""Exact nearest vectors for a stated query set, in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors that are broadcast at once.
BLOCK = 4096
#: Pairs of a query and a vector that a task scores at once, some 40 bytes each.
CELLS = 1_000_000


def dense_top_k(queries: DataFrame, vectors: DataFrame, k: int, query_id: str = "query_id", id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, id, score, rank) of the k vectors with the largest cosine to each query, ties by id; itself left out.

    Queries go out in blocks of a fixed size. A task keeps the k best of each query over all it reads and scores CELLS
    pairs at once, so its memory is bounded, and what is shuffled and merged grows with tasks and not with vectors.
    """
    spark = vectors.sparkSession
    n = queries.count()
    out = None
    for b in range(max(1, -(-n // BLOCK))):
        part = queries.where(F.pmod(F.xxhash64(query_id), F.lit(max(1, -(-n // BLOCK)))) == b).select(query_id, vector).collect()
        ids = np.array([r[0] for r in part], np.int64)
        block = spark.sparkContext.broadcast((ids, _unit(np.array([r[1] for r in part], np.float64).reshape(len(part), -1))))

        def run(batches: Iterator[pd.DataFrame], block=block, cells=CELLS) -> Iterator[pd.DataFrame]:
            qid, q = block.value
            if not len(qid):
                return
            ids, top = np.zeros((len(qid), 0), np.int64), np.zeros((len(qid), 0))
            step = max(1, cells // len(qid))
            for pdf in batches:
                ok = pdf[pdf[vector].notna()]
                for at in range(0, len(ok), step):
                    some = ok.iloc[at : at + step]
                    own = some[id_col].to_numpy()
                    s = np.round(q @ _unit(np.vstack(some[vector].to_numpy()).astype(np.float64)).T, 6)
                    s[qid[:, None] == own[None, :]] = -np.inf
                    ids, top = best(np.hstack([ids, np.broadcast_to(own, s.shape)]), np.hstack([top, s]), k)
            yield pd.DataFrame({query_id: np.repeat(qid, ids.shape[1]), id_col: ids.ravel(), "score": top.ravel()})

        some = vectors.select(id_col, vector).mapInPandas(run, f"{query_id} bigint, {id_col} bigint, score double")
        out = some if out is None else out.unionByName(some)
    w = Window.partitionBy(query_id).orderBy(F.desc("score"), id_col)
    return out.where("score > double('-infinity')").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k greatest scores of each row and their ids, ties by id."""
    at = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(ids, at, 1), np.take_along_axis(scores, at, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) if x.size else x
