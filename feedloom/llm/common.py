"""Helpers shared by the training-data operators.

Words are maximal runs of characters outside ASCII white space, which is what
``bytes.split()`` yields for UTF-8 text. Every helper treats a null text as empty.
"""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

#: Code points that separate words.
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: Characters of text handled at once by the vectorised operators; bounds a worker's memory.
CHUNK_CHARS = 3_000_000
#: Rows of an Arrow batch of texts.
ARROW_ROWS = 1_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a folder already set
    by setCheckpointDir() serves, or, in one process only, a temporary folder set here; a cluster must name one."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None)
    held = sc._jsc.sc().getCheckpointDir()
    if at is None and held.isDefined():
        return held.get().rstrip("/")
    if at is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = os.path.join(tempfile.gettempdir(), "feedloom-shared")
    if held.isEmpty():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which outlives any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def frugal(df: DataFrame) -> DataFrame:
    """df, after bounding the rows that a Python worker gets at once: texts are long, and the default of 10,000
    rows would hold several copies of tens of MB in each worker. A lower setting of the session stays."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= ARROW_ROWS:
        conf.set(key, ARROW_ROWS)
    return df


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Holds settings of the session for the jobs in here and puts the old ones back."""
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: Shuffle files of a job go at its end, not when the driver happens to collect garbage. For steps whose results are
#: written or checkpointed: they can be read again whatever executor is lost.
SHORT_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, clear: Callable[[], None]) -> None:
    """Says that an operator keeps something in this worker from task to task, and how to drop it."""
    _HELD[owner] = clear


def begin(owner: str) -> None:
    """A task of this operator begins: what others keep in the worker goes."""
    for other in [k for k in _HELD if k != owner]:
        _HELD.pop(other)()
        give_back()


def give_back() -> None:
    """Returns the memory that a Python worker has freed: workers live on for later tasks of other operators."""
    try:
        import pyarrow

        pyarrow.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, ImportError, OSError):  # another allocator
        pass


class Scratch:
    """Parquet tables in the shared folder, for one run of an operator."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/feedloom-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(path := f"{self.root}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, n: int | None = None) -> None:
        """Deletes table n (from 1), or all."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root if n is None else f"{self.root}/{n}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(names: Iterable[str], stem: str) -> str:
    """A column name that does not clash with names, whatever their case."""
    taken = {n.lower() for n in names}
    return next(n for i in range(len(taken) + 1) if (n := f"{stem}{i or ''}").lower() not in taken)


def group_facts(df: DataFrame, keys: list[str], spread: Column, aggs: dict[str, tuple[Callable, Column]], salts: int = 64, salt: str = "_salt") -> tuple[DataFrame, DataFrame]:
    """(salted rows, facts per (key, salt)): join the two on keys + salt to give rows their group's facts.

    A hot key is dealt out to ``salts`` tasks by ``spread`` on both sides: the facts are first reduced per
    (key, salt), then per key, and repeated only for the salts that occur. ``aggs`` maps a name to
    (aggregate function, column); the function must be able to combine its own results (min, max, sum).
    """
    salted = df.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    part = salted.groupBy(*keys, salt).agg(*(f(c).alias(n) for n, (f, c) in aggs.items()))
    whole = part.groupBy(*keys).agg(*(f(F.col(n)).alias(n) for n, (f, _) in aggs.items()), F.collect_list(salt).alias("_salts"))
    return salted, whole.withColumn(salt, F.explode("_salts")).drop("_salts")


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split() if text else []


def chunks(texts: list, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of texts that hold about limit characters; a longer text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


class WordTable(dict):
    """Numbers words as they come and keeps a 64-bit hash of each; forgets all when full."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most
        self.known, self.size, self.pending = np.zeros(1024, np.uint64), 0, []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.pending.append(xxh3_64_intdigest(word))
        return n

    @property
    def hashes(self) -> np.ndarray:
        """The hashes of all numbered words in order."""
        if self.pending:
            end = self.size + len(self.pending)
            if end > len(self.known):
                self.known = np.concatenate([self.known[: self.size], np.zeros(end, np.uint64)])
            self.known[self.size : end] = np.array(self.pending, np.uint64)
            self.size, self.pending = end, []
        return self.known[: self.size]

    def room(self) -> None:
        """Call between chunks: numbers stay valid within a chunk."""
        if len(self) > self.most:
            self.clear()
            self.known, self.size, self.pending = np.zeros(1024, np.uint64), 0, []

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of all texts in a row, start of each text and the end of the last)."""
        ids, starts = [], np.zeros(len(texts) + 1, np.int64)
        for i, t in enumerate(texts):
            w = words(t)
            ids.append(np.fromiter(map(self.__getitem__, w), np.int64, len(w)))
            starts[i + 1] = starts[i] + len(w)
        return (np.concatenate(ids) if ids else np.zeros(0, np.int64)), starts

    def hash_of(self, ids: np.ndarray) -> np.ndarray:
        return self.hashes[ids]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(base**i, base**-i) for i below n, modulo 2**64; the base is odd and so has an inverse."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            for name, b in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
                _POWERS[name] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]), dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Rolling:
    """Polynomial hashes of any spans of a sequence of 64-bit word hashes."""

    def __init__(self, h: np.ndarray):
        up, self.down = powers(len(h) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)], dtype=np.uint64)])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def is_integer(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
