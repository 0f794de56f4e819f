"""Substring dedup with a log-structured fingerprint index.

Every window of WINDOW words has an anchor: the least hash among its runs of GRAM words. Consecutive windows
with the same anchor form a segment, so equal windows have equal anchors and equal text lies in equal
segments except where a match begins or ends. The index is a folder of immutable runs, sorted and bucketed
tables of the distinct segments first seen in one batch. A new batch is merge-joined with each run:

1. a segment that occurs earlier, in a run or in the batch, is removed whole;
2. where one anchor has several different segments, their windows are compared one by one, from the texts.

Then the batch's new segments are a further run, and runs are compacted when there are too many. Batches
must come in the order of ids. A match is an equal 64-bit anchor hash, made of word hashes, verified by an equal
64-bit hash of the segment's or window's own bytes, so two chance collisions would have to meet.

First places are found by minima, which combine. A passage that very many texts share is combined in each task
before it is shuffled, and the join that tells its other places can be split by Spark.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import SHORT_SHUFFLES, Rolling, Scratch, WordTable, chunks, fresh, frugal, give_back, mix64, settings, shared_dir, signed, words

WINDOW, GRAM = 20, 8
#: Runs that the index may hold when a batch comes; more are merged first.
MAX_RUNS = 4
#: Repeated segments that a task keeps in mind to combine later copies of them.
_HOT = 200_000
_SEGMENT = "ah bigint, sh bigint, id bigint, at bigint, n int, again boolean"
_RUN = "ah bigint, sh bigint, id bigint, at bigint, n int, c bigint, known boolean"


def anchors(h: np.ndarray, starts: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, number of windows, anchor place) of each segment of a row of texts."""
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    n = len(h)
    if n < window:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    span = window - gram + 1
    at = np.arange(n - gram + 1)
    value = Rolling(h).span(at, at + gram)
    place, width = at, 1
    while width < span:  # least hash over growing widths, the leftmost of equals
        step = min(width, span - width)
        a, b = place[: len(place) - step], place[step:]
        place = np.where(value[b] < value[a], b, a)
        width += step
    first = np.arange(n - window + 1)
    first = first[doc[: n - window + 1] == doc[window - 1 :]]
    if not len(first):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    p, d = place[first], doc[first]
    new = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1]) | (d[1:] != d[:-1])]))
    return d[new], first[new], np.diff(np.append(new, len(first))), p[new]


class Bytes:
    """Hashes of the bytes of spans of words, the words joined by a space."""

    def __init__(self, texts: list):
        each = [words(t) for t in texts]
        self.words = [w for ws in each for w in ws]
        self.starts = np.concatenate([[0], np.cumsum([len(ws) for ws in each], dtype=np.int64)]).astype(np.int64)
        self.raw = b" ".join(self.words)
        self.at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)) + 1)])

    def numbers(self, table: WordTable) -> np.ndarray:
        return np.fromiter(map(table.__getitem__, self.words), np.int64, len(self.words))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = self.raw
        return np.fromiter((xxh3_64_intdigest(raw[a:b]) for a, b in zip(self.at[start].tolist(), (self.at[end] - 1).tolist(), strict=True)), np.uint64, len(start))


class Hot:
    """The earliest places of segments that came twice in a chunk, for the chunks that follow in the task."""

    def __init__(self):
        self.sh, self.id, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def later(self, sh: np.ndarray, own: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which segments have an earlier equal that the task has told."""
        if not len(self.sh):
            return np.zeros(len(sh), bool)
        i = np.minimum(np.searchsorted(self.sh, sh), len(self.sh) - 1)
        return (self.sh[i] == sh) & ((own > self.id[i]) | ((own == self.id[i]) & (at > self.at[i])))

    def add(self, sh: np.ndarray, own: np.ndarray, at: np.ndarray) -> None:
        """Keeps these and as many of the others as fit, each with its earliest place."""
        if not len(sh):
            return
        if len(self.sh) + len(sh) > _HOT:
            self.__init__()
        sh, own, at = np.concatenate([self.sh, sh]), np.concatenate([self.id, own]), np.concatenate([self.at, at])
        order = np.lexsort((at, own, sh))
        order = order[np.concatenate([[True], sh[order][1:] != sh[order][:-1]])]
        self.sh, self.id, self.at = sh[order], own[order], at[order]


def segments(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """(ah, sh, id, at, n, again) per segment: anchor and segment hashes, start and number of windows.

    A segment that the same task has told before, at an earlier place, is marked: it has an earlier equal
    already, so only its place is of use. This combines a hot passage before it is shuffled. Of equal segments
    of one id and place, from rows that repeat, one is told.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, hot = WordTable(), Hot()
        try:
            for pdf in batches:
                pdf = pdf.sort_values("id")
                ids, texts = pdf["id"].to_numpy(), pdf["text"].tolist()
                for a, b in chunks(texts):
                    table.room()
                    raw = Bytes(texts[a:b])
                    h, starts = table.hash_of(raw.numbers(table)), raw.starts
                    d, s, n, p = anchors(h, starts, window, gram)
                    if not len(d):
                        continue
                    with np.errstate(over="ignore"):
                        sh = mix64(raw.hash(s, s + n + window - 1) + (p - s).astype(np.uint64))
                    ah, at, own = Rolling(h).span(p, p + gram), s - starts[d], ids[a:b][d]
                    if len(np.unique(ids[a:b])) < b - a:  # rows of one id are taken by place, so that the first is the earliest
                        order = np.lexsort((at, own))
                        ah, sh, at, own, n = ah[order], sh[order], at[order], own[order], n[order]
                    first, which, count = np.unique(sh, return_index=True, return_inverse=True, return_counts=True)[1:]
                    at_first = first[which]
                    same = (own == own[at_first]) & (at == at[at_first])
                    again = ~same | hot.later(sh, own, at)
                    told = ~same | (at_first == np.arange(len(at_first)))
                    hot.add(*(x[first[count > 1]] for x in (sh, own, at)))
                    yield pd.DataFrame({"ah": signed(ah), "sh": signed(sh), "id": own, "at": at, "n": n.astype(np.int32), "again": again})[told]
        finally:
            table.clear()
            give_back()

    src = frugal(docs).select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id is not null")
    return src.mapInPandas(run, _SEGMENT)


def windows_of(picked: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """(ah, wh, id, at): the windows of the picked segments (ah, id, at, n), hashed from the texts (id, text)."""
    per = picked.groupBy("id").agg(F.collect_list(F.struct("ah", "at", "n")).alias("segs"))
    joined = texts.join(per, "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, ids = pdf["text"].tolist(), pdf["id"].to_numpy()
            for a, b in chunks(texts):
                raw, segs = Bytes(texts[a:b]), pdf["segs"].iloc[a:b]
                size = segs.map(len).to_numpy()
                ah, at, n = (np.fromiter((x[k] for g in segs for x in g), np.int64, size.sum()) for k in ("ah", "at", "n"))
                doc = np.repeat(np.repeat(np.arange(b - a), size), n)
                s = np.repeat(at, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                from_ = s + raw.starts[doc]
                ok = from_ + window <= raw.starts[doc + 1]  # another text of the same id may be shorter
                from_, doc, s = from_[ok], doc[ok], s[ok]
                yield pd.DataFrame({"ah": np.repeat(ah, n)[ok], "wh": signed(raw.hash(from_, from_ + window)), "id": ids[a:b][doc], "at": s})
        give_back()

    return frugal(joined).select("id", "text", "segs").mapInPandas(run, "ah bigint, wh bigint, id bigint, at bigint")


class FingerprintIndex:
    """The runs of one index: bucketed, sorted Parquet tables in a folder that driver and executors share.

    A run holds a batch's distinct segments, each once with its first place and its count c in the batch;
    ``known`` marks those that an earlier run holds. All runs have the same buckets, by anchor, so that they are
    joined and counted per anchor without moving a row. A folder that holds an index is opened with its runs and
    settings; a run counts once its writer has marked it done. Without a folder the index is a temporary one.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, window: int = WINDOW, gram: int = GRAM, max_runs: int = MAX_RUNS, buckets: int | None = None):
        self.spark, self.root = spark, (root or f"{shared_dir(spark)}/feedloom-fp-{uuid.uuid4().hex}").rstrip("/")
        self.max_runs, self.key = max_runs, uuid.uuid4().hex
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.runs: list[str] = []
        self.high: int | None = None
        names = [x.getPath().getName() for x in self.fs.listStatus(path)] if self.fs.exists(path) else []
        if "meta" in names:
            held = json.loads(spark.read.text(f"{self.root}/meta").first()["value"])
            self.window, self.gram, self.buckets = held["window"], held["gram"], held["buckets"]
        else:
            self.window, self.gram, self.buckets = window, gram, buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(json.dumps({"window": self.window, "gram": self.gram, "buckets": self.buckets}),)], "value string").coalesce(1).write.text(f"{self.root}/meta")
        found = sorted(m.groups() for n in names if (m := re.fullmatch(r"run-(\d+)_(-?\d+)", n)))
        self.made = max((int(n) for n, _ in found), default=0)
        for n, high in found:
            if self.fs.exists(self._path(f"{self.root}/run-{n}_{high}/_SUCCESS")):
                self._open(f"run-{n}_{high}", int(high))

    def _path(self, at: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(at)

    def _name(self, table: str) -> str:
        return "feedloom_" + re.sub(r"\W", "_", f"{self.key}_{table}")

    def _open(self, run: str, high: int) -> None:
        self.spark.sql(f"create table if not exists {self._name(run)} ({_RUN}) using parquet clustered by (ah) sorted by (ah, sh) into {self.buckets} buckets location '{self.root}/{run}'")
        self.runs.append(run)
        self.high = high if self.high is None else max(self.high, high)

    def _bucketed(self, df: DataFrame, table: str) -> DataFrame:
        """Writes df, which is dealt out by ah into as many partitions as there are buckets, as a table in the folder."""
        order = [c for c in ("ah", "sh") if c in df.columns]
        df.write.bucketBy(self.buckets, "ah").sortBy(*order).option("path", f"{self.root}/{table}").saveAsTable(self._name(table))
        return self.spark.table(self._name(table))

    def _drop(self, table: str) -> None:
        self.spark.sql(f"drop table if exists {self._name(table)}")
        self.fs.delete(self._path(f"{self.root}/{table}"), True)

    def append(self, segs: DataFrame, high: int) -> DataFrame:
        self.made += 1
        run = f"run-{self.made:06d}_{high}"
        table = self._bucketed(segs, run)
        self.runs.append(run)
        self.high = high if self.high is None else max(self.high, high)
        return table

    def history(self) -> list[DataFrame]:
        """The new segments of each run."""
        return [self.spark.table(self._name(r)).where("not known") for r in self.runs]

    def compact(self) -> None:
        """Merges all runs into one. No segment is new in two runs, so nothing else changes; old runs go last."""
        old, tables = self.runs, self.history()
        if len(old) < 2:
            return
        merged = tables[0]
        for t in tables[1:]:
            merged = merged.unionByName(t)
        self.runs = []
        self.append(merged.repartition(self.buckets, "ah"), self.high)
        for r in old:
            self._drop(r)

    def close(self) -> None:
        """Forgets the tables' names; the folder stays and can be opened again."""
        for r in self.runs:
            self.spark.sql(f"drop table if exists {self._name(r)}")

    def drop(self) -> None:
        """Deletes the index."""
        self.close()
        self.fs.delete(self._path(self.root), True)

    def add(self, batch: DataFrame, texts: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """(id, start, end): the spans of words of the batch that occur earlier. The batch becomes part of the index.

        batch: documents with ids above those of the index. texts: (id, text) of the batch and of all earlier
        documents; of these only such texts are read as share an anchor with a different segment.
        """
        with settings(self.spark, SHORT_SHUFFLES):
            return self._add(batch, texts, scratch, id_col, text_col)

    def _add(self, batch: DataFrame, texts: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
        if len(self.runs) > self.max_runs:
            self.compact()
        after, old_runs, own = self.high, self.history(), Scratch(self.spark)
        segs = own.keep(segments(batch, id_col, text_col, self.window, self.gram))
        bounds = segs.agg(F.min("id").alias("low"), F.max("id").alias("high")).first()
        if bounds["high"] is None:
            return scratch.keep(self.spark.createDataFrame([], "id bigint, start bigint, end bigint"))
        if after is not None and bounds["low"] <= after:
            raise ValueError(f"the index holds ids up to {after}; a batch must have higher ones")
        # tables that share their buckets are joined as they lie, also on anchor and segment together
        with settings(self.spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
            new = segs.where("not again").repartition(self.buckets, "ah").groupBy("ah", "sh").agg(F.min(F.struct("id", "at", "n")).alias("f"), F.count(F.lit(1)).alias("c")).select("ah", "sh", "f.*", "c", F.lit(False).alias("known"))
            for run in old_runs:
                held = run.select("ah", "sh", F.lit(True).alias("held")).hint("merge")
                new = new.join(held, ["ah", "sh"], "left").withColumn("known", F.col("known") | F.coalesce("held", F.lit(False))).drop("held")
            run = self.append(new, bounds["high"])
            # anchors with several different segments, one of them new: their windows are compared
            counts = run.where("not known").groupBy("ah").agg(F.count(F.lit(1)).alias("k"))
            for r in old_runs:
                counts = counts.join(r.groupBy("ah").agg(F.count(F.lit(1)).alias("m")).hint("merge"), "ah", "left").select("ah", (F.col("k") + F.coalesce("m", F.lit(0))).alias("k"))
            many = self._bucketed(counts.where("k > 1").select("ah"), f"many-{self.made}")
            picked = None
            for r in [run.where("not known"), *old_runs]:
                some = r.join(many.hint("merge"), "ah", "left_semi").select("ah", "id", "at", "n")
                picked = some if picked is None else picked.unionByName(some)
            picked = own.keep(picked)
            self._drop(f"many-{self.made}")
            dups = own.keep(run.where("c > 1 or known").select("ah", "sh", F.when(~F.col("known"), F.struct("id", "at")).alias("f")))
        place = F.struct("id", "at")
        told = segs.where("not again").join(dups, ["ah", "sh"]).where(F.col("f").isNull() | (place != F.col("f"))).select("id", "at", "n")
        told = told.unionByName(segs.where("again").select("id", "at", "n"))
        wins = own.keep(windows_of(picked, texts, self.window))
        firsts = wins.groupBy("ah", "wh").agg(F.min(place).alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
        late = wins if after is None else wins.where(F.col("id") > after)  # spans of earlier batches have been told
        late = late.join(firsts, ["ah", "wh"]).where(place != F.col("f")).select("id", "at", F.lit(1).alias("n"))
        spans = scratch.keep(told.unionByName(late).select("id", F.col("at").alias("start"), (F.col("at") + F.col("n") + self.window - 1).alias("end")))
        own.drop()
        return spans


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("id is not null")


def repeated_spans(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", batches: int = 3, root: str | None = None, earlier: DataFrame | None = None, **index) -> DataFrame:
    """(id, start, end) of all documents, taken through an index batch by batch in the order of ids."""
    spark = docs.sparkSession
    texts = _plain(docs, id_col, text_col)
    shares = [i / batches for i in range(1, batches)]
    cuts = texts.agg(F.percentile_approx("id", F.array(*map(F.lit, shares)), F.lit(10_000)).alias("c")).first()["c"] if shares else []
    idx = FingerprintIndex(spark, root, **index)
    out, low = None, None
    try:
        for high in [*sorted(set(cuts or [])), None]:
            own = F.lit(True) if low is None else F.col(id_col) > low
            own = own if high is None else own & (F.col(id_col) <= high)
            seen = texts if high is None else texts.where(F.col("id") <= high)
            if earlier is not None:
                seen = seen.unionByName(_plain(earlier, id_col, text_col))
            spans = idx.add(docs.where(own), seen, scratch, id_col, text_col)
            out, low = spans if out is None else out.unionByName(spans), high
    finally:
        idx.drop() if root is None else idx.close()
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 3, scratch: Scratch | None = None, **index) -> DataFrame:
    """docs without text_col, plus n_words, n_removed and kept (the words left, joined by a space).

    A word goes if a window of 20 words that covers it starts earlier too, in a smaller id or earlier in
    the same text; windows are judged on the input. Null and empty texts, and texts of fewer words, lose
    nothing. Ids should be unique; rows that repeat an id count as copies of one place, so nothing is removed
    from one for the other. A row without an id keeps all its words. An empty table gives no rows. A column
    of docs that has a result's name is replaced.

    With ``root``, a shared folder, the index stays there: a later call with the same root takes only the new
    documents, whose ids must be higher, as docs and those of all earlier calls as ``earlier``.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    spans = repeated_spans(docs, scratch, id_col, text_col, batches, **index)
    i, sp, m = (fresh(docs.columns, x) for x in ("_id", "_spans", "_cut"))
    # a document's array is no longer than its text; rows without an id join nothing and are not shuffled
    per = spans.groupBy(F.col("id").alias(i)).agg(F.collect_set(F.struct(F.col("start").alias("a"), F.col("end").alias("b"))).alias(sp))
    joined = docs.where(F.col(id_col).isNotNull()).join(per, F.col(id_col).cast("bigint") == F.col(i), "left").drop(i)
    joined = joined.unionByName(docs.where(F.col(id_col).isNull()).withColumn(sp, F.lit(None).cast("array<struct<a:bigint,b:bigint>>")))

    @F.pandas_udf("n_words bigint, n_removed bigint, kept string")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, spans in batches:
            rows = []
            for t, cuts in zip(text, spans, strict=True):
                ws = words(t if isinstance(t, str) else None)
                left, last = [], 0
                for a, b in sorted((c["a"], c["b"]) for c in (cuts if cuts is not None else ())):
                    left += ws[last:a]
                    last = max(last, b)
                left += ws[last:]
                rows.append((len(ws), len(ws) - len(left), b" ".join(left).decode("utf-8", "replace")))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])
        give_back()

    rest = [c for c in docs.columns if c != text_col and c.lower() not in ("n_words", "n_removed", "kept")]
    return frugal(joined).withColumn(m, apply.asNondeterministic()(F.col(text_col), F.col(sp))).select(*rest, f"{m}.*")
