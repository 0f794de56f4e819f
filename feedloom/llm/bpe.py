"""Byte-level BPE with a minimal acyclic transducer as lexicon.

Pass 1 counts all pre-tokens of the corpus. The most frequent ones and their ids are compiled into a
minimal acyclic transducer: an automaton over bytes in which equal suffixes share states and whose
outputs, summed along a path, give the word's number and so its ids. The compiled table is a file of a fixed
bound that Spark ships to each executor; all workers of a node map the one file read-only and so share its
pages. Words that it lacks are merged exactly. The result does not depend on the lexicon.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import struct
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SHORT_SHUFFLES, chunks, cut, fresh, frugal, give_back, hold, settings, shared_dir

#: Words in the lexicon and the longest of them in bytes: together they bound the file (under 8 MB).
LEXICON_SIZE, LEXICON_WORD = 50_000, 40

_NEVER = 1 << 62
_BYTES = [bytes([b]) for b in range(256)]

#: A blank next to white space of plain texts.
_DOUBLE = ["  ", *(x for w in "\t\n\x0b\x0c\r" for x in (" " + w, w + " "))]

_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same on texts of the characters in _PLAIN, where the faster module's classes agree with the above.
_SPLIT_PLAIN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
_PLAIN = r"[\t\n\x0b\x0c\r -~¡-©«-¬®-±´¶-¸»¿-ɏ‐-‧€]*"


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte: itself if printable in Latin-1, else the next letter from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Vocabulary:
    """A byte-level BPE vocabulary read from a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        raw = lambda s: bytes(letters[c] for c in s)
        ids = {raw(k): v for k, v in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: from a pair of ids to its rank and the id of the joined piece, packed
        self.joined = {ids[x] << 20 | ids[y]: r << 20 | ids[x + y] for r, (x, y) in enumerate((raw(a), raw(b)) for a, b in pairs)}
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        keys = np.fromiter(self.joined, np.int64, len(self.joined))
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], np.fromiter(self.joined.values(), np.int64, len(keys))[order]
        self.bytes = {v: k for k, v in ids.items()} | {v: k.encode() for k, v in self.special.items()}
        size = np.zeros(max(self.bytes) + 1, np.int32)
        size[list(self.bytes)] = [len(x) for x in self.bytes.values()]
        #: the bytes of all ids in a row, and where each begins
        self.flat, self.sizes = np.frombuffer(b"".join(self.bytes[i] for i in sorted(self.bytes)), np.uint8), size
        self.places = (np.cumsum(size) - size).astype(np.int32)

    def merge(self, word: bytes) -> list[int]:
        """Applies the merges by rank, then from the left."""
        return self._merge_short(word) if len(word) <= 48 else self._merge_long(word)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word: all words take their next merge together, the best pair of each, until few
        words have one left."""
        long = {i for i, w in enumerate(words) if not 0 < len(w) <= 48}
        some = [w for i, w in enumerate(words) if i not in long]
        part = np.array(self.byte_ids, np.int64)[np.frombuffer(b"".join(some), np.uint8)]
        size = np.fromiter(map(len, some), np.int64, len(some))
        word = np.repeat(np.arange(len(some)), size)

        def ranked(at: np.ndarray) -> np.ndarray:
            """Rank and joined id, packed, of the pairs that begin at these places."""
            out = np.full(len(at), _NEVER)
            inside = at + 1 < len(part)
            inside[inside] = word[at[inside]] == word[at[inside] + 1]
            a = at[inside]
            key = part[a] << 20 | part[a + 1]
            i = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
            out[inside] = np.where(self._keys[i] == key, self._ranks[i], _NEVER)
            return out

        rank = ranked(np.arange(len(part)))
        left: list[int] = []
        while len(part):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            live = np.flatnonzero(best < _NEVER)
            if len(live) <= len(some) // 20:
                left = live.tolist()
                break
            hit = np.flatnonzero((rank < _NEVER) & (rank == np.repeat(best, np.diff(starts, append=len(part)))))
            at = hit[np.diff(word[hit], prepend=-1) != 0]  # the leftmost of equals
            part[at] = rank[at] & 0xFFFFF
            stay = np.ones(len(part), bool)
            stay[at + 1] = False
            part, word, rank = part[stay], word[stay], rank[stay]
            at -= np.arange(len(at))
            near = np.concatenate([at, at[at > 0] - 1])
            rank[near] = ranked(near)
        ends = np.searchsorted(word, np.arange(1, len(some) + 1)).tolist()
        raw = part.astype("<u4").tobytes()
        out = [raw[4 * a : 4 * b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in left:
            out[i] = _packed(self._merge_short(some[i]))
        rest = iter(out)
        return [_packed(self.merge(w)) if i in long else next(rest) for i, w in enumerate(words)]

    def _merge_short(self, word: bytes) -> list[int]:
        """Scans for the least rank each time; only the two neighbours of a merge are looked up again."""
        get = self.joined.get
        part = list(map(self.byte_ids.__getitem__, word))
        found = [get(a << 20 | b, _NEVER) for a, b in zip(part, part[1:])]
        while found and (r := min(found)) != _NEVER:
            i = found.index(r)
            part[i] = x = r & 0xFFFFF
            del part[i + 1], found[i]
            if i < len(found):
                found[i] = get(x << 20 | part[i + 1], _NEVER)
            if i:
                found[i - 1] = get(part[i - 1] << 20 | x, _NEVER)
        return part

    def _merge_long(self, word: bytes) -> list[int]:
        """The same with a heap: n log n in the length of the word."""
        n, get = len(word), self.joined.get
        part = list(map(self.byte_ids.__getitem__, word))  # -1: joined to the piece on its left
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := get(part[i] << 20 | part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = right[i] if part[i] >= 0 else n
            if j >= n or part[i] != a or part[j] != b:
                continue
            part[i], part[j] = r & 0xFFFFF, -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := get(part[i] << 20 | part[k])) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[k]))
            if (h := left[i]) >= 0 and (r := get(part[h] << 20 | part[i])) is not None:
                heapq.heappush(heap, (r, h, part[h], part[i]))
        return [p for p in part if p >= 0]


class Transducer:
    """A minimal acyclic transducer from words to id sequences, in one flat buffer.

    Layout: counts, then the arcs in the order of state and byte (both packed in a key, the state they lead to, their
    output), the id sequences' offsets and ids, and a mark for each final state. The sum of outputs along an accepting
    path is the word's number. Many words are walked together, a byte of each at a time.
    """

    @staticmethod
    def compile(entries: dict[bytes, list[int]]) -> bytes:
        order = sorted(entries)
        register: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []  # (final, ((byte, target), ...)), children before parents
        spine: list[list] = [[False, []]]

        def freeze(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            return register[key]

        last = b""
        for w in order:
            same = 0
            while same < min(len(w), len(last)) and w[same] == last[same]:
                same += 1
            for depth in range(len(last), same, -1):
                n = freeze(spine.pop())
                spine[-1][1].append((last[depth - 1], n))
            spine += [[False, []] for _ in w[same:]]
            spine[-1][0] = True
            last = w
        for depth in range(len(last), 0, -1):
            n = freeze(spine.pop())
            spine[-1][1].append((last[depth - 1], n))
        root = freeze(spine[0])
        paths = []
        for final, arcs in states:
            paths.append(final + sum(paths[t] for _, t in arcs))
        keys, targets, outputs = [], [], []
        for state, (final, arcs) in enumerate(states):
            before = int(final)
            for b, t in arcs:
                keys.append(state << 8 | b)
                targets.append(t)
                outputs.append(before)
                before += paths[t]
        offsets = np.cumsum([0, *(len(entries[w]) for w in order)])
        ids = [i for w in order for i in entries[w]]
        body = [np.array(x, np.uint32).tobytes() for x in (keys, targets, outputs, offsets, ids)]
        return struct.pack("<6I", root, len(states), len(keys), len(order), len(ids), max(map(len, order), default=0)) + b"".join(body) + bytes(final for final, _ in states)

    def __init__(self, buffer):
        self.root, self.states, n_arcs, self.words, n_ids, self.longest = struct.unpack_from("<6I", buffer)
        at, views = 24, []
        for n in (n_arcs, n_arcs, n_arcs, self.words + 1, n_ids):
            views.append(np.frombuffer(buffer, "<u4", n, at))
            at += 4 * n
        self.keys, self.targets, self.outputs, self.offsets, self.ids = views
        self.final = np.frombuffer(buffer, np.uint8, self.states, at)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for those that the automaton does not accept."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        out = np.full(len(words), -1, np.int64)
        live = np.flatnonzero(size <= self.longest) if self.words else np.zeros(0, np.int64)
        state, number, depth = np.full(len(live), self.root, np.int64), np.zeros(len(live), np.int64), 0
        while len(live):
            end = size[live] == depth
            done = end & (self.final[state] == 1)
            out[live[done]] = number[done]
            live, state, number = live[~end], state[~end], number[~end]
            if not len(live) or not len(self.keys):
                break
            key = (state << 8 | data[start[live] + depth]).astype(np.uint32)
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[arc] == key
            arc, live = arc[on], live[on]
            state, number, depth = self.targets[arc].astype(np.int64), number[on] + self.outputs[arc], depth + 1
        return out

    def packed(self, words: list[bytes]) -> list[bytes | None]:
        """The packed ids of each word, None where it is not in the lexicon."""
        found = self.numbers(words)
        a, b = self.offsets[found], self.offsets[np.minimum(found + 1, self.words)]
        return [None if n < 0 else self.ids[i:j].tobytes() for n, i, j in zip(found.tolist(), a.tolist(), b.tolist(), strict=True)]

    def get(self, word: bytes) -> list[int] | None:
        n = int(self.numbers([word])[0])
        return None if n < 0 else self.ids[self.offsets[n] : self.offsets[n + 1]].tolist()


def ship(spark: SparkSession, lexicon: bytes) -> str:
    """Writes the lexicon to the shared folder and has Spark bring the file to every executor; its name there."""
    name = f"feedloom-{uuid.uuid4().hex}.lexicon"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(lexicon))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def mapped(path: str) -> mmap.mmap:
    """A read-only map of the file, whose pages all processes of a node share."""
    with open(path, "rb") as f:
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)


class Splitter:
    """Pre-tokens of a text; special strings stand alone and come as their ids."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        self.exact, self.fast, self.plain = regex.compile(_SPLIT), re.compile(_SPLIT_PLAIN), re.compile(_PLAIN)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def words(self, text: str) -> list[str]:
        return (self.fast if self.plain.fullmatch(text) else self.exact).findall(text)

    def blanks(self, text: str) -> list[str] | None:
        """The text cut at its blanks, if each stands alone inside it and so opens a word; else None."""
        if not self.plain.fullmatch(text) or text[:1] == " " or text[-1:] == " " or any(x in text for x in _DOUBLE):
            return None
        return text.split(" ")

    def pieces(self, text: str) -> list[str]:
        """Texts at even places, special strings at odd ones."""
        return self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]


class Codec(dict):
    """Encodes and decodes whole texts. As a dict it holds the packed ids of the words met last, ``most`` of them and
    as many of the time before, each of 64 bytes at most: about 80 MB. Frequent words pass from one to the other."""

    def __init__(self, path: str, lexicon: mmap.mmap | bytes | None = None, most: int = 200_000):
        super().__init__()
        self.vocabulary, self.most, self.before = vocabulary(path), most, {}
        self.lexicon = Transducer(lexicon) if lexicon else None
        self.split = Splitter(self.vocabulary.special)

    def __missing__(self, word: str) -> bytes:
        packed = self.before.get(word)
        if packed is None:
            raw = word.encode("utf-8", "replace")
            ids = self._listed(raw)
            packed = _packed(self.vocabulary.merge(raw) if ids is None else ids)
            if len(raw) > 64:
                return packed
        self._hold(word, packed)
        return packed

    def _listed(self, raw: bytes) -> list[int] | None:
        return self.lexicon.get(raw) if self.lexicon else None

    def _hold(self, word: str, packed: bytes) -> None:
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[word] = packed

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """encode() of each text; words that are not in memory walk the lexicon together, and those that it lacks are
        merged together."""
        out = []
        for a, b in chunks(texts, 1_000_000):
            parts = [[p if i % 2 else self.split.words(p) for i, p in enumerate(self.split.pieces(t or ""))] for t in texts[a:b]]
            new = set().union(*(p for ps in parts for p in ps[::2])).difference(self)
            own = {w: self.before[w] for w in new & self.before.keys()}
            rest = list(new.difference(own))
            raw = [w.encode("utf-8", "replace") for w in rest]
            if self.lexicon:
                found = self.lexicon.packed(raw)
                own.update((w, x) for w, x in zip(rest, found, strict=True) if x is not None)
                rest, raw = [w for w, x in zip(rest, found, strict=True) if x is None], [r for r, x in zip(raw, found, strict=True) if x is None]
            own.update(zip(rest, self.vocabulary.merge_all(raw), strict=True))
            if len(self) + len(own) > self.most:
                self.before = {w: x for w, x in self.items() if len(w) <= 64}
                # words of this chunk may be among those that go
                kept = {w: self[w] for w in set().union(*(p for ps in parts for p in ps[::2])).difference(own)}
                self.clear()
                self.update(kept)
            self.update(own)
            find = self.__getitem__
            for ps in parts:
                if len(ps) == 1:
                    out.append(b"".join(map(find, ps[0])))
                else:
                    out.append(b"".join([x for i, p in enumerate(ps) for x in ((_packed([self.vocabulary.special[p]]),) if i % 2 else map(find, p))]))
            for w in [w for w in own if len(w) > 64]:
                del self[w]
        return out

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        out = []
        for i, piece in enumerate(self.split.pieces(text or "")):
            if i % 2:
                out.append(struct.pack("<I", self.vocabulary.special[piece]))
            else:
                out += map(self.__getitem__, self.split.words(piece))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        return b"".join(map(self.vocabulary.bytes.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


    def decode_all(self, packed: list[bytes]) -> list[str]:
        """decode() of each, the bytes of all ids gathered together."""
        out, v = [], self.vocabulary
        for a, b in chunks(packed, 1_000_000):
            some = packed[a:b]
            ids = np.frombuffer(b"".join(some), "<u4")
            size = v.sizes[ids]
            ends = np.cumsum(size, dtype=np.int64)
            total = int(ends[-1]) if len(ends) else 0
            raw = v.flat[np.arange(total) + np.repeat(v.places[ids] - (ends - size), size)].tobytes()
            ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(x) // 4 for x in some])])].tolist()
            out += [raw[i:j].decode("utf-8", "replace") for i, j in zip(ends, ends[1:], strict=False)]
        return out


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def count_words(docs: DataFrame, path: str, text_col: str = "text", longest: int = LEXICON_WORD, most: int = 300_000, least: int = 1) -> DataFrame:
    """(word binary, n): counts of all pre-tokens up to ``longest`` bytes; a null text has none. A task holds about
    ``most`` words at once, besides those of one text, and then tells those met ``least`` times since it last did:
    with 1 the counts are exact, with 2 they are lossy counts, which miss what is met once, also
    within the same neighbours."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, seen, opened = Splitter(vocabulary(path).special), Counter(), Counter()

        def out():
            for piece, n in opened.items():  # one split for all places of a piece
                if n >= least:
                    for w in split.words(" " + piece):
                        seen[w] += n
            some = [(k, n) for w, n in seen.items() if n >= least and len(k := w.encode("utf-8", "replace")) <= longest]
            seen.clear()
            opened.clear()
            return pd.DataFrame(some, columns=["word", "n"])

        for pdf in batches:
            for t in pdf.iloc[:, 0]:
                for piece in split.pieces(t or "")[::2]:
                    cut_up = split.blanks(piece)
                    if cut_up is None:
                        seen.update(split.words(piece))
                    else:
                        seen.update(split.words(cut_up[0]))
                        opened.update(cut_up[1:])
                if len(seen) + len(opened) >= most:
                    yield out()
        yield out()
        give_back()

    part = frugal(docs).select(text_col).mapInPandas(run, "word binary, n bigint")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, text_col: str = "text", size: int = LEXICON_SIZE) -> bytes:
    """The transducer of the ``size`` most frequent words by lossy counts over all texts; null texts and an empty
    table have none. A frequent word that is missed costs a merge and changes no result.

    Only these words and a histogram of at most 64 rows leave the executors.
    """
    with settings(docs.sparkSession, SHORT_SHUFFLES):
        words = cut(count_words(docs, path, text_col, least=2))
        # words per power of two of their counts first, so that the histogram has a fixed number of rows
        power = F.floor(F.log2("n")).cast("int")
        coarse = {r["p"]: r["m"] for r in words.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("m")).collect()}
        total, edge = 0, 64
        while edge > 0 and total + coarse.get(edge - 1, 0) <= size:
            edge -= 1
            total += coarse.get(edge, 0)
        # then the most frequent words of the power that does not fit whole
        top = words.where(power >= edge).collect() if total else []
        if edge and total < size:
            top += words.where(power == edge - 1).orderBy(F.desc("n"), "word").limit(size - total).collect()
    v = vocabulary(path)
    return Transducer.compile({bytes(r["word"]): v.merge(bytes(r["word"])) for r in top})


_HELD: dict[tuple[str, str], Codec] = {}


def _drop() -> None:
    _HELD.clear()
    vocabulary.cache_clear()


def worker_codec(path: str, name: str) -> Codec:
    """The codec that a worker keeps from task to task of one run."""
    if (path, name) not in _HELD:
        _HELD.clear()
        _HELD[path, name] = Codec(path, mapped(SparkFiles.get(name)))
        hold("bpe", _drop)
    return _HELD[path, name]


def encode(docs: DataFrame, path: str, text_col: str = "text", lexicon: bytes | None = None, decoded: bool = False, ids_col: str = "ids", text_out: str = "decoded") -> DataFrame:
    """docs without text_col, plus ids (binary, little-endian unsigned 32-bit) and on demand the decoded text.

    Null and empty texts have no ids and decode to an empty text. Rows may repeat and each is encoded. A
    column of docs that has a result's name is replaced. Long texts are encoded whole.
    """
    made = [ids_col, text_out] if decoded else [ids_col]
    rest = [c for c in docs.columns if c != text_col and c.lower() not in [m.lower() for m in made]]
    name = ship(docs.sparkSession, lexicon if lexicon is not None else build_lexicon(docs, path, text_col))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = worker_codec(path, name)
        for s in batches:
            ids = codec.encode_all([t if isinstance(t, str) else None for t in s])
            yield pd.DataFrame({ids_col: ids} | ({text_out: codec.decode_all(ids)} if decoded else {}))
            del ids
        give_back()

    udf = F.pandas_udf(run, ", ".join([f"`{ids_col}` binary"] + [f"`{text_out}` string"] * decoded)).asNondeterministic()
    m = fresh(docs.columns, "_bpe")
    return frugal(docs).withColumn(m, udf(F.col(text_col))).select(*rest, f"{m}.*")


def decode(docs: DataFrame, path: str, ids_col: str = "ids", text_out: str = "text") -> DataFrame:
    """docs without ids_col, plus the text that its ids stand for; null ids give an empty text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(path)
        for s in batches:
            yield pd.Series(codec.decode_all([bytes(x or b"") for x in s]), dtype=object)

    rest = [c for c in docs.columns if c != ids_col and c.lower() != text_out.lower()]
    return frugal(docs).select(*rest, F.pandas_udf(run, "string")(F.col(ids_col)).alias(text_out))
