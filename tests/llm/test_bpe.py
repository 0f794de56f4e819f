import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "B", "é", "ß", "ñ", "中", "文", " ", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", "　", "​", "᠎", "'s", "'ll", "1", "²", "½", "٣", "_", "-", "...", "$", "😀", "é", "<|endoftext|>", "\x00", "the", " of", "İ", "ª", "µ", "Ⅷ", " ", "🏳️‍🌈", "क्षि"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_codec_equals_library(library):
    rng = random.Random(7)
    texts = ["", " ", "<|endoftext|>", "x" * 3000, "ab" * 2000, "Hello world's end"] + ["".join(rng.choices(ODD, k=rng.randint(1, 40))) for _ in range(3000)]
    lex = bpe.Transducer.compile({w.encode(): bpe.vocabulary(PATH).merge(w.encode()) for w in ["the", " the", " of", "a", "thing", " thing", "é"]})
    for codec in (bpe.Codec(PATH), bpe.Codec(PATH, lex)):
        for t in texts:
            want = library.encode(t, add_special_tokens=False).ids
            got = codec.encode(t)
            assert np.frombuffer(got, "<u4").tolist() == want, repr(t)
            assert codec.decode(got) == library.decode(want, skip_special_tokens=False), repr(t)
        assert codec.encode_all([*texts, None]) == [*map(codec.encode, texts), b""]
        packed = [*map(codec.encode, texts), b""]
        assert codec.decode_all(packed) == [*map(codec.decode, packed)] and codec.decode_all([]) == [] and codec.decode_all([b""]) == [""]
    small = bpe.Codec(PATH, lex, most=5)  # a memory that forgets at once
    assert small.encode_all(texts) == [*map(codec.encode, texts)]


def test_merging_words_together_equals_one_by_one():
    rng = random.Random(8)
    v = bpe.vocabulary(PATH)
    words = ["".join(rng.choices("aeinorst hlétion", k=rng.randint(1, 60))).encode() for _ in range(4000)] + [b"", b"x" * 500, b"a"]
    assert v.merge_all(words) == [np.array(v.merge(w), "<u4").tobytes() for w in words]
    assert v.merge_all([]) == [] and v.merge_all([b"abc"]) == [np.array(v.merge(b"abc"), "<u4").tobytes()]


def test_transducer_is_exact_and_minimal(tmp_path):
    rng = random.Random(3)
    entries = {bytes(rng.choices(b"abcd", k=rng.randint(1, 8))): [rng.randrange(50000) for _ in range(rng.randint(1, 4))] for _ in range(800)}
    (tmp_path / "lexicon").write_bytes(bpe.Transducer.compile(entries))
    t = bpe.Transducer(bpe.mapped(str(tmp_path / "lexicon")))
    for w, ids in entries.items():
        assert t.get(w) == ids
    for _ in range(2000):
        w = bytes(rng.choices(b"abcde", k=rng.randint(0, 9)))
        assert t.get(w) == entries.get(w)
    shared = bpe.Transducer(bpe.Transducer.compile({b + b"ing": [1] for b in (b"a", b"b", b"c")}))
    assert shared.states == 5  # root, i, n, g and the end
    assert bpe.Transducer(bpe.Transducer.compile({})).get(b"a") is None


def test_encode_frame(spark, library):
    rows = [(1, "Hello  world\n", "x"), (2, None, None), (3, "", "y"), (3, "", "y"), (None, "word " * 5000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    out = bpe.encode(docs, PATH, decoded=True).collect()
    assert sorted(out[0].asDict()) == ["decoded", "doc_id", "ids"]
    assert len(out) == 5
    for r in out:
        text = {1: rows[0][1], None: rows[4][1]}.get(r.doc_id, "")
        assert r.decoded == text
        assert hashlib.sha256(bytes(r.ids)).digest() == hashlib.sha256(np.array(library.encode(text).ids, "<u4").tobytes()).digest()
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    back = bpe.decode(bpe.encode(docs, PATH), PATH).orderBy("doc_id").collect()
    assert [r.text for r in back] == ["word " * 5000, rows[0][1], "", "", ""]


def test_word_counts(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices(["ab", "c", " ", "\n", ".", "'s", "  ", "\t", "é", "<|endoftext|>", "1"], k=rng.randint(0, 30))) for _ in range(200)] + ["plain words, stand\nalone here", None, ""]
    want = {}
    split = bpe.Splitter({"<|endoftext|>": 50256})
    for t in texts:
        for piece in (t or "").split("<|endoftext|>"):
            for w in split.exact.findall(piece):
                want[w.encode()] = want.get(w.encode(), 0) + 1
    got = bpe.count_words(spark.createDataFrame([(t,) for t in texts], "text string"), PATH).collect()
    assert {bytes(r.word): r.n for r in got} == want
