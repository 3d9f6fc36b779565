"""Packing: every id in one piece, lengths powers of two, ids as the library gives them."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import packing
from tidewell.llm.packing import WordEncoder, binary_lengths, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "The", "  ", "\n", " ", "'re", "'S", "É", "ß", "日本", "12", "²", "<|endoftext|>", "<|x", "!!", "\t", "don't", " ",
    "ا", "é", "😀", "_", "x" * 40, "Σ", "ΟΔΟΣ ", "İ", "\x1c", "\x85", " ", ".", ",", "\x00", "ẞ", "Ⅻ", "ﬁ", "é", "́",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("most", [1, 8, 4096])
def test_binary_lengths(most):
    for n in [0, 1, 2, 7, 8, 9, 4095, 4096, 4097, 10000]:
        found = binary_lengths(n, most)
        assert sum(found) == n and sorted(found, reverse=True) == found
        assert all(x & (x - 1) == 0 and x <= most for x in found)
        assert len(found) == n // most + bin(n % most).count("1")


@pytest.mark.parametrize("small", [False, True])
def test_ids(library, monkeypatch, small):
    if small:
        monkeypatch.setattr(packing, "CACHE_WORDS", 2)
        monkeypatch.setattr(packing, "CACHE_PARTS", 2)
    own = WordEncoder(PATH)
    for seed in range(4):
        many = [*texts(seed, 300), None, ""]
        ids, counts = own.encode(pa.array(many))
        for t, got in zip(many, np.split(ids, np.cumsum(counts)[:-1])):
            assert got.tolist() == library.encode(t or "", add_special_tokens=False).ids, t


def test_pieces(spark, library):
    rows = [(i, t) for i, t in enumerate([*texts(9, 40), None, "", "one two three " * 4000])] + [(3, "again"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3)
    found = pack(df, PATH).collect()
    assert len({r.sequence_id for r in found}) == len(found) and all(r.offset == 0 for r in found)
    docs = defaultdict(list)
    for r in found:
        assert r.length & (r.length - 1) == 0 and r.length <= 4096 and r.length == len(r.ids) == 1 << r.bucket
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        docs[r.doc_id].append(r)
    for key, t in rows:
        if key == 3:
            continue
        expected = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted(docs[key], key=lambda r: r.start)
        assert [i for r in own for i in r.ids] == expected
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert {r.doc_tokens for r in own} == {len(expected)}
    assert sum(r.length for r in docs[3]) == sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in rows if k == 3)
    assert pack(df.limit(0), PATH, with_ids=False).collect() == []


def test_words_of_one_hash_keep_their_own_ids(library):
    from test_text import alike

    rows, own = list(alike()), WordEncoder(PATH)
    for texts_in in (rows, rows[::-1], [rows[0]], [rows[1]], ["x ".join(rows)]):
        ids, counts = own.encode(pa.array(texts_in))
        expected = [e.ids for e in library.encode_batch(texts_in, add_special_tokens=False)]
        assert ids.tolist() == [i for e in expected for i in e] and counts.tolist() == [len(e) for e in expected]


def test_memory_of_words_is_bounded(monkeypatch, library):
    monkeypatch.setattr(packing, "CACHE_BYTES", 2000)
    own, rng = WordEncoder(PATH), random.Random(9)
    for _ in range(30):
        text = " ".join("".join(rng.choices("abc1", k=rng.randint(1, 30))) for _ in range(50))
        ids, _ = own.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert own.held < 2000 + 2000 and sum(map(len, own.words)) == own.held


def test_new_words_are_learnt_in_parts(monkeypatch, library):
    """What the library makes of new words on its way is bounded, however many a batch brings."""
    monkeypatch.setattr(packing, "LEARNT_TOGETHER", 7)
    own, learn, sizes = WordEncoder(PATH), WordEncoder._learn, []
    monkeypatch.setattr(WordEncoder, "_learn", lambda self, words: (sizes.append(len(words)), learn(self, words)))
    text = " ".join([*(f"w{i}x" for i in range(60)), *PARTS])
    ids, _ = own.encode(pa.array([text]))
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert max(sizes) == 7 and sum(sizes) == len(own.words)


def test_memory_that_every_worker_keeps():
    from tidewell.llm import text

    data = np.frombuffer(b"a" * (text.PIECE_BYTES + 5) + b" b", np.uint8)
    starts, ends = np.array([0, 5, len(data) - 1]), np.array([3, len(data) - 2, len(data)])
    assert len(set(text.span_hashes(data, starts, ends).tolist())) == 3
    assert sum(x.nbytes for x in text._usual_powers(text._USUAL)) < 18 << 20
