"""Token counts of every prefix against the tokenizers library."""

import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import token_counts
from tidewell.llm.token_counts import PrefixCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "the", "  ", "\n", " ", "'re", "'s", "'", "é", "ß", "日本", "12", "²", "<|endoftext|>", "<|end", "!!", "\t", "don't",
    " ", "ا", "ñ", "😀", "_", "x" * 40, "ve", " ", "é", "word", " word", "Ünder",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(PATH)


def plain(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_every_prefix(library, counter):
    for t in texts(1, 250):
        found = counter.all_prefixes(t)
        for i in range(len(t) + 1):
            assert found[len(t[:i].encode())] == plain(library, t[:i]), (t, i)


def test_totals_and_cuts(library, counter):
    many = [*texts(2, 400), None, "", "a\x1cb c", "q" * 700, "the cat " * 50]
    for limit in (0, 3, 7):
        for t, (size, total, cut) in zip(many, counter.count_all(many, limit)):
            raw = (t or "").encode()
            assert (size, total) == (len(raw), plain(library, t))
            if t and "\x1c" not in t:
                fits = [len(t[:i].encode()) for i in range(len(t) + 1) if plain(library, t[:i]) <= limit]
                assert cut <= max(fits) and plain(library, raw[:cut].decode()) <= limit


def long_words(rng):
    yield "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=700))
    yield "".join(rng.choices("etaoin", k=300)) + "ß" * 5 + "é".join(rng.choices("xyz", k=90))
    yield "".join(chr(rng.randint(0x4E00, 0x9FA0)) for _ in range(150))
    yield "的一是不了人我在有他这" * 20
    yield from ("=" * 300, "ab" * 200, "<" * 40 + "|endoftext" * 30)


@pytest.mark.parametrize("widths", [(32, 256), (4, 8), (2000, 4000)])
def test_every_prefix_of_long_words(library, monkeypatch, widths):
    monkeypatch.setattr(token_counts, "MATRIX_WIDTHS", widths)
    monkeypatch.setattr(token_counts, "CELLS", 600)
    own = PrefixCounter(PATH)
    words = list(long_words(random.Random(5)))
    for word, counts in zip(words, own.prefixes([w.encode() for w in words])):
        ends = [len(word[: i + 1].encode()) for i in range(len(word))]
        for i in range(0, len(word), 7):
            assert counts[ends[i] - 1] == plain(library, word[: i + 1])
        assert counts[-1] == plain(library, word) and len(counts) == len(word.encode())


def test_pairs_from_merges_are_those_of_the_library(counter):
    rng = random.Random(6)
    usable = [i for i in counter.ids.values() if counter.stands_alone[i]]
    left, right = ([rng.choice(usable) for _ in range(20_000)] for _ in range(2))
    for a in rng.sample(usable, 300):  # pairs that a longer token holds
        token = counter.pair_is_valid.spelling[a]
        for i in range(1, len(token)):
            met = [counter.whole_text.token_to_id(x) for x in (token[:i], token[i:])]
            if None not in met:
                left.append(met[0]), right.append(met[1])
    expected = counter.pair_is_valid(np.array(left), np.array(right))
    assert [counter.alone_is_valid.apart(a, b) for a, b in zip(left, right)] == expected.tolist()


def test_long_words_take_time_by_their_length(counter, library):
    rng = random.Random(7)
    word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=100_000))
    start = time.process_time()
    ((size, total, _),) = counter.count_all([word])
    assert time.process_time() - start < 5 and (size, total) == (100_000, plain(library, word))


def test_memory_of_words_is_bounded(monkeypatch, library):
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 20_000)
    own, rng = PrefixCounter(PATH), random.Random(8)
    for _ in range(40):
        text = " ".join("".join(rng.choices("abcdé", k=rng.randint(1, 60))) for _ in range(60))
        assert own.count_all([text])[0][1] == plain(library, text)
        held = sum(len(v) for v in own.words.values()) + sum(map(len, own.stretches))
        assert held <= 20_000 + 30_000


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(token_counts, "PAIR_ENTRIES", 3)
    own = PrefixCounter(PATH)
    for t in texts(3, 60):
        assert own.count_all([t, t])[1][1] == plain(library, t)


def test_table(spark, library):
    rows = [(i, t) for i, t in enumerate([*texts(4, 30), None, "", "long " * 3000])] + [(3, "again"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    found = sorted((tuple(r) for r in count_tokens(df, PATH, limit=1024).drop("cut_bytes").collect()), key=repr)
    assert found == sorted(((k, len((t or "").encode()), plain(library, t)) for k, t in rows), key=repr)
    assert count_tokens(df.limit(0), PATH).collect() == []
