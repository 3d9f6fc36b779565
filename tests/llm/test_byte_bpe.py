"""Byte-level BPE against the library, and back to the bytes."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidewell.llm import byte_bpe
from tidewell.llm.byte_bpe import decode, encode, read_ranks
from tidewell.llm.registry import op13_byte_bpe

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken")]


def library(path):
    ranks = {piece: i for i, piece in enumerate(read_ranks(path).pieces)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def both(spark, rows, path, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("clash"), "word": F.lit(1)})
    out = encode(df.repartition(3), path, public_tokenizers.PATTERN, **options).withColumn("bytes", decode(spark, F.col("ids"), path))
    return sorted(((r["doc_id"], r["text"], r["ids"], bytes(r["bytes"])) for r in out.collect()), key=repr)


def expected(rows, path):
    tokenizer = library(path)
    return sorted(((k, t, tokenizer.encode_ordinary(t or ""), (t or "").encode()) for k, t in rows), key=repr)


def texts(rng):
    alphabets = [
        "abcdefghijklmnopqrstuvwxyz", "ab", "äöüßéèçñ", "的一是不了人我在有他这中大来上", "абвгдежзийклмн", "0123456789½²①",
        " \t\n\r  　\u0085", "'s't're.,;:!?-=_*#/\\\"", "\U0001f600\U0001f468‍́\x00\x1f￿",
        "ࡰᲉ\U00031350\U0001e4d0\U00010ec2",  # letters of later Unicode versions
    ]
    for n in range(300):
        parts = [rng.choice(alphabets) for _ in range(rng.randint(1, 4))]
        yield "".join(rng.choice(rng.choice(parts)) for _ in range(rng.randint(0, 60)))


@pytest.mark.parametrize("path", PATHS)
def test_against_library(spark, path):
    rng = random.Random(7)
    rows = [(i, t) for i, t in enumerate(texts(rng))]
    rows += [(None, "null key"), (400, None), (401, ""), (402, " "), (403, rows[0][1]), (403, rows[0][1])]
    rows += [(404, "<|endoftext|> it's  we'LL\n\n x"), (405, "=" * 5000), (406, "ab" * 3000), (407, "".join(rng.choices("abcdefgh", k=600)))]
    assert both(spark, rows, path, most_words=64) == expected(rows, path)


def test_every_place_taken_and_none(spark):
    """Whether a word comes from the table or is folded where it stands makes no difference."""
    rng = random.Random(8)
    words = ["".join(rng.choices("etaoins", k=rng.randint(1, 9))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=40))) for i in range(40)]
    known = expected(rows, PATHS[0])
    assert both(spark, rows, PATHS[0], most_words=1) == both(spark, rows, PATHS[0], most_words=1000) == known


def test_smaller_maps_come_first(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "FEWER_WORDS", (1, 2))
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["the", "a", "of", "zyx", "qua"], [9, 5, 3, 2, 1], k=30))) for i in range(20)]
    assert both(spark, rows, PATHS[0], most_words=8) == expected(rows, PATHS[0])
    counted = spark.createDataFrame([(["a"] * 5 + ["bc"] * 4 + ["d"] * 4,)], "words array<string>")
    maps = byte_bpe.frequent_words(counted, byte_bpe.folding(spark, PATHS[0]), 8)
    held = [{w for m in spark.range(1).select(F.expr(name)).first()[0] if m for w in m} for name, _ in maps]
    assert held == [{"a"}, {"a", "bc"}, {"a", "bc", "d"}]


def test_patterns_are_factored():
    assert byte_bpe._factored(public_tokenizers.PATTERN).startswith("'(?:s|t|re|ve|m|ll|d)| ?")
    for kept in (r"a|b", r"(?:ab|ac)+|ad", r"[a|b]+", "ab", r"\w+|\s+"):
        assert byte_bpe._factored(kept) == kept


def test_the_most_frequent_words_are_kept(spark):
    counted = spark.createDataFrame([(["a"] * 5 + ["bc"] * 4 + ["d"] * 4 + ["é" * 40] * 9,)], "words array<string>")
    for most, expected in ((1, {"a"}), (2, {"a"}), (3, {"a", "bc", "d"}), (9, {"a", "bc", "d"})):
        ((known, buckets),) = byte_bpe.frequent_words(counted, byte_bpe.folding(spark, PATHS[0]), most)
        held = spark.range(1).select(F.expr(known).alias("k")).first()["k"]
        assert len(held) == buckets == -(-most // 2) and {w for m in held if m for w in m} == expected


def test_other_files(tmp_path):
    import base64

    def file(pieces):
        path = tmp_path / str(len(list(tmp_path.iterdir())))
        path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % i for i, p in enumerate(pieces)))
        return str(path)

    every = [bytes([b]) for b in range(256)]
    assert read_ranks(file([*every, b"ab", b"abc"])).parts[257] == (256, 99)
    for pieces in ([*every, b"abc"], [*every, b"abcd", b"ab", b"cd"], every[1:]):
        with pytest.raises(ValueError):
            read_ranks(file(pieces))


def test_unknown_id_decodes_to_null(spark):
    rows = spark.createDataFrame([([1, 2],), ([1, 60000],), ([],), (None,)], "ids array<int>")
    assert [r[0] is None for r in rows.select(decode(spark, F.col("ids"), PATHS[0])).collect()] == [False, True, False, True]


def test_empty_table(spark):
    assert both(spark, [], PATHS[0]) == []


def test_query(spark, data):
    import hashlib

    tokenizer = library(PATHS[0])
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()

    def row(key, text):
        ids = tokenizer.encode_ordinary(text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (text or "").encode())]
        return (key, len(ids), *digests)

    found = op13_byte_bpe(spark, data)
    assert dict(found.dtypes)["n_tokens"] == "bigint"
    assert sorted(tuple(r) for r in found.collect()) == sorted(row(*d) for d in docs)


@pytest.mark.parametrize("path", PATHS)
def test_words_folded_together(path):
    rng, ranks = random.Random(10), {piece: i for i, piece in enumerate(read_ranks(path).pieces)}
    tokenizer = tiktoken.Encoding("own", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
    words = ["".join(rng.choices("abcdeöß的 =-é1", k=rng.randint(1, 40))) for _ in range(500)]
    words += ["=" * n for n in range(1, 70)] + ["ab" * 50, "aaab" * 30, "".join(rng.choices("abcdefgh", k=20_000))]
    raw = [w.encode() for w in words]
    ids, counts = byte_bpe.fold_together(np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw]), byte_bpe.pairs_of(path))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [tokenizer.encode_ordinary(w) for w in words]
    none, counts = byte_bpe.fold_together(np.zeros(0, np.uint8), np.zeros(0, np.int64), byte_bpe.pairs_of(path))
    assert not len(none) and not len(counts)


def test_words_without_a_place_are_folded_in_batches(spark):
    """Words that the maps do not have: of many lengths, repeated, alone in a text and between known ones."""
    rng = random.Random(11)
    rare = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzäé的", k=k)) for k in (1, 2, 3, 9, 64, 65, 400, 20_000)]
    rows = [(i, " ".join(["the"] * i + [rare[i], "the", rare[i], rare[-1 - i]])) for i in range(8)] + [(8, None), (9, "the the"), (10, rare[3])]
    assert both(spark, rows, PATHS[0], most_words=1) == expected(rows, PATHS[0])
    plan = encode(spark.createDataFrame(rows, "doc_id long, text string"), PATHS[0], public_tokenizers.PATTERN, most_words=1)
    assert "ArrowEvalPython" in plan._jdf.queryExecution().executedPlan().toString()
