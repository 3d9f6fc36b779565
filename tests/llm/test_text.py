"""Words and hashes of flat texts against plain Python."""

import random

import numpy as np
import pyarrow as pa

from tidewell.llm import text
from tidewell.llm.text import distinct_spans, flat, pieces, span_hashes, words


def test_words_and_hashes(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " ", "a", *("".join(rng.choice("ab é\n") for _ in range(rng.randint(0, 60))) for _ in range(80)), "a"]
    data, offsets = flat(pa.array(texts).slice(1))
    starts, ends, counts = words(data, offsets)
    raw = data.tobytes()
    expected = [w for t in texts[1:] for w in t.encode().split()]
    assert [raw[a:b] for a, b in zip(starts, ends)] == expected
    assert counts.tolist() == [len(t.encode().split()) for t in texts[1:]]
    hashes = span_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(expected))
    assert {(w, h) for w, h in zip(expected, hashes.tolist())} == set(dict(zip(expected, hashes.tolist())).items())
    for size in (1, 7, 64):  # the same in blocks, also with spans longer than a block
        monkeypatch.setattr(text, "PIECE_BYTES", size)
        assert (span_hashes(data, starts, ends) == hashes).all()


def test_pieces_hold_whole_rows():
    batch = pa.RecordBatch.from_pydict({"t": ["x" * n for n in (3, 0, 9, 2, 2, 40, 1)] + [None]})
    cut = [p.column(0).to_pylist() for p in pieces(batch, "t", 10)]
    assert [x for p in cut for x in p] == batch.column(0).to_pylist()
    assert all(len(p) == 1 or sum(len(x or "") for x in p) <= 10 for p in cut)
    assert list(pieces(batch.slice(0, 0), "t")) == []
    assert np.array_equal(flat(pa.array([], pa.string()))[1], [0])


def alike() -> tuple[str, str]:
    """Two strings that every polynomial hash modulo a power of two takes as one."""
    word = "a"
    while len(word) < 1024:
        word += word.translate({97: 98, 98: 97})
    return word, word.translate({97: 98, 98: 97})


def test_distinct_spans_are_told_apart_by_their_bytes(monkeypatch):
    rng = random.Random(2)
    usual = " ".join("".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(300))
    first, second = alike()
    for text_in in (usual, f"{usual} {first} a {first}", f"a {first} {second} a {second} ab", "", "a"):
        data, offsets = flat(pa.array([text_in]))
        starts, ends, _ = words(data, offsets)
        for size in (50, 1 << 20):
            monkeypatch.setattr(text, "PIECE_BYTES", size)
            firsts, back = distinct_spans(data, starts, ends)
            expected = text_in.split()
            assert [expected[i] for i in firsts[back]] == expected and len(firsts) == len(set(expected))
    data, offsets = flat(pa.array([" ".join(alike())]))
    assert len(set(span_hashes(data, *words(data, offsets)[:2]).tolist())) == 1  # the case is a real one
