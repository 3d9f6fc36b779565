"""SimHash and its links against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidewell.llm.simhash import fingerprints_of, links, near_duplicates


def plain_fingerprint(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """rows: (id, fp) -> {fp: smallest id}"""
    fps = sorted({fp for _, fp in rows})
    root = {fp: fp for fp in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    low = {}
    for key, fp in rows:
        if key is not None:
            low[find(fp)] = min(key, low.get(find(fp), key))
    return {fp: low.get(find(fp)) for fp in fps}


TEXTS = [
    None, "", " \t\n", "One", "one", "a b c", "A  b\nc d", "a b c d", "x " * 3000, "ÄÖ ß é É", "a b c d e f g",
    "word " * 10 + "é" * 5000, "no break space here now", "a b c d",
]


def test_fingerprints():
    found = fingerprints_of(pa.array(TEXTS), 4)
    assert [int(x) for x in found] == [plain_fingerprint(t) for t in TEXTS]
    assert [int(x) for x in fingerprints_of(pa.array(TEXTS).slice(3, 5), 4)] == [plain_fingerprint(t) for t in TEXTS[3:8]]


@pytest.mark.parametrize("distance", [1, 3, 4, 7])
def test_links_connect_what_is_near(spark, distance):
    rng = random.Random(distance)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0}
    for fp in list(fps)[:40]:
        for _ in range(12):
            x = fp
            for b in rng.sample(range(64), rng.randint(1, 2 * distance)):
                x ^= 1 << b
            fps.add(x)
    centre = rng.getrandbits(64)  # one dense group
    fps |= {centre ^ sum(1 << b * 5 for b in range(9) if n >> b & 1) for n in range(512)}
    signed = [(int(np.uint64(x).view(np.int64)),) for x in fps]
    found = {tuple(r) for r in links(spark.createDataFrame(signed, "fp long").repartition(3), distance).distinct().collect()}
    unsigned = {(a % 2**64, b % 2**64) for a, b in found}
    assert all((a ^ b).bit_count() <= distance for a, b in unsigned)

    def classes(pairs):
        root = {x: x for x in fps}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        groups = {}
        for x in fps:
            groups.setdefault(find(x), set()).add(x)
        return {frozenset(g) for g in groups.values()}

    ordered = sorted(fps)
    near = [(a, b) for i, a in enumerate(ordered) for b in ordered[:i] if (a ^ b).bit_count() <= distance]
    assert classes(unsigned) == classes(near)


def test_near_duplicates(spark):
    rng = random.Random(7)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "One"), (None, "only this one has no id at all")]
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randint(0, 99)) for _ in range(300)) for _ in range(5)]
    for i, t in enumerate(base):
        ws = t.split()
        for k in range(6):
            w = list(ws)
            w[rng.randrange(300)] = "changed"
            rows.append((100 + 10 * i + k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    found = sorted((r.doc_id is None, r.doc_id or 0, r.fp % 2**64, r.component) for r in near_duplicates(docs).collect())
    own = [(k, plain_fingerprint(t)) for k, t in rows]
    low = plain_components(own)
    assert found == sorted((k is None, k or 0, fp, low[fp]) for k, fp in own)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
