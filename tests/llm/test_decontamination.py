"""Benchmark leaks against an alignment at every offset."""

import itertools
import math
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewell.llm import decontamination
from tidewell.llm.decontamination import LEAST_TOKENS, WINDOW, contaminated


def tokens(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def plain(docs, items, share=0.8):
    """Best offset of each pair with a window that agrees enough."""
    out = []
    for key, text in docs:
        d = tokens(text)
        for item, t in items:
            b, best = tokens(t), None
            if len(b) < LEAST_TOKENS:
                if b and b == d:
                    out.append((key, item, 0, len(b), len(b)))
                continue
            for base in range(-len(b) + 1, len(d)):
                same = [0 <= base + i < len(d) and d[base + i] == x for i, x in enumerate(b)]
                w = min(WINDOW, len(b))
                if any(sum(same[i : i + w]) >= math.ceil(share * w - 1e-9) for i in range(len(b) - w + 1)):
                    best = max(best or (-1, 0), (sum(same), -base))
            if best:
                out.append((key, item, -best[1], best[0], len(b)))
    return sorted(out, key=repr)


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(1)).repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    return sorted((tuple(r) for r in contaminated(d, b).collect()), key=repr)


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_against_all_offsets(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    rng = random.Random(2)
    word = lambda: rng.choice("the of and ing thor enat reed ä é ß onth tion".split()) + rng.choice(["", "er", "ly", "ed", "ing"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([3, 4, 5, 6, 8, 10, 12, 13, 14, 20, 30, 45])]
    docs = [(None, items[9][1]), (1, None), (2, ""), (3, items[0][1]), (4, "one two"), (5, f" {items[1][1].upper()}! "), (6, f"{items[0][1]} and")]
    for i in range(60):
        t = tokens(rng.choice(items)[1])
        t = [x.decode() for x in t]
        for _ in range(rng.randint(0, len(t) // 4)):
            t[rng.randrange(len(t))] = word()
        a = rng.randint(0, 3)
        body = t[a:] if rng.random() < 0.3 else t
        docs.append((10 + i, " ".join([*(word() for _ in range(rng.randint(0, 20))), *body, *(word().title() + "," for _ in range(rng.randint(0, 20)))])))
    docs += [(200, docs[-1][1]), (200, docs[-1][1])]
    items += [(50, items[9][1]), (51, None), (52, "")]
    assert found(spark, docs, items) == plain(docs, items)


def by_definition(docs, items, share):
    """Pairs with a window that agrees enough, at any offset."""
    out = set()
    for key, text in docs:
        d = tokens(text)
        for item, t in items:
            b = tokens(t)
            w = min(WINDOW, len(b))
            for base in range(-len(b) + 1, len(d)) if len(b) >= LEAST_TOKENS else ():
                same = [0 <= base + i < len(d) and d[base + i] == x for i, x in enumerate(b)]
                if any(sum(same[i : i + w]) >= math.ceil(share * w - 1e-9) for i in range(len(b) - w + 1)):
                    out.add((key, item))
    return out


@pytest.mark.parametrize("share", [0.8, 0.7])
def test_every_permitted_difference_is_found(share):
    """All sets of tokens that may differ, inside the text and cut by its edges; no seed is asked for."""
    for n in range(LEAST_TOKENS, 16):
        item = [f"w{n}x{i}" for i in range(n)]
        width = min(n, WINDOW)
        texts = []
        for gaps in itertools.combinations(range(width), width - math.ceil(share * width - 1e-9)):
            changed = ["other" if i in gaps else x for i, x in enumerate(item)]
            texts += [" ".join(["before", *changed, "after"]), " ".join(changed).replace("other", " ").strip() if gaps else ""]
            kept = [i for i in range(n) if i not in gaps]
            texts.append(" ".join(changed[kept[0] : kept[-1] + 1]))
        docs, items = list(enumerate(texts)), [(0, " ".join(item))]
        own = decontamination.Items.of(pa.array([items[0][1]]), share)
        got = {(r[0], r[1]) for r in own.verified(*decontamination.tokens(pa.array(texts)), share)}
        assert got == by_definition(docs, items, share)


def test_one_changed_word_of_a_short_item(spark):
    got = found(spark, [(1, "so who wrote that red book then")], [(1, "Who wrote the red book?")])
    assert got == [(1, 1, 1, 4, 5)]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b c d e f g")]) == []
    assert found(spark, [(1, "a b c d e f g")], []) == []
