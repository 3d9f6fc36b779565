"""The corpus pipeline, stage by stage, against plain versions."""

import random

import public_tokenizers
import pytest
from test_decontamination import plain as plain_leaks
from test_simhash import plain_components, plain_fingerprint
from test_suffix_dedup import LENGTH
from tokenizers import Tokenizer

import corpus_pipeline

ENGLISH = "the of and to in is that for it was with as his on be at by had not are but from have this which".split()
GERMAN = "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split()


def sentence(rng, vocabulary, n):
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", "er", "ung", "ly"]) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    benchmark = [(i, sentence(rng, ENGLISH, 30)) for i in range(4)]
    passage = sentence(rng, GERMAN, 60)
    rows = []
    for i in range(60):
        vocabulary, lang = (ENGLISH, "en") if i % 3 else (GERMAN, "de")
        rows.append([i, sentence(rng, vocabulary, rng.randint(20, 150)), lang])
    rows[5][1] += " " + benchmark[1][1]
    rows[8][1] = benchmark[2][1].upper() + " " + rows[8][1]
    for i in (7, 20, 33, 41):
        rows[i][1] += "\n" + passage + "\n" + sentence(rng, GERMAN, 10)
    for i in (10, 11, 12):  # near copies of long texts, and exact ones
        rows.append([100 + i, sentence(rng, ENGLISH, 400), "en"])
        rows.append([200 + i, rows[-1][1].replace(" the ", " thee ", 1), "en"])
        rows.append([300 + i, rows[-2][1], None])
    rows += [[400, None, "en"], [401, "", "en"], [402, "1234 5678 !!", "en"], [None, sentence(rng, GERMAN, 30), "de"], [100, rows[60][1], "en"]]
    rows += [[403, passage, "de"]]  # nothing of it is new
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.createDataFrame([(*r, f"s{i % 3}", None if r[1] is None else len(r[1])) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, benchmark


def plain_cut(rows):
    """{(id, text): what is left}: repeated bytes go, but for characters cut at the edges."""
    first = {}
    for key, t in rows:
        raw = t.encode()
        for i in range(len(raw) - LENGTH + 1) if key is not None else ():
            s = raw[i : i + LENGTH]
            first[s] = min(key, first.get(s, key))
    out = {}
    for key, t in rows:
        raw = t.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - LENGTH + 1) if key is not None else ():
            if first[raw[i : i + LENGTH]] < key:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        at, left = 0, ""
        for c in t:
            n = len(c.encode())
            left += "" if all(gone[at : at + n]) else c
            at += n
        out[key, t] = left
    return out


def test_stages(spark, folder):
    path, benchmark = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    frames = {}
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, path)
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
        docs = docs.cache()
        frames[name] = docs.collect()
    before = spark.read.parquet(f"{path}/documents.parquet").collect()

    languages = frames["language"]
    assert sorted((r.doc_id or -1, r.text) for r in languages) == sorted((r.doc_id or -1, r.text) for r in before if r.text and any(c.isalpha() for c in r.text))
    assert all(r.lang == ("de" if sum(w in GERMAN for w in r.text.split()) > sum(w in ENGLISH for w in r.text.split()) else "en") for r in languages)

    own = [(r.doc_id, plain_fingerprint(r.text)) for r in languages]
    low = plain_components(own)
    kept = {k for k, fp in own if k is not None and low[fp] == k}
    assert sorted(r.doc_id for r in frames["near_duplicates"] if r.doc_id is not None) == sorted(kept)
    assert sum(r.doc_id is None for r in frames["near_duplicates"]) == 1
    assert not {110, 310, 311, 312} & kept and {100, 111, 112} <= kept

    left = plain_cut([(r.doc_id, r.text) for r in frames["near_duplicates"]])
    assert sorted(((r.doc_id, r.text) for r in frames["repeats"]), key=repr) == sorted(((k, t) for (k, _), t in left.items() if t), key=repr)
    assert 403 not in {r.doc_id for r in frames["repeats"]}
    assert all(r.n_chars == len(r.text) for r in frames["repeats"])

    leaks = {k for k, *_ in plain_leaks([(r.doc_id, r.text) for r in frames["repeats"]], benchmark)}
    assert leaks == {5, 8}
    assert sorted(repr(r) for r in frames["leaks"]) == sorted(repr(r) for r in frames["repeats"] if r.doc_id not in leaks)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 2] for r in frames["leaks"]}
    packed = {}
    for r in sorted(frames["packing"], key=lambda r: r.start):
        packed.setdefault(r.doc_id, []).extend(r.ids)
    assert packed == ids


def test_run_is_its_stages(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, path)
    rows = lambda df: sorted(map(repr, df.drop("sequence_id").collect()))
    assert rows(corpus_pipeline.run(spark, path)) == rows(docs)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_rows_that_repeat_an_id(spark, tmp_path):
    """Each text of a repeated id is judged by its own group; of equal ones in one group one stays."""
    rng = random.Random(12)
    a, b, c, d = (sentence(rng, ENGLISH, 200) for _ in range(4))
    near = a.replace(" the ", " thee ", 1)
    rows = [(5, a), (5, near), (5, b), (3, b), (7, c), (7, c), (7, d), (2, d), (9, near), (None, a), (None, a), (11, sentence(rng, ENGLISH, 90))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    fp = {t: plain_fingerprint(t) for t in (a, near)}
    assert bin(fp[a] ^ fp[near]).count("1") <= corpus_pipeline.MOST_BITS
    found = corpus_pipeline.drop_near_duplicates(spark, docs.withColumn("fp", docs.doc_id).repartition(3), "")
    assert found.columns == corpus_pipeline.COLUMNS
    kept = [(5, min(a, near)), (3, b), (7, c), (2, d), (None, a), (None, a), (11, rows[-1][1])]
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=repr) == sorted(kept, key=repr)


def test_inner_tables_go(spark, folder, tmp_path):
    spark.conf.set("spark.tidewell.staging.dir", str(tmp_path))
    try:
        assert corpus_pipeline.run(spark, folder[0]).count() > 0
        (application,) = tmp_path.iterdir()
        assert {p.name.split("-")[0] for p in application.iterdir()} == {"pipeline"}
        assert len(list(application.iterdir())) == len(corpus_pipeline.STAGES) - 1
    finally:
        spark.conf.unset("spark.tidewell.staging.dir")
