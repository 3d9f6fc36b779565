"""Array files read in pieces give what the reader of whole files gives."""

import json
import random
from collections import Counter

import pytest

from tidewell.sources import files
from tidewell.sources.corrupt import CORRUPT
from tidewell.sources.files import RawFile, read_json, read_raw
from tidewell.sources.json_arrays import _pieces, read_json_array


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    old = {n: spark.conf.get(n) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def value(rng, depth=0):
    kind = rng.randint(0, 8 if depth < 3 else 5)
    if kind < 3:
        return "".join(rng.choices('ab"\\{}[],: \n\té😀', k=rng.randint(0, 12)))
    if kind < 6:
        return rng.choice([None, True, -3, 1.25, 10**12, "}" * 5, "\\", '"'])
    if kind < 7:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {f"k{i}": value(rng, depth + 1) for i in range(rng.randint(0, 3))}


def rows(df, columns):
    shown = [f"to_json({c}) AS {c}" for c in columns]
    return Counter(tuple(r) for r in df.selectExpr(*shown, CORRUPT).collect())


@pytest.mark.parametrize("seed, indent, ascii_only", [(1, None, True), (2, 2, False), (3, 1, True)])
def test_equal_to_whole_files(spark, tmp_path, small_blocks, seed, indent, ascii_only):
    rng = random.Random(seed)
    for name, n in (("a", 120), ("b", 1), ("c", 60)):
        records = [{c: value(rng) for c in ("a", "b", "c") if rng.random() < 0.9} for _ in range(n)]
        (tmp_path / f"{name}.json").write_text(json.dumps(records, indent=indent, ensure_ascii=ascii_only), "utf-8")
    path = str(tmp_path)
    assert _pieces(spark, path).select("file", "block").distinct().count() > 10
    assert rows(read_json_array(spark, path, ("a", "c")), ("a", "c")) == rows(read_json(spark, path, ("a", "c")), ("a", "c"))
    assert rows(read_json_array(spark, path), ("data",)) == rows(read_json(spark, path), ("data",))


def found(spark, tmp_path, text, columns=()):
    (tmp_path / "x.json").write_bytes(text if isinstance(text, bytes) else text.encode())
    df = read_json_array(spark, str(tmp_path / "x.json"), columns)
    return sorted(((json.loads(a) if a else None, b) for a, b in rows(df, columns or ("data",)).elements()), key=repr)


def test_odd_files(spark, tmp_path):
    whole = [("", []), ("[]", []), (" [ ] \n", []), ("[1, \"}\", null]", [1, "}", None]), ('{"a": {"b": 1}}', [{"a": {"b": 1}}])]
    whole += [('{"a":{}}\n{"a":2}', [{"a": {}}, {"a": 2}]), ('[{"a":1}, 5, [{}], {}, "x"]', [{"a": 1}, 5, [{}], {}, "x"])]
    whole += [(b"\xef\xbb\xbf" + b'[{"a":1}]', [{"a": 1}]), (b"\xef\xbb\xbf" + b'{"a":1}', [{"a": 1}]), ("[{}]", [{}]), ('[{"a":1}', [{"a": 1}])]
    for text, expected in whole:
        assert found(spark, tmp_path, text) == sorted([(x, None) for x in expected], key=repr), text


def test_broken_records(spark, tmp_path):
    assert found(spark, tmp_path, '[{"a":1},{"a":2') == [(None, '{"a":2'), ({"a": 1}, None)]
    assert found(spark, tmp_path, '[{"a":1},{"a":{"b":2}') == [(None, '{"a":{"b":2}'), ({"a": 1}, None)]
    assert found(spark, tmp_path, '[{"a":1},{"a" 2},{"a":3}]') == [(None, '{"a" 2}'), ({"a": 1}, None), ({"a": 3}, None)]
    assert found(spark, tmp_path, '[{"a":1},{"a" 2},{"a":3}]', ("a",)) == [(1, None), (3, None), (None, '{"a" 2}')]


def test_large_exports_are_split(spark, tmp_path, monkeypatch):
    (tmp_path / "x.json").write_text(json.dumps([{"a": i, "b": "}"} for i in range(50)]))
    file = RawFile("inventory", "OTA", "x.json", ("a", "b"))
    whole = rows(read_raw(spark, str(tmp_path), file), file.columns)
    monkeypatch.setattr(files, "WHOLE_ARRAY_BYTES", 100)
    assert rows(read_raw(spark, str(tmp_path), file), file.columns) == whole and sum(whole.values()) == 50
    assert read_raw(spark, str(tmp_path), RawFile("users", "WHATSAPP", "none.json", optional=True)) is None
