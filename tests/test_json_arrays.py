"""JSON array files read in splits of a few bytes, against the json module."""

import gzip
import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from newsloom.session import store
from newsloom.sources import json_arrays, readers

SCHEMA = "n int, t string, o struct<a: array<int>, b: struct<c: string>>, l array<struct<k: string>>"
HARD = ['"', "\\", "}", "{", "[", "]", ",", "ñ", " ", "😀", "\n", " ", "a", '\\"', "}{", '":']


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "37", "spark.sql.files.openCostInBytes": "1"}
    old = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def hard_records(count, seed):
    draw = random.Random(seed)

    def text():
        return "".join(draw.choice(HARD) for _ in range(draw.choice([0, 1, 5, 60])))

    return [
        {
            "n": i, "t": text(),
            "o": draw.choice([None, {"a": [1, 2], "b": {"c": text()}}, {"a": [], "b": None}]),
            "l": draw.choice([None, [], [{"k": text()}, {"k": None}]]),
        }
        for i in range(count)
    ]


def as_json(row):
    return row.asDict(recursive=True)


@pytest.mark.parametrize("style", [{"indent": 4}, {"ensure_ascii": False}, {"separators": (",", ":")}])
def test_records_over_splits(spark, tmp_path, small_splits, style):
    files = {"a": hard_records(14, 1), "b": hard_records(6, 2), "c": [], "d": hard_records(1, 3)}
    for name, records in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(records, **style) + "\n", encoding="utf-8")
    (tmp_path / "e.json").write_text("")
    pieces = json_arrays._pieces(spark, str(tmp_path))
    assert pieces.select("file", "split").distinct().count() > 20
    # Some files by their splits, some as one value, or all by their splits.
    whole = 0 if "indent" in style else 300
    found = json_arrays.json_records(spark, str(tmp_path), SCHEMA, whole_bytes=whole).collect()
    got = {(r.file[-6:-5], r.place): as_json(r.row) for r in found}
    assert len(got) == len(found)
    assert got == {(name, i): r for name, records in files.items() for i, r in enumerate(records)}


def test_one_object_with_a_mark(spark, tmp_path, small_splits):
    for name, end in (("a", ""), ("b", " \n")):
        (tmp_path / f"{name}.json").write_text("﻿" + json.dumps({"n": 1, "t": "}" * 90}) + end, encoding="utf-8")
    found = readers.read_json_array(spark, str(tmp_path), SCHEMA)
    assert rows(found.select("n", "t")) == [(1, "}" * 90)] * 2


def test_compressed_arrays(spark, tmp_path):
    records = hard_records(20, 4)
    for name, content in (("a", records), ("b", {"n": 20}), ("c", [])):
        with gzip.open(tmp_path / f"{name}.json.gz", "wt", encoding="utf-8") as out:
            json.dump(content, out)
    found = readers.read_json_array(spark, str(tmp_path), SCHEMA, ordinal=True)
    assert rows(found.select("ord", "n")) == sorted(((i, i) for i in range(21)), key=repr)


WHOLE = '[{"n": 1, "t": "a}"}, {"n": 2, "o": {"b": {"c": "x"}}}]'


BAD = [
    *[WHOLE[:i] for i in (1, 2, 12, 18, 20, 22, 40, 52, 53, 54)],
    " \n", '{"n": 1', '{"n": 1}{"n": 2}', '{"n": 1}, {"n": 2}', '{"n": 1}]', WHOLE + "x", WHOLE + "]", WHOLE + "}",
    '[{"n": 1} {"n": 2}]', '[{"n": 1}, 7]', '[null, {"n": 1}]', "[7]", "7", '[[{"n": 1}]]', '[{"n": 1},]',
    '[{"n": 1]}', '[{"n": 1}}]', '[{"n" 1}]', '[,{"n": 1}]', '["{}"]', '[{"n": 1}, "}"]', "[]]", "[][]", "]",
]


def test_damaged_files_are_seen(spark, tmp_path, small_splits, monkeypatch):
    for i, text in enumerate([WHOLE, *BAD]):
        (tmp_path / f"{i}.json").write_text(text)
    # All faults at once: they do not end the read.
    monkeypatch.setattr(json_arrays, "_unless", lambda fault, keep=True: F.lit(keep) if keep is True else keep)
    pieces = store(json_arrays._pieces(spark, str(tmp_path)), "pieces")
    starts = store(json_arrays._split_starts(pieces), "starts")
    by_piece = spark.sql(json_arrays._RECORDS, pieces=pieces, starts=starts).where("fault").select("file")
    texts = json_arrays._record_texts(pieces, starts)
    by_text = json_arrays._parsed(texts, SCHEMA).where(~F.col("sound")).select("file")
    seen = {int(r.file.split("/")[-1][:-5]) for r in by_piece.union(by_text).distinct().collect()}
    assert seen == set(range(1, len(BAD) + 1))


@pytest.mark.parametrize("text,whole", [(WHOLE[:40], 0), ('[{"n" 1}]', 0), (WHOLE[:40], 1000)])
def test_damaged_files_fail_by_name(spark, tmp_path, text, whole):
    (tmp_path / "good.json").write_text(WHOLE)
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match=r"no JSON array of records: \S+bad\.json"):
        json_arrays.json_records(spark, str(tmp_path), SCHEMA, whole_bytes=whole).collect()
