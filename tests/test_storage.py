import json
import os

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.sources import readers, writers
from newsloom.streaming.incremental import dedupe_landing, read_new


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_json_runs_carry_the_run_of_their_name(spark, tmp_path):
    for run in ("RUNID_1", "RUNID_10"):
        write(tmp_path / f"{run}--items.json", json.dumps([{"id": f"{run}-{i}"} for i in range(2)], indent=4))
    found = readers.read_json_runs(spark, str(tmp_path), "id string, extra int")
    assert rows(found.select("RUNID", "id")) == [
        (r, f"{r}-{i}") for r in ("RUNID_1", "RUNID_10") for i in range(2)
    ]


@pytest.mark.parametrize("mark", ["", "﻿"])
def test_json_array_in_order(spark, tmp_path, mark):
    write(tmp_path / "a.json", mark + json.dumps([{"x": "ñ", "n": i} for i in range(5)], ensure_ascii=False))
    plain = readers.read_json_array(spark, str(tmp_path / "a.json"), "x string, n int")
    assert plain.count() == 5 and plain.where("x = 'ñ'").count() == 5
    found = readers.read_json_array(spark, str(tmp_path / "a.json"), "x string, n int", ordinal=True)
    assert rows(found.select("ord", "n")) == [(i, i) for i in range(5)]


def test_missing_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    with pytest.raises(AnalysisException):
        readers.read_table(spark, path, "a string")
    empty = readers.read_table(spark, path, "a string", "RUNID_1", required=False)
    assert empty.columns == ["a", "run_id"] and empty.count() == 0


def test_a_run_is_not_a_prefix(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "RUNID_1"), ("b", "RUNID_10"), ("c", "7")], "id string, run_id string")
    writers.write_run(df, path)
    assert rows(readers.read_table(spark, path, "id string", "RUNID_1")) == [("a", "RUNID_1")]
    assert rows(readers.read_table(spark, path, "id string", "7")) == [("c", "7")]
    plan = readers.read_table(spark, path, "id string", "RUNID_1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_writes_replace_their_run_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_ = "id string, run_id string"
    writers.write_run(spark.createDataFrame([("a", "R1"), ("b", "R2")], rows_), path)
    writers.write_run(spark.createDataFrame([("c", "R1")], rows_), path)
    writers.write_run(spark.createDataFrame([], rows_), path)
    assert rows(readers.read_table(spark, path, "id string")) == [("b", "R2"), ("c", "R1")]


def test_a_run_can_become_empty(spark, tmp_path):
    path, rows_ = str(tmp_path / "t"), "article_id string, run_id string"
    writers.write_run(spark.createDataFrame([("a", "R1"), ("b", "R1"), ("b", "R2")], rows_), path)
    stored = readers.read_table(spark, path, "article_id string")
    verdicts = spark.createDataFrame(
        [("R1", "a", False), ("R1", "b", False)], "run_id string, article_id string, validity boolean"
    )
    writers.delete_invalid(stored, verdicts, path, "R1")
    assert rows(readers.read_table(spark, path, "article_id string")) == [("b", "R2")]
    with pytest.raises(ValueError):
        writers.replace_run(stored, path, "R/1")


def test_bad_response_lines_are_set_aside(spark, tmp_path):
    line = {"custom_id": "R--t--a", "response": {"body": {"model": "m", "choices": [{"message": {"content": "x"}}]}}}
    write(tmp_path / "R--t_OUTPUT_0.jsonl", json.dumps(line) + "\n{broken\n\n")
    write(tmp_path / "R--t_OUTPUT_1.jsonl", json.dumps({**line, "custom_id": "R--t--b", "more": 1}) + "\n")
    other = json.dumps({"custom_id": "R--t--c", "response": "text"})
    write(tmp_path / "R--t_OUTPUT_2.jsonl", other + "\n")
    good, bad = readers.read_responses(spark, str(tmp_path))
    assert [r[0] for r in rows(good.select("custom_id"))] == ["R--t--a", "R--t--b"]
    assert rows(bad) == sorted([("{broken",), (other,)], key=repr)


def test_both_forms_of_relevance(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [("a", {"P": 2}, None, "R"), ("b", {"P": 1}, None, "R"), ("c", None, 2, "R"), ("d", None, 1, "R")],
        "article_id string, relevance map<string,int>, relevance_scalar int, run_id string",
    )
    writers.write_run(df, path)
    found = readers.read_relevant(spark, path, schemas.RELEVANT_ARTICLES)
    assert [r[0] for r in rows(found.select("article_id"))] == ["a", "c"]


def test_post_files_and_log(spark, tmp_path):
    posts = spark.createDataFrame(
        [("ANA", "line 1\nline 2", "T2", "u2"), ("ANA", "c1", "T1", "u1"), ("LUC", "c3", "T3", "u3")],
        "perfil string, copy string, article_title string, article_url string",
    )
    writers.write_posts(posts, str(tmp_path / "p"))
    folder = tmp_path / "p" / "perfil=ANA"
    text = "".join((folder / f).read_text() for f in sorted(os.listdir(folder)) if f.startswith("part"))
    assert text == "Title: T1\nURL: u1\nCopy:\nc1\n\nTitle: T2\nURL: u2\nCopy:\nline 1\nline 2\n\n"
    writers.append_post_log(posts.where("perfil = 'LUC'"), str(tmp_path / "log"))
    logged = [f for f in os.listdir(tmp_path / "log") if f.startswith("part")]
    assert "".join((tmp_path / "log" / f).read_text() for f in logged) == "c3\nu3\n\n"


SEEN = "doc int, run_id string, article_title string, source_name string"


def land(spark, landing, data):
    spark.createDataFrame(data, SEEN).coalesce(1).write.mode("append").parquet(landing)


def kept(spark, out):
    return [r["doc"] for r in read_new(spark, out, SEEN).orderBy("doc").collect()]


@pytest.mark.parametrize("per_batch", [1, 100])
def test_runs_as_they_land(spark, tmp_path, per_batch):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, landing, [(1, "RUNID_9", "a", "s"), (2, "RUNID_9", "a", "s"), (3, "RUNID_9", None, "s")])
    dedupe_landing(spark, landing, SEEN, out, f"{out}/_progress", files_per_batch=per_batch)
    assert kept(spark, out) == [1, 2, 3]
    land(spark, landing, [(4, "RUNID_10", "a", "s"), (5, "RUNID_10", None, "s"), (6, "RUNID_10", None, "t"), (7, "RUNID_10", "b", "s")])
    land(spark, landing, [(8, "RUNID_11", "b", "s"), (9, "RUNID_11", "c", "s"), (10, "RUNID_9", "a", "s")])
    dedupe_landing(spark, landing, SEEN, out, f"{out}/_progress", files_per_batch=per_batch)
    found = kept(spark, out)
    # Row 10 comes late in a run that had its key first, yet run 10 has held it since only
    # if that landed in a batch before.
    assert [d for d in found if d != 10] == [1, 2, 3, 6, 7, 9]
    dedupe_landing(spark, landing, SEEN, out, f"{out}/_progress", files_per_batch=per_batch)
    assert kept(spark, out) == found


def test_a_batch_can_be_run_again(spark, tmp_path):
    """As after a failure between the batch's writes and its commit."""
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    progress = f"{out}/_progress"
    land(spark, landing, [(1, "RUNID_1", "a", "s"), (2, "RUNID_1", None, None)])
    dedupe_landing(spark, landing, SEEN, out, progress)
    land(spark, landing, [(3, "RUNID_2", "a", "s"), (4, "RUNID_2", "b", "s"), (5, "RUNID_2", None, None)])
    dedupe_landing(spark, landing, SEEN, out, progress)
    assert kept(spark, out) == [1, 2, 4]
    for name in ("1", ".1.crc"):
        os.remove(os.path.join(progress, "commits", name))
    dedupe_landing(spark, landing, SEEN, out, progress)
    assert os.path.exists(os.path.join(progress, "commits", "1"))
    assert kept(spark, out) == [1, 2, 4]


def test_a_damaged_array_fails(spark, tmp_path):
    write(tmp_path / "a.json", '[{"x": "a", "n": 1}, {"x": "b", "n"')
    for ordinal in (False, True):
        with pytest.raises(Exception, match="no JSON array"):
            readers.read_json_array(spark, str(tmp_path / "a.json"), "x string, n int", ordinal).collect()


def test_records_of_several_files_are_numbered_in_order(spark, tmp_path):
    for name, start in (("b", 3), ("a", 0)):
        write(tmp_path / f"{name}.json", json.dumps([{"n": start + i} for i in range(3)]))
    write(tmp_path / "c.json", '{"n": 6}')
    write(tmp_path / "d.json", "[]")
    found = readers.read_json_array(spark, str(tmp_path), "n int", ordinal=True)
    assert rows(found.select("ord", "n")) == [(i, i) for i in range(7)]


def test_a_later_poll_leaves_other_batches(spark, tmp_path):
    bodies = "batch_id string, body string"
    for body in ([("b1", '{"custom_id": "x"}')], [("b2", '{"custom_id": "y"}'), ("b3", '{"custom_id": "z"}')], [("b2", '{"custom_id": "w"}')]):
        writers.write_saved_bodies(spark.createDataFrame(body, bodies), spark.createDataFrame([], bodies), str(tmp_path))
    found = readers.read_saved_responses(spark, str(tmp_path)).select("batch_id", "custom_id")
    assert rows(found) == [("b1", "x"), ("b2", "w"), ("b3", "z")]


def test_saved_batches_take_no_folder_each(spark, tmp_path):
    """A poll is one folder, with any number of batches; a null batch is one too."""
    many = spark.range(500).select(F.col("id").cast("string").alias("batch_id"), F.lit("a\nb").alias("body"))
    few = spark.createDataFrame([("3", "c"), (None, "d"), ("4", None)], "batch_id string, body string")
    path = str(tmp_path / "bodies")
    for poll in (many, few, few.where("batch_id IS NULL")):
        writers.write_saved_bodies(poll, many.limit(0), path)
    assert sorted(n for n in os.listdir(f"{path}/output") if n[0] not in "._") == ["poll=0", "poll=1", "poll=2"]
    found = rows(readers.read_saved_lines(spark, path, "output"))
    assert found == sorted([(str(i), x) for i in range(500) if i != 3 for x in "ab"] + [("3", "c"), (None, "d")], key=repr)
    assert readers.read_saved_lines(spark, path, "error").count() == 0


def test_upsert_touches_only_its_runs(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id string, run_id string"
    writers.write_run(spark.createDataFrame([("a", "R1"), ("b", "R2")], schema), path)
    before = sorted(os.listdir(f"{path}/run_id=R2"))
    writers.upsert_run(readers.read_table(spark, path, schema), spark.createDataFrame([("c", "R1")], schema), path, ["id"])
    assert rows(readers.read_table(spark, path, schema)) == [("a", "R1"), ("b", "R2"), ("c", "R1")]
    assert sorted(os.listdir(f"{path}/run_id=R2")) == before


def test_a_run_without_number_ends_the_stream(spark, tmp_path):
    schema = "run_id string, article_title string, source_name string"
    spark.createDataFrame([("first", "t", "s")], schema).write.parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="without a number"):
        dedupe_landing(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "progress"))
