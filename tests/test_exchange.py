"""Requests out as files, answers in as files."""

import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_curation import BODY, KEYWORDS, NAMES, PERSONAS, land, page

from newsloom import schemas
from newsloom.catalog import QUERIES
from newsloom.catalog import exchange as exchange_queries
from newsloom.operators import tasks
from newsloom.plans import curation
from newsloom.plans import exchange as exchange_plan
from newsloom.plans.exchange import Exchange, Waiting
from newsloom.sources import writers

TASK = tasks.summary_task("m1")


@pytest.fixture
def exchange(spark, tmp_path):
    return Exchange(spark, str(tmp_path / "exchange"), "R1", TASK)


def asked(spark, *items):
    frame = spark.createDataFrame(items, "id string, text string")
    return tasks.build_requests(frame, TASK, F.lit("R1"), F.col("id"), F.col("text"), "text")


def drop(exchange, name, *lines):
    """An answer file, put there as a vendor would."""
    os.makedirs(exchange.folder("answers"), exist_ok=True)
    with open(f"{exchange.folder('answers')}/{name}.jsonl", "w", encoding="utf-8") as f:
        f.writelines((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines)


def said(item, content, **more):
    body = {"model": "m2", "choices": [{"message": {"content": content}}]}
    return {"custom_id": f"R1--{TASK.name}--{item}", "response": {"body": body}, **more}


def request_files(exchange):
    lines = exchange.spark.read.text(exchange.folder("requests"))
    return sorted((r.batch_no, json.loads(r.value)["custom_id"].split("--")[2]) for r in lines.collect())


def test_waits_until_every_answer_is_there(spark, exchange):
    requests = asked(spark, ("a", "one"), ("b", "two"), ("c", "three"))
    with pytest.raises(Waiting) as first:
        exchange(requests)
    assert first.value.wait_time == 120
    drop(exchange, "1", said("a", "x"), "not json", "", said("elsewhere", "x"))
    with pytest.raises(Waiting):
        exchange(requests)
    error = {"custom_id": f"R1--{TASK.name}--c", "response": None, "error": {"code": "429", "message": "limit"}}
    drop(exchange, "2", said("b", "early"), error, said("b", "late"))
    found = rows(exchange(requests, ["text"]))
    assert found == [
        (f"R1--{TASK.name}--a", "m2", "x", None, "one"), (f"R1--{TASK.name}--b", "m2", "late", None, "two"),
        (f"R1--{TASK.name}--c", "m1", None, "error: 429: limit", "three"),
    ]
    # Asked again, nothing goes out and the answers are the same.
    assert rows(exchange(requests, ["text"])) == found
    assert request_files(exchange) == [(0, "a"), (0, "b"), (0, "c")]
    damaged = spark.read.parquet(f"{exchange.folder('taken')}/damaged")
    assert [r.value for r in damaged.collect()] == ["not json"]


def test_changed_requests_go_out_again(spark, exchange):
    with pytest.raises(Waiting):
        exchange(asked(spark, ("a", "one"), ("b", "two")))
    drop(exchange, "1", said("a", "to one"), said("b", "to two"))
    changed = asked(spark, ("a", "one"), ("b", "other"), ("c", "new"))
    with pytest.raises(Waiting):
        exchange(changed)
    assert request_files(exchange) == [(0, "a"), (0, "b"), (1, "b"), (1, "c")]
    drop(exchange, "2", said("b", "to other"), said("c", "to new"))
    assert [r[2] for r in rows(exchange(changed))] == ["to one", "to other", "to new"]
    # Fewer requests need fewer answers.
    assert [r[2] for r in rows(exchange(asked(spark, ("c", "new"))))] == ["to new"]


def test_texts_are_not_stored_and_stay_while_nothing_goes_out(spark, exchange, monkeypatch):
    """Neither the requests nor their lines are stored aside, and a later poll has only digests."""
    stored = []
    whole = exchange_plan.store
    monkeypatch.setattr(exchange_plan, "store", lambda df, label: (stored.append((label, df.columns)), whole(df, label))[1])
    requests = asked(spark, *[(f"{i:04d}", f"text {i}") for i in range(450)])
    for _ in range(2):
        with pytest.raises(Waiting):
            exchange(requests)
    assert [label for label, _ in stored] == ["asked", "unsent", "batched", "answers", "asked", "unsent", "answers"]
    assert not {"line", "user_content", "system_content"} & {c for _, columns in stored for c in columns}
    assert request_files(exchange) == [(i // 200, f"{i:04d}") for i in range(450)]
    folders = [f"{exchange.folder('requests')}/batch_no={b}" for b in range(3)]
    assert [sum(n.startswith("part") for n in os.listdir(f)) for f in folders] == [1, 1, 1]


@pytest.fixture
def no_broadcasts(spark):
    """Tables meet as large ones do."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_batch_is_one_file_in_order_of_its_requests(spark, exchange, no_broadcasts):
    ids = [f"{i:04d}" for i in range(1900)]
    with pytest.raises(Waiting):
        exchange(asked(spark, *[(i, f"text {i}") for i in reversed(ids)]))
    found = []
    for batch in range(10):
        folder = f"{exchange.folder('requests')}/batch_no={batch}"
        [name] = [n for n in os.listdir(folder) if n.startswith("part")]
        with open(f"{folder}/{name}", encoding="utf-8") as f:
            found.append([json.loads(line)["custom_id"].split("--")[2] for line in f])
    assert found == [ids[i : i + 200] for i in range(0, 1900, 200)]


@pytest.mark.parametrize("name, n_batches", [("waiting_batches", [3]), ("resumed_run", [3, 3])])
def test_queries_write_a_file_per_batch(spark, tmp_path, no_broadcasts, monkeypatch, name, n_batches):
    """As many batches per task as `n_batches` has."""
    documents = [(i, f"text {i} " * 100, ("en", "fr", "de")[i % 3]) for i in range(450)]
    spark.createDataFrame(documents, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(exchange_queries, "scratch_path", lambda spark, label: str(tmp_path / label))
    assert QUERIES[name](spark, str(tmp_path)).count() > 0
    files = {}
    for folder, _, names in os.walk(tmp_path):
        if "/requests/" in folder and "batch_no=" in folder:
            files.setdefault(os.path.dirname(folder), []).append(sum(n.startswith("part") for n in names))
    assert sorted(files.values()) == [[1] * n for n in n_batches]


def test_only_what_is_new_goes_out_of_many(spark, exchange, no_broadcasts):
    first = [(f"{i:04d}", "text") for i in range(450)]
    with pytest.raises(Waiting):
        exchange(asked(spark, *first))
    changed = [(i, "other" if int(i) % 2 else text) for i, text in first]
    with pytest.raises(Waiting):
        exchange(asked(spark, *changed, ("0450", "new")))
    odd = [i for i, text in changed if text == "other"]
    assert request_files(exchange) == sorted(
        [(n // 200, i) for n, (i, _) in enumerate(first)] + [(3 + n // 200, i) for n, i in enumerate([*odd, "0450"])]
    )


def test_requests_that_change_while_they_are_sent(spark, exchange):
    requests = asked(spark, ("a", "one"), ("b", "two"))
    digests = requests.select("custom_id", exchange.digest())
    exchange.poll()
    with pytest.raises(RuntimeError, match="changed"):
        exchange.send(asked(spark, ("a", "one"), ("b", "other")), digests)


def test_batches_that_ended(spark, exchange):
    requests = asked(spark, ("a", "one"), ("b", "two"))
    with pytest.raises(Waiting):
        exchange(requests)
    drop(exchange, "1", {"batch_no": 0, "status": "in_progress"})
    with pytest.raises(Waiting):
        exchange(requests)
    drop(exchange, "2", said("b", "x"), {"batch_no": 0, "status": "expired"})
    assert [r[2:] for r in rows(exchange(requests))] == [(None, "batch expired"), ("x", None)]


def test_nothing_but_errors_ends_the_step(spark, exchange):
    requests = asked(spark, ("a", "one"))
    with pytest.raises(Waiting):
        exchange(requests)
    drop(exchange, "1", {"batch_no": 0, "status": "failed"})
    with pytest.raises(RuntimeError):
        exchange(requests)


def test_no_requests_need_no_answers(spark, exchange):
    assert exchange(asked(spark, ("a", "x")).limit(0), ["text"]).collect() == []
    assert not os.path.exists(exchange.folder("requests"))


def test_a_send_that_failed_is_done_again(spark, exchange, monkeypatch):
    requests = asked(spark, ("a", "one"), ("b", "two"))

    def fail(*args, **kw):
        writers.write_request_files(*args, **kw)
        raise OSError("driver lost")

    monkeypatch.setattr("newsloom.plans.exchange.write_request_files", fail)
    with pytest.raises(OSError):
        exchange(requests)
    monkeypatch.undo()
    with pytest.raises(Waiting):
        exchange(requests)
    assert request_files(exchange) == [(0, "a"), (0, "b")]


def test_a_run_waits_for_files(spark, tmp_path):
    """A run on files ends as waiting at each model step, and gives what the models in the process give."""
    found = {}
    for kind in ("files", "process"):
        ws = curation.Workspace(spark, str(tmp_path / kind))
        pages = [(f"https://a.com/{i}", f"<article>{BODY}</article>") for i in (1, 2)]
        spark.createDataFrame(pages, "url string, html string").write.parquet(ws.location("article_pages"))
        land(ws, "RUNID_1", [("site", page([("Datos e inteligencia", "https://a.com/1"), ("Marca y publicidad", "https://a.com/2"), ("Deporte", "https://a.com/3")]))])
        own = curation.baseline_models(PERSONAS, KEYWORDS)
        models = own if kind == "process" else curation.batch_models(ws, "RUNID_1", PERSONAS, "baseline")
        states, resume = [], None
        while not states or states[-1][0] == "waiting":
            status = curation.run_curation(ws, "RUNID_1", NAMES, models, "2025-01-01 00:00:00", resume)
            step, resume = curation.open_step(ws, "RUNID_1"), curation.OPEN
            states.append((status, step))
            if status == "waiting":
                name = {"crawl": "links", "relevance": "relevance", "validity": "validity", "summaries": "summary"}[step]
                exchange, answer = getattr(models, name)[1], getattr(own, name)[1]
                lines = spark.read.json(exchange.folder("requests"))
                requests = lines.select("custom_id", F.lit("m").alias("model"), F.lit("").alias("system_content"), F.col("body.messages")[1]["content"].alias("user_content"))
                drop(exchange, "all", *[
                    {"custom_id": r.custom_id, "response": {"body": {"model": r.model, "choices": [{"message": {"content": r.content}}]}}}
                    for r in answer(requests).collect()
                ])
        found[kind] = rows(ws.read("summaries", schemas.SUMMARIES, "RUNID_1").select("article_id", "summary", "model"))
        if kind == "files":
            assert states == [("waiting", s) for s in ("crawl", "relevance", "validity", "summaries")] + [("success", None)]
    assert len(found["files"]) == 2
    assert found["files"] == found["process"]


def test_a_run_keeps_its_rows_until_the_new_ones_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.replace_run(spark.range(3).withColumn("run_id", F.lit("R1")), path, "R1")
    bad = spark.range(2).select(F.raise_error(F.lit("lost")).cast("long").alias("id"), F.lit("R1").alias("run_id"))
    with pytest.raises(Exception, match="lost"):
        writers.replace_run(bad, path, "R1")
    assert rows(spark.read.schema("id long, run_id string").parquet(path)) == [(i, "R1") for i in range(3)]
    writers.replace_run(spark.range(0).withColumn("run_id", F.lit("R1")), path, "R1")
    assert spark.read.schema("id long, run_id string").parquet(path).count() == 0
