import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from newsloom.operators import baselines, tasks

PEOPLE = [("ANA", "data"), ("LUC", "brands")]


def responses(spark, data):
    return spark.createDataFrame(data, tasks.RESPONSE)


@pytest.mark.parametrize(
    "task", [tasks.link_task("m"), tasks.relevance_task("m", PEOPLE), tasks.validity_task("m"), tasks.summary_task("m")]
)
def test_request_lines(spark, task):
    items = spark.createDataFrame([("a", 'line "1"\nline 2')], "id string, text string")
    requests = tasks.build_requests(items, task, F.lit("R1"), F.col("id"), F.col("text"))
    line = json.loads(requests.select(tasks.request_json(task).alias("j")).first()["j"])
    assert line["custom_id"] == f"R1--{task.name}--a"
    assert (line["method"], line["url"]) == ("POST", "/chat/completions")
    system, user = line["body"]["messages"]
    assert (system["role"], user["role"]) == ("system", "user")
    escaped = task.name in ("source_parsing_v0", "relevance_check_v0")
    assert user["content"] == ('line "1"\\nline 2' if escaped else 'line "1"\nline 2')
    assert ("\n" in system["content"]) == ("\n" in task.system_prompt and not escaped)
    assert line["body"].get("temperature") == (0.0 if task.name == "content_validation_v0" else None)
    wanted = json.loads(task.response_format()) if task.contract else None
    assert line["body"].get("response_format") == wanted


def test_relevance_contract_names_every_persona():
    schema = tasks.relevance_task("m", PEOPLE).contract
    assert schema["required"] == ["ANA", "LUC", "article_language"]
    assert schema["properties"]["ANA"]["enum"] == [0, 1, 2]


def test_round_trip_keeps_every_id(spark):
    items = spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit("text").alias("t")).repartition(7)
    requests = tasks.build_requests(items, tasks.summary_task("m"), F.lit("R1"), F.col("id"), F.col("t"))
    echo = tasks.python_predictor(lambda: lambda batch: [r["custom_id"] for r in batch])
    good, rejected = tasks.parse_summaries(echo(requests))
    assert rejected.count() == 0
    found = good.collect()
    assert sorted(int(r["article_id"]) for r in found) == list(range(500))
    assert all(r["summary"] == f"R1--article_summarization_v0--{r['article_id']}" for r in found)


def test_errors_become_rows(spark):
    def factory():
        def answer(batch):
            if any(int(r["user_content"]) % 10 == 3 for r in batch):
                raise RuntimeError("limit")
            return [r["user_content"] for r in batch][: 1 if len(batch) == 1 else None]

        return answer

    items = spark.range(40).select(F.col("id").cast("string").alias("id"))
    requests = tasks.build_requests(items, tasks.summary_task("m"), F.lit("R1"), F.col("id"), F.col("id"))
    good, rejected = tasks.parse_summaries(tasks.python_predictor(factory)(requests))
    assert good.count() == 36
    assert {r["reject_reason"] for r in rejected.collect()} == {"model error: RuntimeError: limit"}
    assert rejected.count() == 4


def test_too_few_answers_are_an_error(spark):
    items = spark.createDataFrame([("a",), ("b",)], "id string").coalesce(1)
    requests = tasks.build_requests(items, tasks.summary_task("m"), F.lit("R1"), F.col("id"), F.col("id"))
    found = tasks.python_predictor(lambda: lambda batch: [])(requests).collect()
    assert {r["error"] for r in found} == {"ValueError: 0 answers to 1 requests"}


def test_relevance_answers(spark):
    good, rejected = tasks.parse_relevance(
        responses(
            spark,
            [
                ("R1--t--a", "m", '{"ANA": 2, "LUC": 0, "article_language": "es"}', None),
                ("R1--t--b--c", "m", '{"ANA": 2, "LUC": 0, "article_language": "es"}', None),
                ("R1--t--d", "m", None, None),
                ("R1--t--e", "m", "not json", None),
                ("R1--t--f", "m", '{"ANA": 2.5, "LUC": 0, "article_language": "es"}', None),
                ("R1--t--g", "m", '{"ANA": 2, "LUC": 0}', None),
                ("R1--t--h", "m", None, "timeout"),
            ],
        ),
        ["ANA", "LUC"],
    )
    assert rows(good) == [("m", "R1", "t", "a", {"ANA": 2, "LUC": 0}, "es")]
    assert {r["custom_id"][-1]: r["reject_reason"] for r in rejected.collect()} == {
        "c": "bad custom_id",
        "d": "content is not JSON",
        "e": "content is not JSON",
        "f": "score out of range",
        "g": "unknown language",
        "h": "model error: timeout",
    }


def test_link_answers(spark):
    links = '{"article_links_list": [{"title": "T", "url": "u", "keywords": ["k"], "language": "es"}, {"url": "v"}]}'
    good, rejected = tasks.parse_links(
        responses(
            spark,
            [("R1--t--s", "m", links, None), ("R1--t--e", "m", None, None), ("R1--t--x", "m", "{", None),
             ("R1--t--n", "m", '{"article_links_list": []}', None)],
        )
    )
    found = [(r["source_name"], r["link_no"], r["article_title"], r["article_url"], r["article_keywords"]) for r in good.collect()]
    assert sorted(found) == [("s", 0, "T", "u", ["k"]), ("s", 1, "", "v", [])]
    assert [r["custom_id"] for r in rejected.collect()] == ["R1--t--x"]


def test_validity_answers(spark):
    good, rejected = tasks.parse_validity(
        responses(
            spark,
            [("R1--t--a", "m", '{"validity": false}', None), ("R1--t--b", "m", '{"validity": null}', None),
             ("R1--t--c", "m", "{}", None), ("R1--t--d", "m", '{"validity": true}', None)],
        )
    )
    assert rows(good) == [("R1", "a", False), ("R1", "d", True)]
    assert rejected.count() == 2


def test_envelopes_without_choices(spark):
    df = spark.createDataFrame(
        [("k", ((("m", [(("text",),)])),)), ("n", (("m", []),)), ("o", (("m", None),)), ("p", None)],
        "custom_id string, response struct<body: struct<model: string, "
        "choices: array<struct<message: struct<content: string>>>>>",
    )
    assert rows(tasks.flatten_envelope(df).select("custom_id", "content")) == [
        ("k", "text"), ("n", None), ("o", None), ("p", None),
    ]


def test_saved_bodies(spark):
    batches = spark.createDataFrame(
        [("a", "completed", "x\n", "e"), ("b", "completed", " ", None), ("c", "running", "y", "f")],
        "batch_id string, status string, output string, error string",
    )
    outputs, errors = tasks.split_saved(batches)
    assert (rows(outputs), rows(errors)) == ([("a", "x")], [("a", "e")])


def test_embed_calls(spark):
    """A call gets all texts of its chunk, also across Arrow batches; errors are rows."""

    def factory():
        def embed(texts):
            if "bad" in texts and len(texts) == 1:
                raise ValueError("bad text")
            if "bad" in texts:
                raise ValueError("bad call")
            return [[float(len(texts))] for _ in texts]

        return embed

    data = [(f"R{i % 2}", i // 50, f"a{i:03d}", "bad" if i == 7 else "text") for i in range(300)]
    df = spark.createDataFrame(data, "run_id string, chunk_no int, article_id string, summary string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        found = {r["article_id"]: r for r in tasks.embed_calls(df, factory, "m").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == 300
    assert found["a007"]["error"] == "ValueError: bad text"
    # The other texts of that call are embedded in the halves that hold no bad one.
    assert all(r["summary_embedding"] for i, r in found.items() if i != "a007")
    assert found["a008"]["summary_embedding"] == [25.0]


def test_baseline_answers_keep_the_contract(spark):
    articles = spark.createDataFrame(
        [("a", '{"article_title": "Datos", "article_info": "inteligencia artificial", "article_language": "ca"}'),
         ("b", '{"article_title": null}')],
        "id string, j string",
    )
    words = {"ANA": ["datos", "inteligencia artificial"], "LUC": ["marca"]}
    requests = tasks.build_requests(
        articles, tasks.relevance_task("m", PEOPLE), F.lit("R1"), F.col("id"), F.col("j")
    )
    good, rejected = tasks.parse_relevance(baselines.relevance_predictor(words)(requests), ["ANA", "LUC"])
    assert rejected.count() == 0
    assert {r["article_id"]: (r["relevance"], r["article_language"]) for r in good.collect()} == {
        "a": ({"ANA": 2, "LUC": 0}, "ca"), "b": ({"ANA": 0, "LUC": 0}, "es"),
    }
