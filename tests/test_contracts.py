import json

import pytest
from newsloom.operators import contracts, tasks
from pyspark.sql import functions as F

LINK = {"title": "t", "url": "u", "keywords": ["k"], "language": "es"}


def links(*entries):
    return json.dumps({"article_links_list": list(entries)})


LINKS = [
    (links(), None),
    (links(LINK, {**LINK, "keywords": []}), None),
    (None, "$: no JSON"),
    ("", "$: no JSON"),
    ('{"article_links_list": [', "$: no JSON"),
    ('{"article_links_list": [], "article_links_list": []}', "$: no JSON"),
    ("[]", "$: no object"),
    ("null", "$: no object"),
    ('"text"', "$: no object"),
    ("{}", "$.article_links_list: missing"),
    ('{"article_links_list": [], "b": 1, "a": 2}', "$.a: unknown key"),
    ('{"article_links_list": {}}', "$.article_links_list: no array"),
    ('{"article_links_list": null}', "$.article_links_list: no array"),
    (links(LINK, 7), "$.article_links_list[1]: no object"),
    (links(LINK, {k: v for k, v in LINK.items() if k != "url"}), "$.article_links_list[1].url: missing"),
    (links({**LINK, "a.b": 1}), "$.article_links_list[0].a.b: unknown key"),
    (links({**LINK, "url": None}), "$.article_links_list[0].url: no string"),
    (links({**LINK, "keywords": ["a", 1]}), "$.article_links_list[0].keywords[1]: no string"),
    (links({**LINK, "title": True}, {}), "$.article_links_list[0].title: no string"),
    (links(LINK) + " rest", None),
]
SCORES = [
    ('{"ANA B": 2, "article_language": "es"}', None),
    ('{"article_language": "es", "ANA B": 0.0}', None),
    ('{"ANA B": 3, "article_language": "es"}', "$.ANA B: unknown value"),
    ('{"ANA B": 1.5, "article_language": "es"}', "$.ANA B: no integer"),
    ('{"ANA B": "2", "article_language": "es"}', "$.ANA B: no integer"),
    ('{"ANA B": 12345678901234567890123, "article_language": "es"}', "$.ANA B: unknown value"),
    ('{"ANA B": 1e300, "article_language": "es"}', "$.ANA B: no integer"),
    ('{"ANA B": 2, "article_language": "fr"}', "$.article_language: unknown value"),
    ('{"ANA B": 2, "article_language": ""}', "$.article_language: unknown value"),
]


@pytest.mark.parametrize(
    "task, cases",
    [
        (tasks.link_task("m"), LINKS),
        (tasks.relevance_task("m", [("ANA B", "")]), SCORES),
        (tasks.validity_task("m"), [('{"validity": true}', None), ('{"validity": "true"}', "$.validity: no boolean"), ('{"validity": 1}', "$.validity: no boolean")]),
    ],
)
def test_faults(spark, task, cases):
    frame = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, content string")
    found = frame.select("i", contracts.contract_fault(F.col("content"), task.contract).alias("fault")).collect()
    assert {r.i: r.fault for r in found} == {i: f for i, (_, f) in enumerate(cases)}


def _answers(spark, *contents):
    rows = [(f"R1--t--{i}", "m", c, None) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "custom_id string, model string, content string, error string")


def test_parsers_with_a_contract(spark):
    contents = [links(LINK), links({"url": "v"}), None, "", "{", '{"article_links_list": [], "more": 1}']
    good, rejected = tasks.parse_links(_answers(spark, *contents), tasks.link_task("m").contract)
    assert [(r.source_name, r.article_url) for r in good.collect()] == [("0", "u")]
    assert {r.custom_id[-1]: r.reject_reason for r in rejected.collect()} == {
        "1": "contract: $.article_links_list[0].title: missing", "4": "content is not JSON", "5": "contract: $.more: unknown key",
    }
    contents = ['{"validity": true}', '{"validity": true, "why": ""}', "{}"]
    good, rejected = tasks.parse_validity(_answers(spark, *contents), tasks.validity_task("m").contract)
    assert [r.article_id for r in good.collect()] == ["0"]
    assert {r.custom_id[-1]: r.reject_reason for r in rejected.collect()} == {"1": "contract: $.why: unknown key", "2": "no verdict"}
