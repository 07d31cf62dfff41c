import re

import pytest
from conftest import rows
from newsloom.operators import baselines, phrases, tasks
from pyspark.sql import functions as F

TEXTS = [
    (1, "Rates rise; the Central Bank said: rates rise."),
    (2, "A central, bank"),
    (3, "centralbank rates"),
    (4, None),
    (5, ""),
    (6, "¡Ñandú! y el ñandú"),
    (None, "rates rise again"),
    (7, "rates"),
    (7, "rise, central bank"),
]
KEYWORDS = [
    ("EVA", "central bank"),
    ("EVA", "Central-Bank!"),
    ("EVA", "rates"),
    ("LUC", "rates rise the central bank"),
    ("LUC", "ñandú"),
    ("LUC", " ... "),
    ("LUC", None),
    (None, "rates"),
]


def plain(texts, keywords):
    def words(text):
        return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]

    found = {}
    for persona, keyword in keywords:
        phrase = words(keyword)
        for key, text in texts:
            own = words(text)
            if persona and phrase and any(own[i : i + len(phrase)] == phrase for i in range(len(own))):
                found.setdefault((key, persona), set()).add(tuple(phrase))
    return sorted([(*k, len(v)) for k, v in found.items()], key=repr)


@pytest.fixture
def frames(spark):
    texts = spark.createDataFrame(TEXTS, "phrase long, text string").withColumn("persona", F.lit("other"))
    return texts, spark.createDataFrame(KEYWORDS, "persona string, keyword string")


@pytest.mark.parametrize("most", ["10m", "-1"])
def test_hits_equal_plain_ones(spark, frames, most):
    """Also where keywords are too many for a broadcast; columns may have the operator's names."""
    texts, keywords = frames
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    try:
        assert rows(phrases.phrase_hits(texts, keywords, "phrase", "text")) == plain(TEXTS, KEYWORDS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_tables(frames):
    texts, keywords = frames
    assert phrases.phrase_hits(texts, keywords.limit(0), "phrase", "text").count() == 0
    assert phrases.phrase_hits(texts.limit(0), keywords, "phrase", "text").count() == 0


def test_many_keywords_plan_no_cross_join(spark, frames):
    texts, _ = frames
    many = spark.range(100_000).select(F.lit("EVA").alias("persona"), F.concat(F.lit("word "), F.col("id")).alias("keyword"))
    with_one = many.union(spark.createDataFrame([("EVA", "rates rise")], "persona string, keyword string"))
    hits = phrases.phrase_hits(texts, with_one, "phrase", "text")
    assert sorted((r[0] for r in hits.collect()), key=repr) == [1, None]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_predictor_equals_the_one_by_lists(spark):
    lists = {"EVA": ["central bank", "rates"], "LUC": ["rates rise", "ñandú"], "ANA": []}
    table = spark.createDataFrame([(p, k) for p, ks in lists.items() for k in ks], "persona string, keyword string")
    body = F.to_json(
        F.struct(F.lit("News").alias("article_title"), F.col("text").alias("article_info"),
                 F.when(F.col("id") > 3, "en").alias("article_language"))
    )
    texts = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(TEXTS)], "id int, text string")
    people = [(p, "") for p in lists]
    requests = tasks.build_requests(
        texts, tasks.relevance_task("m", people), F.lit("RUNID_1"), F.col("id").cast("string"), body
    )
    one = baselines.relevance_predictor(lists)(requests, ["user_content"])
    other = baselines.phrase_relevance_predictor(table, list(lists))(requests, ["user_content"])
    assert one.columns == other.columns and rows(one) == rows(other)


def test_only_runs_that_may_be_keywords_leave_a_task(spark, monkeypatch):
    """Of some 60,000 runs; texts are cut in small pieces, and lie in slices of batches."""
    monkeypatch.setattr(phrases, "TEXT_BYTES", 100)
    texts = [(i, " ".join(f"w{(i * 31 + j * j) % 997}é" for j in range(i % 150))) for i in range(300)]
    words = [t.split() for _, t in texts]
    keywords = [("P", " ".join(w[3 : 3 + n])) for n in (1, 2, 5) for w in words[40:60]] + [("Q", "none such"), ("Q", "W5É")]
    frame = spark.createDataFrame(texts, "id long, text string")
    table = spark.createDataFrame(keywords, "persona string, keyword string")
    assert rows(phrases.phrase_hits(frame, table, "id", "text")) == plain(texts, keywords)
    clean = frame.select(F.col("id").alias("__key"), phrases.clean_text(F.col("text")).alias("__clean"))
    left = rows(phrases._candidates(clean, [1, 2, 5], phrases._bloom(phrases.phrase_table(table))))
    known = {k.lower() for _, k in keywords}
    assert len(left) == len(set(left)) and len(left) < 20_000
    assert sum(p not in known for _, p in left) <= 5
