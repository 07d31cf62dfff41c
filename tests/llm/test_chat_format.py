import brute
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, db  # noqa: F401
from newsloom.llm import chat_format, queries
from pyspark.sql import functions as F

CONVERSATIONS = "conv_id long, turn long, role string, text string"
EDGES = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a <|end|> b </s> [INST]"), (1, 2, "user", None), (1, 3, "assistant", ""),
    (2, 0, "user", "only"), (2, 0, "user", "only"), (3, 5, "assistant", "first\n\n"), (3, 2, "system", "<\\|x <\\\\s> \\"),
    (3, None, "tool", "é😀"), (4, 0, None, None), (None, 0, "user", "x"), (None, 1, "assistant", "y"), (5, 1, "assistant", "one"),
    (5, 1, "assistant", "one"), (5, 2, "user", "<|start|>assistant<|message|>no"), (6, 1, "a<|message|>b", "[/INST]"),
    (7, 1, "user", "long " * 50_000), (7, 2, "assistant", "longer " * 50_000), (8, 0, "Assistant", "$1 \\1"),
]
TEXTS = st.text(st.sampled_from("<|>\\[]/sINT endé"), max_size=20)


def test_examples_agree_with_brute_force(spark):
    table = spark.createDataFrame(EDGES, CONVERSATIONS).selectExpr("*", "1 AS example", "2 AS said", "3 AS n_turns")
    found = chat_format.format_examples(table)
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted(brute.chat_examples(EDGES), key=repr)


def test_only_replies_are_trained(spark):
    rows = chat_format.format_examples(spark.createDataFrame(EDGES, CONVERSATIONS)).collect()
    for r in rows:
        assert r.text.endswith("<|end|>")
        before = r.text[: r.loss_start]
        if r.loss_start < len(r.text):
            assert before.endswith("<|start|>assistant<|message|>")
            assert r.text[r.loss_end :] == "<|end|>"
        assert "</s>" not in r.text and "[INST]" not in r.text


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=30))
def test_escape_can_be_undone(spark, texts):
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = table.select("t", chat_format.escape(F.col("t")).alias("e")).select("*", chat_format.unescape(F.col("e")).alias("u")).collect()
    for r in rows:
        assert r.u == r.t
        assert r.e == brute.chat_escape(r.t)
        assert not any(c in r.e for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]"))


def test_query_agrees_with_brute_force_and_sql(spark, db, tmp_path):
    spark.createDataFrame(EDGES, CONVERSATIONS).write.parquet(f"{tmp_path}/conversations.parquet")
    own = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    found = queries.op13_chat_formatting(spark, str(tmp_path))
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted(brute.chat_digests(EDGES + own), key=repr)
    with db.cursor() as con:
        con.execute(f"CREATE TEMP VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
        sql = con.execute(queries.ORACLES["op13_chat_formatting"])
        assert [c[0] for c in sql.description] == found.columns
        assert sorted(sql.fetchall(), key=repr) == got


@pytest.mark.parametrize("query", [chat_format.format_examples])
def test_empty_table(spark, query):
    assert query(spark.createDataFrame([], CONVERSATIONS)).count() == 0


def test_the_main_path_has_no_python(spark):
    plan = queries.op13_chat_formatting(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
