import brute
import corpus_pipeline
import pytest
from newsloom.llm import quality_rules as q
from llm_fixtures import documents, sample  # noqa: F401

PROSE = "It was a fine day and the old harbour lay still under the sun while boats went out"
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, PROSE), (4, PROSE), (5, " ".join(["again and again we go"] * 9)),
    (6, "A B C " * 30), (7, "a | b | c | d | e | f | g"), (8, ("é" * 30 + " ") * 12), (None, PROSE),
    (9, "\n".join([PROSE] + ["same line here"] * 9)), (10, "LOUD WORDS!! " + PROSE.upper()), (11, PROSE + " " + "x" * 200_000),
    (12, " ".join(f"w{i}" for i in range(60_000))), (13, "one two three four five six one two three four five seven"),
]


def test_signals_and_verdict_agree_with_brute_force(documents, sample):
    for table in (documents(*EDGES), sample):
        found = q.judge(table).select("text", *q.judge(table).columns[-7:]).collect()
        assert len(found) == table.count()
        for row in found:
            assert tuple(row)[1:7] == brute.quality(row[0])
            assert row.kept == brute.good(row[0])


def test_keep_good_keeps_rows_and_columns(documents):
    table = documents(*EDGES).selectExpr("*", "1 AS kept", "2 AS rule", "text AS words")
    kept = q.keep_good(table)
    assert kept.schema == table.schema
    want = sorted([tuple(r) for r in table.collect() if brute.good(r.text)], key=repr)
    assert sorted([tuple(r) for r in kept.collect()], key=repr) == want
    assert len(want) == 4


CLEAN = [
    "Shares of Acme rose 4% to $31 on Tuesday after quarterly profit grew 12% on strong sales in Europe.",
    "Tea $4\nCoffee $5\nCake $6\nSoup $7\nBread $2\nButter $3\nJuice $4\nSalad $8\nPie $6",
    "# Setting up\n\n* Install the **package** first\n* Open the file & read it\n\n| name | use |\n|------|-----|\n| a | first letter |\n| b | second letter |",
    "def area(width, height):\n    # both in metres\n    if width < 0 or height < 0:\n        raise ValueError('below zero')\n    return width * height",
    "今天天气很好，我们一家人去公园散步，孩子们在草地上放风筝，老人们坐在树下聊天。",
    "昨日は天気がよかったので、友人と一緒に海辺を歩き、夕方には小さな店でゆっくり食事をした。",
    "วันนี้อากาศดีมากเราจึงไปเดินเล่นที่สวนสาธารณะกับเพื่อนและครอบครัว",
]
JUNK = [
    "Th%%% reing### ern*** whl&&& in%%% th$$$ ha&&& inn### oure$$$ er*** stb%%% the###",
    "a | b | c | d | e | f | g | h | i | j | k | l | m", "今天", "x" * 900 + " one two three four five six seven eight nine ten",
]


def test_pipeline_keeps_clean_texts_and_drops_junk(spark, documents):
    table = documents(*enumerate(CLEAN + JUNK))
    kept = {r.text for r in corpus_pipeline.quality(spark, table, "").collect()}
    assert kept == set(CLEAN)
    assert [brute.good(text, pipeline=True) for text in CLEAN + JUNK] == [True] * len(CLEAN) + [False] * len(JUNK)
    # In the query few words fail the base, whatever their script.
    kept = {r.text for r in q.judge(table).where("kept").collect()}
    assert kept == {text for text in CLEAN if brute.good(text)} == set(CLEAN[:4])


def test_added_columns_clash_with_none(documents):
    table = documents(*EDGES).selectExpr("*", "'mine' AS kept", "3 AS n_words")
    found = q.judge(table)
    assert {"kept", "_kept", "n_words", "_n_words", "base_failed"} <= set(found.columns)
    assert {r.kept for r in found.collect()} == {"mine"}


def test_empty_table(documents):
    assert q.judge(documents(*EDGES).limit(0)).count() == 0
    assert q.keep_good(documents(*EDGES).limit(0)).count() == 0


def test_rules_go_by_rejections_per_cost(documents):
    def slow(text):
        return sum(range(20_000)) < 0

    rules = [q.Rule("slow", slow), q.Rule("never", lambda t: False), q.Rule("often", lambda t: t.n_words < 50)]
    order = q.order_rules(documents(*[(i, PROSE) for i in range(50)]), rules)
    assert order[0].name == "often"


def test_cascade_stops_at_the_first_rejection():
    asked = []

    def rule(name, verdict):
        return q.Rule(name, lambda t: (asked.append(name), verdict)[1])

    assert not q._passes(q.Text(b"x"), [rule("a", False), rule("b", True), rule("c", True)])
    assert asked == ["a", "b"]


@pytest.mark.parametrize("text", [b"a b c d e a b c d e", b"x x x x x x x", b"a b c d e f a b c d e", b""])
def test_repeated_windows(text):
    assert q.Text(text).n_repeat_words == brute.quality(text.decode())[4]
