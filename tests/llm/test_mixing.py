from collections import Counter

import brute
import pytest
from newsloom.llm import mixing
from llm_fixtures import documents, sample  # noqa: F401

ROWS = [
    (1, "a b c", "x"), (2, "d e", "x"), (3, None, "x"), (4, "", "y"), (5, " \n ", "y"), (6, "f " * 50, None), (6, "f " * 50, None),
    (7, "g h\ti\nj  k", "Z"), (8, "l " * 9, ""), (9, "m " * 400, "hot"), (10, "n " * 300, "hot"), (11, "o p q r", "é"), (None, "s t u", "é"),
]


def test_taken_agrees_with_brute_force(documents, sample):
    small = documents(*ROWS)
    for table in (small, sample, small.limit(0), documents((1, None, "a"), (2, "", None))):
        rows = [(r.doc_id, r.source, r.text) for r in table.collect()]
        want = brute.mixed(rows)
        found, expected = Counter(), Counter()
        for r in mixing.mixed_words(table.selectExpr("*", "1 AS size", "'t' AS taken")).collect():
            assert r.taken <= 3 * r.size
            found[r.doc_id, r.size, r.source_size, round(r.target, 6)] += r.taken
        for i, (size, total, target, taken) in want.items():
            expected[rows[i][0], size, total, round(target, 6)] += taken
        assert found == expected


def test_targets(spark):
    sizes = spark.createDataFrame([("b", 100), (None, 10), ("a", 1000), ("", 0)], "source string, source_size long")
    found = {r.source: (r.weight, r.target) for r in mixing.source_targets(sizes).collect()}
    # In order: "", a, b, null. Only null's share, 5 of 13, is above its cap, and "" takes none.
    assert found[""] == (5, 0.0) and found[None] == (5, 30.0) and found["b"] == (1, 300.0)
    assert found["a"] == (2, 1110 - 330.0)


@pytest.mark.parametrize("partitions", [1, 5])
def test_mix_takes_the_words_it_says(documents, partitions):
    table = documents(*ROWS).repartition(partitions).selectExpr("*", "'u' AS uid", "'c' AS copy", "'t' AS taken", "1 AS size")
    mixed = mixing.mix(table)
    assert mixed.dtypes == table.dtypes
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(brute.words(r.text))
        assert (r.uid, r.copy, r.taken) == ("u", "c", "t")
        full = [t for i, t, _ in ROWS if i == r.doc_id]
        assert any(t.startswith(r.text) for t in full)
    taken = Counter()
    for r in mixing.mixed_words(table).collect():
        taken[r.doc_id] += r.taken
    assert words == +taken


def test_hot_source_over_many_tasks(spark):
    rows = [(i, "w " * (i % 7), "en", "hot" if i % 3 else f"s{i % 5}", 0) for i in range(3000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    want = brute.mixed([(r[0], r[3], r[1]) for r in rows])
    found = {r.doc_id: [r.size, r.source_size, round(r.target, 6), r.taken] for r in mixing.mixed_words(table).collect()}
    assert found == {i: [a, b, round(c, 6), d] for i, (a, b, c, d) in want.items()}
