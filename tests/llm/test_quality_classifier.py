import zlib

import brute
import numpy as np
import pytest
from newsloom.llm import quality_classifier as q
from llm_fixtures import documents  # noqa: F401

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = {r.doc_id: r for r in q.score_quality(documents, labels).collect()}
    assert len(found) == documents.count()
    assert all(r.held_out == (brute.fold(i) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in found.items())
    test = [(found[r.doc_id].score, r.quality) for r in labels.collect() if brute.fold(r.doc_id) == 0]
    good, bad = [s for s, y in test if y == 1], [s for s, y in test if y == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.99
    assert np.mean([s >= 0.3 for s in good]) > 0.99
    assert np.mean([(s >= 0.3) == y for s, y in test]) > 0.96


@pytest.fixture
def small(documents):
    rows = [(i, f"fine words about number {i} and the sea") for i in range(40)] + [(i, "SPAM!! " * 20) for i in range(40, 60)]
    return documents(*rows, (60, None), (61, ""), (61, ""), (None, "x " * 50_000), (62, "\x00é" * 9))


def test_edges(spark, small):
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(60)] + [(1, None, 0), (2, 7, 0), (None, 1, 0), (3, 1, 1)], LABELS)
    table = small.selectExpr("*", "1 AS score", "2 AS vector", "3 AS y")
    found = q.score_quality(table, labels).collect()
    assert len(found) == 65
    assert all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert q.score_quality(table.limit(0), labels).count() == 0


def test_scores_do_not_see_labels_of_the_held_out(spark, small):
    def scores(flip):
        rows = [(i, int(i < 40) if brute.fold(i) else int((i < 40) != flip), 0) for i in range(60)]
        return sorted([(r.doc_id, r.score) for r in q.score_quality(small, spark.createDataFrame(rows, LABELS)).collect()], key=repr)

    assert scores(False) == scores(True)


@pytest.mark.parametrize("rows, score", [([], 0.5), ([(1, 1, 0), (2, 1, 0)], 1.0), ([(1, 0, 0)], 0.0)])
def test_labels_of_one_kind(spark, small, rows, score):
    assert {r.score for r in q.score_quality(small, spark.createDataFrame(rows, LABELS)).collect()} == {score}


def test_words_beyond_ascii():
    words = q.Words()
    same = [("word", "\u201cword\u201d", "word\u2014", "WORD"), ("\u00c9cole", "\u00e9cole", "\u00ab\u00e9cole\u00bb"), ("\u0939\u093f\u0902\u0926\u0940", "\u0939\u093f\u0902\u0926\u0940\u0964")]
    for group in same:
        assert len({words[w.encode()] for w in group}) == 1
    assert len({words[group[0].encode()] for group in same}) == 3
    # Words of ASCII signs only have a way of their own, with the same results.
    for word in ("a_B-9!!", "\x7f\x01Ab", "__", "X" * 9, "0x1F", "don't"):
        other = word + "\u2014"
        assert q.cleaned(word.encode()) == q.cleaned(other.encode())
        assert q.shape(q.signs(word.encode()) + "\u2014".encode()) == q.shape(q.signs(other.encode()))
    for word, form in (("\u00c9cole", "Aa"), ("ABC-12!!", "A-9!"), ("a1B", "a9A"), ("\u201cword\u201d", "\u201ca\u201d"), ("\u65e5\u672c\u8a9e", "a")):
        assert q.shape(q.signs(word.encode())) == zlib.crc32(form.encode()) % q.SHAPES


def test_vectors_equal_plain_ones(spark):
    # Of some 40,000 words those that come once have no row of their own.
    rng = np.random.default_rng(4)
    texts = [" ".join(f"W{x}" for x in rng.zipf(1.3, 1000)) for _ in range(40)] + ["one", "", None, "\u201cQu\u00e9\u201d w1 W1!"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    head = q.frequent_words(table)
    want_head, want_table, want = brute.pooled_vectors(texts)
    assert 0 < len(head) < len(set(" ".join(filter(None, texts)).split())) / 2 and head.tolist() == want_head
    assert np.allclose(q.context_vectors(table, head), want_table, atol=1e-6)
    found = {r.doc_id: np.frombuffer(r.v, np.float32) for r in q.Pooling(table).pooled(table, "v").collect()}
    assert len(found) == len(texts)
    for i, v in enumerate(want):
        assert np.allclose(found[i], v, atol=1e-4)


def test_labels_without_a_document_take_no_place(spark, small):
    labels = [(i, int(i < 40), 0) for i in range(60)]
    with_more = labels + [(i, 1, 0) for i in range(1000, 3000)]
    a, b = (
        sorted([(r.doc_id, r.score) for r in q.score_quality(small, spark.createDataFrame(x, LABELS), train_rows=40).collect()], key=repr)
        for x in (labels, with_more)
    )
    assert a == b


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((4000, 5))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    scores = q.Network(x, y).scores(rng.standard_normal((1, 5)).repeat(1, 0))
    assert 0 <= scores[0] <= 1
    scores = q.Network(x, y).scores(x)
    for low in np.arange(0.1, 0.9, 0.2):
        own = (scores >= low) & (scores < low + 0.2)
        assert abs(scores[own].mean() - y[own].mean()) < 0.08
