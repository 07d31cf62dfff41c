from collections import Counter

import __spark_entry__ as entry
import brute
import corpus_pipeline
import pytest
from llm_fixtures import db  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _deduplicated(rows):
    prints = {i: brute.simhash(r.text) for i, r in enumerate(rows)}
    root = brute.classes(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    first = {}
    for i, r in enumerate(rows):
        first[root[i]] = min(first.get(root[i], i), i, key=lambda k: rows[k].doc_id)
    return [rows[i] for i in first.values()]


def test_stages_agree_with_brute_force(spark, tmp_path):
    """Each stage is compared on its own input, over a whole table."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "SimHash near-dedup", "PII", "mixing sources to target weights", "best-fit packing"]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        if k < 4:
            assert docs.columns == COLUMNS
        if k == 0:
            assert sorted(after) == sorted(r for r in before if brute.good(r.text, pipeline=True))
        if k == 1:
            assert sorted(after) == sorted(_deduplicated(before))
        if k == 2:
            terms = brute.disclosing([r.text for r in before])
            assert {r.doc_id: r.text for r in after} == {r.doc_id: brute.cleaned(r.text, t) for r, t in zip(before, terms, strict=True)}
        if k == 3:
            want = brute.mixed([(r.doc_id, r.source, r.text) for r in before])
            words = Counter()
            for r in after:
                words[r.doc_id] += len(brute.words(r.text))
            assert words == Counter({before[i].doc_id: n for i, (*_, n) in want.items() if n})
        if k == 4:
            words = Counter()
            for r in before:
                words[r.doc_id] += len(brute.words(r.text))
            found = Counter()
            for r in after:
                for i, n in zip(r.doc_ids, r.words, strict=True):
                    found[i] += n
            assert found == +words


def test_quality_stage_at_a_larger_scale(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, "").select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.collect() if brute.good(r.text, pipeline=True)}


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_odd_rows_pass_all_stages(spark):
    rows = [
        (None, "a fine text of ten words or so with no end to it", "en", None, None), (1, None, None, "s", 0), (1, None, None, "s", 0), (2, "", "en", "s", 0),
        (3, "w%d " * 3 + "some other text of ten words that is quite fine", None, "t", 5), (4, " ".join(f"word{i}" for i in range(9000)), "en", "t", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "'x' AS uid", "'y' AS fp", "'z' AS taken", "1 AS digest", "2 AS terms"
    )
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:4]:
            table = stage(spark, table, "")
            assert table.columns == docs.columns
        assert corpus_pipeline.STAGES[4][1](spark, table, "").count() >= 0


@pytest.mark.parametrize("name", sorted(entry.LLM_ORACLES))
def test_queries_agree_with_sql(spark, db, name):
    df = entry.queries()[name](spark, "/root/testdata/sf0.001")
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)

    def plain(names, data):
        order = sorted(range(len(names)), key=lambda i: names[i])
        return sorted(repr([round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order]) for r in data)

    assert plain(df.columns, [tuple(r) for r in df.collect()]) == plain(columns, cursor.fetchall())


def test_every_operator_has_a_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
