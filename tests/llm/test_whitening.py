import brute
import numpy as np
import pytest
from llm_fixtures import SF
from newsloom.llm import queries, whitening

KINDS = {
    "random": lambda d: np.random.default_rng(1).standard_normal((d, d)),
    "graded": lambda d: np.random.default_rng(2).standard_normal((d, d)) * 10.0 ** -np.linspace(0, 6, d),
    "low rank": lambda d: np.random.default_rng(3).standard_normal((d, 3)),
    "pairs": lambda d: np.repeat(np.eye(d)[:, ::2], 2, axis=1) * np.arange(1, d + 1)[:, None],
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("d", [1, 2, 3, 16, 64, 200])
def test_components_agree_with_eigh(kind, d):
    a = KINDS[kind](d)
    v = a @ a.T
    values, vectors = whitening.top_components(v, 8)
    want = np.linalg.eigvalsh(v)[::-1][:8]
    assert len(values) == min(8, d)
    np.testing.assert_allclose(values, want, atol=1e-13 * want[0])
    np.testing.assert_allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
    np.testing.assert_allclose(v @ vectors.T, vectors.T * values, atol=1e-12 * want[0])


@pytest.mark.parametrize("v", [np.eye(5), np.zeros((4, 4)), np.diag([1.0, 2.0, 3.0]), np.diag([1.0, 1.0, 1.0, -5.0])])
def test_equal_and_symmetric_eigenvalues(v):
    values, vectors = whitening.top_components(v, 8)
    np.testing.assert_allclose(values, np.linalg.eigvalsh(v)[::-1], atol=1e-14)
    np.testing.assert_allclose(v @ vectors.T, vectors.T * values, atol=1e-14)


def test_polar_factor_of_ill_conditioned():
    q = np.linalg.qr(np.random.default_rng(4).standard_normal((30, 30)))[0]
    signs = np.where(np.arange(30) % 3, 1.0, -1.0)
    u = whitening.polar_factor(q @ np.diag(signs * 10.0 ** -np.linspace(0, 8, 30)) @ q.T)
    np.testing.assert_allclose(u, q @ np.diag(signs) @ q.T, atol=1e-7)
    np.testing.assert_allclose(u @ u, np.eye(30), atol=1e-13)


def check(found, vectors):
    """The query's rows against plain covariance and eigh; signs are free for each component."""
    want = brute.whitened(vectors)
    rows = {}
    for r in found:
        rows.setdefault(r.component, []).append(r)
    assert sorted(rows) == list(range(1, len(want["explained"]) + 1))
    for k, own in rows.items():
        own.sort(key=lambda r: (r.vec_id, r.deviation, abs(r.whitened or 0)))
        assert {r.n for r in own} == {want["n"]}
        plain = sorted(
            zip(want["ids"], want["deviation"], want["whitened"][:, k - 1], strict=True),
            key=lambda r: (r[0], r[1], abs(r[2])),
        )
        assert [(r.vec_id, r.deviation) for r in own] == [p[:2] for p in plain]
        got, exact = np.array([r.whitened for r in own]), np.array([p[2] for p in plain])
        np.testing.assert_allclose(got * np.sign(got @ exact), exact, atol=1e-8)
        assert own[0].explained == pytest.approx(want["explained"][k - 1], rel=1e-9)
        assert own[0].identity_error < 1e-9


def test_query_on_the_test_table(spark):
    found = queries.op12_embedding_whitening(spark, SF).collect()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(found, [(r.vec_id, r.embedding) for r in table])


def write(spark, path, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, x int").repartition(3).write.parquet(f"{path}/embeddings.parquet")


def test_query_on_faulty_vectors(spark, tmp_path):
    draw = np.random.default_rng(5)
    good = [(i, [float(v) for v in draw.standard_normal(5)]) for i in range(40)]
    good += good[:7]
    bad = [(50, None), (51, [1.0, None, 0.0, 0.0, 0.0]), (52, [float("nan")] * 5), (53, [float("inf")] * 5), (54, []), (55, [1.0, 2.0])]
    write(spark, tmp_path, [(i, v, 1) for i, v in good + bad])
    found = queries.op12_embedding_whitening(spark, str(tmp_path)).collect()
    check(found, [(i, np.array(v, np.float32).tolist()) for i, v in good])


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1)], [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]])
def test_query_without_variance(spark, tmp_path, rows):
    write(spark, tmp_path, rows)
    found = queries.op12_embedding_whitening(spark, str(tmp_path)).collect()
    assert [(r.vec_id, r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(found)] == [
        (r[0], k, 0, None, None, None) for r in rows for k in (1, 2)
    ]


def test_query_on_huge_entries(spark, tmp_path):
    write(spark, tmp_path, [(i, [3e38 if i == 3 else float(i), float(i * i)], 1) for i in range(9)])
    found = queries.op12_embedding_whitening(spark, str(tmp_path)).collect()
    assert len(found) == 18
    assert {r.deviation for r in found if r.vec_id == 3} == {None}


def test_a_column_of_the_same_name(spark):
    table = spark.createDataFrame([(i, [float(i), float(i % 3)], "mine") for i in range(9)], "id int, vector array<double>, whitened string")
    fitted = whitening.fit(table, components=1)
    found = whitening.whiten(table, fitted)
    assert found.columns == ["id", "vector", "whitened", "_whitened"]
    assert {r.whitened for r in found.collect()} == {"mine"}
    assert whitening.identity_error(found, fitted, "_whitened") < 1e-12
