import brute
import numpy as np
import pytest
from newsloom.llm import embedding_dedup as e

VECTORS = "vec_id long, embedding array<float>, label int"


def _planted(n, dims, seed, kind=np.float32):
    """Vectors in tight groups, with copies, among others."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dims))
    rows = rng.standard_normal((n, dims))
    near = rng.random(n) < 0.4
    rows[near] = centres[rng.integers(0, 6, near.sum())] + rng.standard_normal((near.sum(), dims)) * 0.3
    rows[-20:] = rows[:20]
    rows[-25:-20] = rows[:5] * 1e20
    return rows.astype(kind)


def _want(rows):
    wide = rows.astype(float)
    unit = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    root = brute.classes(range(len(rows)), lambda a, b: near[a, b])
    return {i: (int(near[i].sum()) - 1, root[i]) for i in range(len(rows))}


@pytest.mark.parametrize("dims, block, kind", [(64, 2048, "float"), (24, 7, "float"), (8, 2048, "double"), (2, 64, "float"), (130, 2048, "double")])
def test_links_agree_with_brute_force(spark, dims, block, kind):
    rows = _planted(400, dims, dims, np.float32 if kind == "float" else np.float64)
    table = spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(rows)], VECTORS.replace("float", kind)).repartition(3)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in e.near_duplicates(table, block=block).collect()}
    want = _want(rows)
    links, all_links = sum(n for n, _, _ in found.values()), sum(n for n, _ in want.values())
    assert 0.97 * all_links <= links <= all_links
    assert all(found[i][0] <= want[i][0] for i in want)
    same = sum(found[i][1] == want[i][1] for i in want)
    assert same >= 0.97 * len(rows)
    assert all(kept == (i == component) for i, (_, component, kept) in found.items())


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 2.0], 0), (5, [nan, 1.0, 1.0], 0), (6, [inf, 1.0, 1.0], 0),
        (9, v, 0), (8, v, 1), (8, v, 2), (None, [2.0, 4.0, 6.0], 0), (10, [1.0, 2.0, 3.0, 0.0], 0), (11, [-1.0, -2.0, -3.0], 0), (12, [1e-30, 2e-30, 3e-30], 0),
        (None, [5.0, -1.0, 0.0], 0), (None, None, 0),
    ]
    table = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS node", "2 AS kept", "3 AS filter")
    found = sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in e.near_duplicates(table).collect()], key=repr)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, 11, None, None)]
    group = [(9, 4, 8, False), (8, 4, 8, True), (8, 4, 8, True), (None, 4, 8, False), (12, 4, 8, False)]
    assert found == sorted(alone + group, key=repr)
    assert e.near_duplicates(table.limit(0)).count() == 0
    assert e.near_duplicates(table.where("vec_id < 3")).count() == 2


def test_decoding_finds_all_filters_above_the_level():
    code = e.choose_code(300, 24)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    parts = code.parts()[:3]
    row, name = code.decode(x, parts)
    found = set(zip(row.tolist(), name.tolist(), strict=True))
    assert len(found) == len(row)
    for k, (turn, (one, two)) in enumerate(parts):
        directions = np.concatenate([np.repeat(one, len(two), 0), np.tile(two, (len(one), 1))], axis=1) / np.sqrt(2)
        scores = x @ turn @ directions.T
        sure = {(int(i), int(j) * code.codes + k) for i, j in zip(*np.nonzero(scores >= code.level + 1e-5), strict=True)}
        maybe = {(int(i), int(j) * code.codes + k) for i, j in zip(*np.nonzero(scores >= code.level - 1e-5), strict=True)}
        mine = {f for f in found if f[1] % code.codes == k}
        assert sure <= mine <= maybe


def test_three_blocks():
    code = e.Code(24, 0.5, 3, 12, 1)
    x = np.eye(24, dtype=np.float32)
    row, name = code.decode(x, code.parts()[:1])
    turn, words = code.parts()[0]
    grid = np.array([[*a, *b, *c] for a in words[0] for b in words[1] for c in words[2]]) / np.sqrt(3)
    assert len(row) == (x @ turn @ grid.T >= 0.5).sum() and len(row) > 0


@pytest.mark.parametrize("n, dims", [(10**4, 64), (10**6, 64), (10**9, 64), (10**6, 384), (10**8, 384), (10**8, 768)])
def test_few_pairs_at_the_threshold_are_missed(n, dims):
    """Other pairs than those that the number of codes was measured with."""
    code = e.choose_code(n, dims)
    found = e.found_by_each(code, e.MIN_COSINE, 300, seed=77).any(axis=1)
    assert found.mean() >= 0.95
    assert e.found_by_each(code, 0.93, 200, seed=78).any(axis=1).mean() >= 0.98
