"""Exact search in an index by cells."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from newsloom.operators import cells, neighbours


def vectors(spark, n, spread, seed=1, dims=6, centres=12):
    """Vectors around a few centres, with copies, and some that cannot be compared."""
    draw = np.random.default_rng(seed)
    middle = draw.standard_normal((centres, dims)) * 10
    x = middle[draw.integers(0, centres, n)] + draw.standard_normal((n, dims)) * spread
    x[n // 2 : n // 2 + n // 10] = x[0]
    data = [(f"v{i:05d}", row.tolist()) for i, row in enumerate(x)]
    data += [("none", None), ("short", [1.0]), ("nan", [float("nan")] * dims), ("hole", [None] * dims)]
    return spark.createDataFrame(data, "id string, v array<double>")


@pytest.mark.parametrize("spread, k", [(0.1, 1), (1.0, 5), (30.0, 40), (1.0, 3000)])
def test_agrees_with_the_full_scan(spark, tmp_path, spread, k):
    corpus = vectors(spark, 2000, spread)
    queries = vectors(spark, 60, spread, seed=2).select(F.col("id").alias("q"), "v").where("q LIKE 'v%'")
    index = cells.build_cells(corpus, "id", "v", str(tmp_path / "index"), cells=15)
    assert sum(index.rows) == 2000
    found = cells.nearest_in_cells(index, queries, "id", "q", "v", k)
    assert found.columns == ["q", "id", "distance", "rank"]
    assert rows(found) == rows(neighbours.nearest(corpus, queries, "id", "q", "v", k=k))


def test_cells_that_are_too_far_are_not_read(spark, tmp_path, monkeypatch):
    index = cells.build_cells(vectors(spark, 2000, 0.1), "id", "v", str(tmp_path / "index"), cells=12)
    read = []
    whole = cells.CellIndex.read
    monkeypatch.setattr(cells.CellIndex, "read", lambda self, numbers: (read.append(numbers), whole(self, numbers))[1])
    query = spark.createDataFrame([(1, index.centres[3].tolist())], "q int, v array<double>")
    found = cells.nearest_in_cells(index, query, "id", "q", "v", 3)
    assert found.count() == 3
    assert sum(map(len, read)) <= 2
    plan = index.read([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan and "(cell#" in plan


def test_an_index_of_nothing_and_one_opened_again(spark, tmp_path):
    empty = vectors(spark, 50, 1.0).limit(0)
    index = cells.build_cells(empty, "id", "v", str(tmp_path / "none"))
    query = spark.createDataFrame([(1, [0.0] * 6)], "q int, v array<double>")
    assert cells.nearest_in_cells(index, query, "id", "q", "v").count() == 0
    cells.build_cells(vectors(spark, 300, 1.0), "id", "v", str(tmp_path / "some"))
    index = cells.open_cells(spark, str(tmp_path / "some"))
    assert index.rows == [300]
    assert cells.nearest_in_cells(index, query, "id", "q", "v").count() == 5
    assert cells.nearest_in_cells(index, query.limit(0), "id", "q", "v").count() == 0
    with pytest.raises(ValueError):
        cells.nearest_in_cells(index, spark.createDataFrame([(1, [0.0])], "q int, v array<double>"), "id", "q", "v").count()


def test_a_crowded_cell_is_cut_into_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cells, "CORPUS_BLOCK_BYTES", 4000)
    monkeypatch.setattr(cells, "QUERY_BLOCK_BYTES", 1000)
    corpus = vectors(spark, 500, 0.0, centres=2)
    index = cells.build_cells(corpus, "id", "v", str(tmp_path / "index"), cells=2)
    queries = corpus.where("id LIKE 'v%'").select(F.col("id").alias("q"), "v")
    found = cells.nearest_in_cells(index, queries, "id", "q", "v", 4)
    assert rows(found) == rows(neighbours.nearest(corpus, queries, "id", "q", "v", k=4))


def test_vectors_for_many_cells_leave_in_small_batches(spark, tmp_path, monkeypatch):
    """Queries that look into every cell are not copied for all of them at once."""
    monkeypatch.setattr(cells, "LOOK_BYTES", 10 * 8 * 6)
    seen = []
    plain = type(spark.range(1)).mapInArrow

    def counted(self, fn, schema, *rest):
        if getattr(fn, "__name__", "") == "cells":
            out = list(fn(iter([self.toArrow().combine_chunks().to_batches()[0]])))
            seen.extend(b.num_rows for b in out)
        return plain(self, fn, schema, *rest)

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", counted)
    corpus = vectors(spark, 400, 30.0)
    index = cells.build_cells(corpus, "id", "v", str(tmp_path / "index"), cells=8)
    queries = corpus.where("id LIKE 'v%'").select(F.col("id").alias("q"), "v")
    found = cells.nearest_in_cells(index, queries, "id", "q", "v", 4)
    assert len(seen) > 40 and max(seen) <= 10
    assert rows(found) == rows(neighbours.nearest(corpus, queries, "id", "q", "v", k=4))
