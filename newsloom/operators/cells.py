"""An index of vectors by cells, and exact nearest neighbours that read only the cells they need."""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.neighbours import (
    CORPUS_BLOCK_BYTES,
    QUERY_BLOCK_BYTES,
    _compare,
    _matrix,
    _top,
    block_counts,
    vector_fault,
)
from newsloom.session import store

# Cells at most, and rows that their centres are fitted on at most. Both decide how much a search
# reads, never what it finds.
MAX_CELLS = 1024
FIT_ROWS = 65_536
SEED = 42
# Bytes of query vectors that leave a task at a time.
LOOK_BYTES = 4 << 20


@dataclass(frozen=True)
class CellIndex:
    """Vectors (__id, __v, gap to the centre of their cell) under `path`/rows, a folder for each
    cell, and the cells under `path`/cells: their centre, number of rows, least and
    greatest gap. The centres, 1,024 vectors at most, come to the driver and go to tasks."""

    spark: SparkSession
    path: str
    numbers: list[int]
    centres: np.ndarray
    rows: list[int]
    low: np.ndarray
    high: np.ndarray
    id_type: str

    def read(self, cells: list[int]) -> DataFrame:
        """The rows of some cells; the folders of others are not opened."""
        schema = f"__id {self.id_type}, __v array<double>, gap double, cell int"
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows").where(F.col("cell").isin(cells))


def build_cells(
    corpus: DataFrame, id_col: str, vector: str, path: str, cells: int | None = None,
    fit_rows: int = FIT_ROWS, seed: int = SEED,
) -> CellIndex:
    """Write the index of all vectors that can be compared, those of the commonest length.

    The centres are those of k-means over some `fit_rows` rows; by default a cell has some
    thousand rows, up to 1,024 cells. Every row goes to the cell of the nearest centre.
    """
    spark = corpus.sparkSession
    rows = corpus.select(F.col(id_col).alias("__id"), F.col(vector).cast("array<double>").alias("__v"))
    # The vectors may be computed: they are checked once.
    rows = store(rows, "vectors").where(vector_fault(F.col("__v")).isNull())
    lengths = rows.groupBy(F.size("__v").alias("length")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), "length").first()
    if common is None:
        return _stored(spark, path, [], rows.schema["__id"].dataType.simpleString())
    length, n = common
    rows = rows.where(F.size("__v") == length)
    wanted = cells or max(1, min(MAX_CELLS, n // 1000))
    sample = rows.sample(min(1.0, 1.2 * fit_rows / n), seed) if n > fit_rows else rows
    features = sample.select(array_to_vector("__v").alias("features"))
    centres = np.array(KMeans(k=wanted, seed=seed, maxIter=10).fit(features).clusterCenters()) if wanted > 1 else None
    if centres is None:
        centres = np.array([rows.limit(1).first()["__v"]])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, gap = _nearest_centre(_matrix(batch.column(1)), centres)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(gap), pa.array(cell, pa.int32())], ["__id", "__v", "gap", "cell"])

    schema = T.StructType([*rows.schema.fields, T.StructField("gap", T.DoubleType()), T.StructField("cell", T.IntegerType())])
    (
        rows.mapInArrow(place, schema)
        .hint("rebalance", "cell")
        .sortWithinPartitions("cell", "gap")
        .write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    )
    placed = spark.read.schema(schema).parquet(f"{path}/rows")
    cell_rows = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("gap").alias("low"), F.max("gap").alias("high"))
    stats = [(r.cell, centres[r.cell].tolist(), r.n, r.low, r.high) for r in cell_rows.orderBy("cell").collect()]
    return _stored(spark, path, stats, rows.schema["__id"].dataType.simpleString())


_CELLS = "cell int, centre array<double>, n bigint, low double, high double, id_type string"


def _stored(spark: SparkSession, path: str, stats: list, id_type: str) -> CellIndex:
    lines = [(*s, id_type) for s in stats] or [(None, None, None, None, None, id_type)]
    spark.createDataFrame(lines, _CELLS).coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
    return open_cells(spark, path)


def open_cells(spark: SparkSession, path: str) -> CellIndex:
    """The index that `build_cells` has written."""
    lines = spark.read.schema(_CELLS).parquet(f"{path}/cells").orderBy("cell").collect()
    known = [r for r in lines if r.cell is not None]
    return CellIndex(
        spark, path, [r.cell for r in known], np.array([r.centre for r in known]), [r.n for r in known],
        np.array([r.low for r in known]), np.array([r.high for r in known]), lines[0].id_type,
    )


def _distances(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances by sums of squares, centre by centre: no cancellation to allow for."""
    out = np.empty((len(vectors), len(centres)))
    for j, centre in enumerate(centres):
        gaps = vectors - centre
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", gaps, gaps))
    return out


def _nearest_centre(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each vector and the distance to its centre."""
    norms = np.einsum("ij,ij->i", centres, centres)
    cell = np.argmin(norms - 2.0 * (vectors @ centres.T), axis=1)
    gaps = vectors - centres[cell]
    return cell, np.sqrt(np.einsum("ij,ij->i", gaps, gaps))


def nearest_in_cells(
    index: CellIndex, queries: DataFrame, id_col: str, query_id: str, query_vector: str = "embedding", k: int = 5
) -> DataFrame:
    """The k nearest indexed rows of each query by squared Euclidean distance, exact, with what
    `neighbours.nearest` returns: (query_id, id, distance, rank); the lower id wins a tie.

    By the triangle inequality a cell holds nothing nearer to a query than the difference of
    the query's distance to its centre and the gaps of its rows. First each query looks into
    the cells that are sure to hold k rows nearby, and has a k-th distance; then into those
    of the others that may hold something as near. Cells that no query needs are not read.
    """
    queries = store(
        queries.select(F.col(query_id).alias("__qid"), F.col(query_vector).cast("array<double>").alias("__q"))
        .where(vector_fault(F.col("__q")).isNull()),
        "queries",
    )
    schema = T.StructType([
        queries.schema["__qid"],
        T.StructField("__id", T._parse_datatype_string(index.id_type)),
        T.StructField("distance", T.DoubleType()),
    ])
    lengths = queries.agg(F.min(F.size("__q")).alias("short"), F.max(F.size("__q")).alias("long")).first()
    if not index.numbers or lengths["long"] is None:
        none = queries.sparkSession.createDataFrame([], schema)
        return _top(none, k, query_id, id_col)
    length = index.centres.shape[1]
    if (lengths["short"], lengths["long"]) != (length, length):
        raise ValueError("query vectors differ in length from those of the index")
    numbers, centres, rows, low, high = index.numbers, index.centres, np.array(index.rows), index.low, index.high

    def look(within: bool):
        """(__qid, __q, cell) for the first or, within the distance known, for the second look."""

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                gaps = _distances(_matrix(batch.column(1)), centres)
                # No row of the cell is farther than this; cells in this order until they hold k rows.
                order = np.argsort(gaps + high, axis=1, kind="stable")
                held = np.cumsum(rows[order], axis=1) - rows[order]
                first = np.zeros(gaps.shape, bool)
                np.put_along_axis(first, order, held < k, axis=1)
                chosen = first
                if within:
                    bound = np.array([np.inf if x is None else x for x in batch.column(2).to_pylist()])
                    reach = (np.sqrt(bound) * (1 + 1e-9) + 1e-9)[:, None]
                    nearest = np.maximum(gaps - high, low - gaps)
                    chosen = ~first & (nearest <= reach + 1e-9 * gaps)
                rows_, cells_ = np.nonzero(chosen)
                # A query may look into every cell: some copies of the vectors at a time.
                step = max(1, LOOK_BYTES // (8 * length))
                for i in range(0, len(rows_), step):
                    take, cell = pa.array(rows_[i : i + step]), np.array(numbers)[cells_[i : i + step]]
                    found = [batch.column(0).take(take), batch.column(1).take(take), pa.array(cell, pa.int32())]
                    yield pa.RecordBatch.from_arrays(found, ["__qid", "__q", "cell"])

        return cells

    out = T.StructType([*queries.schema.fields, T.StructField("cell", T.IntegerType())])

    def compare(asked: DataFrame) -> DataFrame | None:
        asked = store(asked, "asked")
        counts = {r.cell: r.n for r in asked.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        if not counts:
            return None
        size = dict(zip(numbers, index.rows, strict=True))
        blocks = [
            (c, *block_counts(n, size[c], length, QUERY_BLOCK_BYTES, CORPUS_BLOCK_BYTES))
            for c, n in counts.items()
        ]
        return _compare(index.read(sorted(counts)), asked, blocks, length, k, schema)

    first = store(compare(queries.mapInArrow(look(False), out)), "first")
    top = _top(first, k, "__qid", "__id")
    # Fewer than k rows in all: no bound.
    bounds = top.groupBy(F.col("__qid").alias("__id")).agg(F.when(F.count("*") == k, F.max("distance")).alias("bound"))
    known = queries.join(store(bounds, "bounds"), F.col("__qid") == F.col("__id")).select("__qid", "__q", "bound")
    second = compare(known.mapInArrow(look(True), out))
    return _top(first if second is None else first.unionByName(second), k, query_id, id_col)
