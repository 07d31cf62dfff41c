"""Exact nearest neighbours and the centroid."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.validation import REASON
from newsloom.session import store

# Bytes of query vectors that may be sent to every task.
MAX_QUERY_BYTES = 64 << 20
# Beside its vector, what a query's id may take.
ID_BYTES = 64
# Bytes of query and of corpus vectors that meet in one task beyond that.
QUERY_BLOCK_BYTES = 32 << 20
CORPUS_BLOCK_BYTES = 64 << 20
# Multiplications, pairs times the length of a vector, of one task: some ten seconds.
BLOCK_WORK = 1 << 36
# Rows of either side that are multiplied at a time, and pairs that get their distance at a time.
QUERY_PIECE, CORPUS_PIECE = 256, 4096
PAIRS = 1 << 16


def centroid(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row: the mean of all vectors that are finite, reduced map-side."""
    return df.where(vector_fault(F.col(vector)).isNull()).select(
        vector_to_array(Summarizer.mean(array_to_vector(F.col(vector)))).alias("centroid")
    )


def vector_fault(vector: Column, length: int | None = None) -> Column:
    """Why a vector cannot be compared, or null: it is null, has another length, or holds
    components that are null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    other = F.lit(False) if length is None else F.size(vector) != length
    return F.when(vector.isNull(), "no vector").when(other, "other length").when(bad, "not finite")


def unusable(df: DataFrame, id_col: str, vector: str = "embedding", length: int | None = None) -> DataFrame:
    """(id, reject_reason) of the rows that `nearest` and `centroid` leave out."""
    reason = vector_fault(F.col(vector), length)
    return df.select(id_col, reason.alias(REASON)).where(F.col(REASON).isNotNull())


def nearest_to_centroid(df: DataFrame, id_col: str, vector: str = "embedding", k: int = 5) -> DataFrame:
    """The k rows nearest to the mean of all vectors: (id, distance, rank)."""
    query = centroid(df, vector).select(F.lit(0).alias("query_id"), "centroid")
    return nearest(df, query, id_col, "query_id", vector, "centroid", k).drop("query_id")


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    id_col: str,
    query_id: str,
    vector: str = "embedding",
    query_vector: str | None = None,
    k: int = 5,
    max_query_bytes: int = MAX_QUERY_BYTES,
) -> DataFrame:
    """The k nearest corpus rows of each query by squared Euclidean distance, exact.

    Returns (query_id, id, distance, rank); the lower id wins a tie. Vectors that are null, not
    finite, or not of the queries' length are left out; `unusable` reports them.

    The corpus is read once where it lies. Each task keeps its k best per query and only
    those are exchanged, never the pairs. The queries go to every task while they are
    known to fit `max_query_bytes`; more of them are compared block by block.
    """
    query_vector = query_vector or vector
    # Stored: the queries may come of a scan of the corpus, and are read more than once.
    queries = store(
        queries.select(F.col(query_id).alias("__qid"), F.col(query_vector).cast("array<double>").alias("__q"))
        .where(vector_fault(F.col("__q")).isNull()),
        "queries",
    )
    found = queries.agg(
        F.min(F.size("__q")).alias("short"), F.max(F.size("__q")).alias("long"), F.count("*").alias("n")
    ).first()
    if found["short"] != found["long"]:
        raise ValueError("query vectors differ in length")
    length = found["long"] or 0
    corpus = corpus.select(F.col(id_col).alias("__id"), F.col(vector).alias("__v"))
    schema = T.StructType(
        [queries.schema["__qid"], corpus.schema["__id"], T.StructField("distance", T.DoubleType())]
    )
    # Counts first, so that no more than the allowed bytes ever reach the driver.
    if found["n"] * (length * 8 + ID_BYTES) <= max_query_bytes:
        rows = queries.collect()
        best = corpus.mapInArrow(_scan([r[0] for r in rows], [r[1] for r in rows], k, schema), schema)
    else:
        best = _nearest_by_block(corpus, queries, found["n"], length, k, schema)
    return _top(best, k, query_id, id_col)


def _top(best: DataFrame, k: int, query_id: str, id_col: str) -> DataFrame:
    """The k best of the candidates of each query; tasks keep k of a query before they are exchanged."""
    window = Window.partitionBy("__qid").orderBy("distance", "__id")
    return (
        best.withColumn("rank", F.row_number().over(window).cast("bigint"))
        .where(F.col("rank") <= k)
        .select(F.col("__qid").alias(query_id), F.col("__id").alias(id_col), "distance", "rank")
    )


def _one(column: pa.ChunkedArray) -> pa.Array:
    """The column as one array; copied only if it is of several."""
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _usable(ids, vectors, length: int) -> tuple[pa.Array, np.ndarray]:
    """The ids and the matrix of the vectors that `vector_fault` finds nothing wrong with."""
    if isinstance(vectors, pa.ChunkedArray):
        ids, vectors = _one(ids), _one(vectors)
    rows = np.flatnonzero(vectors.value_lengths().fill_null(-1).to_numpy() == length)
    if len(rows) < len(vectors):
        ids, vectors = ids.take(pa.array(rows)), vectors.take(pa.array(rows))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    matrix = flat.reshape(len(vectors), length)
    # Nulls are NaN here.
    finite = np.isfinite(matrix).all(axis=1)
    if finite.all():
        return ids, matrix
    return ids.take(pa.array(np.flatnonzero(finite))), matrix[finite]


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = _one(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


class _Best:
    """The k best corpus rows of each query so far; the lower id first where distances are equal.

    A matrix product ranks all pairs of a piece up to rounding. Only rows that may be among
    the k best so far get their distance by the sum of squares, so the product decides
    nothing. The first piece is ranked; in later ones a row only has to beat the k-th.
    """

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.norms = np.einsum("ij,ij->i", queries, queries)
        # Ids, and by query the distance and the place among the ids; a place of -1 is free.
        self.ids: pa.Array | None = None
        self.distance = np.full((len(queries), k), np.inf)
        self.place = np.full((len(queries), k), -1, np.int64)

    def add(self, ids: pa.Array, vectors: np.ndarray) -> None:
        if not len(vectors) or not len(self.queries):
            return
        held = 0
        if self.ids is not None:
            # Only ids that are still among the best are kept.
            used = np.unique(self.place[self.place >= 0])
            held, kept = len(used), self.ids.take(pa.array(used))
            taken = self.place >= 0
            self.place[taken] = np.searchsorted(used, self.place[taken])
            ids = pa.concat_arrays([kept, ids.cast(kept.type)])
        # By their order, ids compare as numbers.
        order = pc.array_sort_indices(ids, null_placement="at_start").to_numpy()
        ranks = np.empty(len(ids), np.int64)
        ranks[order] = np.arange(len(ids))
        taken = self.place >= 0
        self.place[taken] = ranks[self.place[taken]]
        self.ids = ids.take(pa.array(order))
        norms = np.einsum("ij,ij->i", vectors, vectors)
        slack = 1e-9 * (1.0 + norms.max()) + 1e-9 * self.norms
        # One buffer for all products.
        buffer = np.empty(min(QUERY_PIECE, len(self.queries)) * min(CORPUS_PIECE, len(vectors)))
        for start in range(0, len(self.queries), QUERY_PIECE):
            own = slice(start, min(start + QUERY_PIECE, len(self.queries)))
            twice = -2.0 * self.queries[own]
            for first in range(0, len(vectors), CORPUS_PIECE):
                piece = slice(first, first + CORPUS_PIECE)
                n = len(norms[piece])
                rough = np.matmul(twice, vectors[piece].T, out=buffer[: len(twice) * n].reshape(-1, n))
                rough += norms[piece]
                limits = self.distance[own, -1] - self.norms[own]
                if np.isinf(limits).any():
                    if n >= self.k:
                        limits = np.minimum(limits, np.partition(rough, self.k - 1, axis=1)[:, self.k - 1])
                query, row = np.divmod(np.flatnonzero(rough <= (limits + slack[own])[:, None]), n)
                # Where many are as near, some at a time.
                for i in range(0, len(row), PAIRS):
                    self._merge(start + query[i : i + PAIRS], first + row[i : i + PAIRS], vectors, ranks[held:])

    def _merge(self, query: np.ndarray, row: np.ndarray, vectors: np.ndarray, ranks: np.ndarray) -> None:
        """Put rows among the best of their queries, `query` in rising order."""
        gaps = vectors[row] - self.queries[query]
        asked = np.unique(query)
        old = self.place[asked] >= 0
        query = np.concatenate([query, np.repeat(asked, self.k)[old.ravel()]])
        distance = np.concatenate([np.einsum("ij,ij->i", gaps, gaps), self.distance[asked][old]])
        place = np.concatenate([ranks[row], self.place[asked][old]])
        order = np.lexsort((place, distance, query))
        query, distance, place = query[order], distance[order], place[order]
        opens = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(opens, np.diff(opens, append=len(query)))
        good = rank < self.k
        self.distance[query[good], rank[good]] = distance[good]
        self.place[query[good], rank[good]] = place[good]

    def candidates(self, query_ids: pa.Array, schema: T.StructType) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        query, rank = np.nonzero(self.place >= 0)
        if not len(query):
            return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in arrow], schema=arrow)
        columns = [
            query_ids.take(pa.array(query)), self.ids.take(pa.array(self.place[query, rank])),
            pa.array(self.distance[query, rank]),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _scan(query_ids: list, query_vectors: list, k: int, schema: T.StructType):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if not query_ids:
            return
        queries = np.asarray(query_vectors, dtype=np.float64)
        best = _Best(queries, k)
        for batch in batches:
            best.add(*_usable(batch.column(0), batch.column(1), queries.shape[1]))
        yield best.candidates(pa.array(query_ids, to_arrow_schema(schema).field(0).type), schema)

    return scan


def block_counts(n_queries: int, n_rows: int, length: int, query_bytes: int, row_bytes: int) -> tuple[int, int]:
    """(blocks of queries, blocks of corpus rows), so that no task exceeds these bytes or BLOCK_WORK."""
    queries = max(1, min(n_queries, query_bytes // (8 * max(1, length))))
    rows = max(1, min(n_rows, row_bytes // (8 * max(1, length))))
    # Both sides are cut alike, so that few copies of the vectors are exchanged.
    over = (queries * rows * length / BLOCK_WORK) ** 0.5
    if over > 1:
        queries, rows = max(1, int(queries / over)), max(1, int(rows / over))
    return max(1, -(-n_queries // queries)), max(1, -(-n_rows // rows))


def _nearest_by_block(
    corpus: DataFrame, queries: DataFrame, n: int, length: int, k: int, schema: T.StructType
) -> DataFrame:
    """Compare each block of queries with each block of the corpus in a task of its own.

    Every vector is exchanged once for each block of the other side, so blocks are as large
    as a task can hold.
    """
    size = corpus.agg(F.sum(F.coalesce(F.size("__v"), F.lit(0)).cast("bigint") * 8)).first()[0] or 0
    one = F.lit(0)
    blocks = [(0, *block_counts(n, -(-size // (8 * max(1, length))), length, QUERY_BLOCK_BYTES, CORPUS_BLOCK_BYTES))]
    return _compare(corpus.withColumn("cell", one), queries.withColumn("cell", one), blocks, length, k, schema)


def _compare(
    corpus: DataFrame, queries: DataFrame, blocks: list[tuple[int, int, int]], length: int, k: int, schema: T.StructType
) -> DataFrame:
    """The k best pairs of each query with the corpus rows (__id, __v) of its cells.

    `queries` has a row (__qid, __q, cell) for each cell that a query looks into. `blocks`:
    (cell, blocks of queries, blocks of corpus rows); each pair of blocks of a cell meets
    in a task of its own, however many rows the cell holds.
    """
    n_q = F.create_map(*[F.lit(x) for cell, q, _ in blocks for x in (cell, q)])
    n_c = F.create_map(*[F.lit(x) for cell, _, c in blocks for x in (cell, c)])

    def numbers(n):
        return F.explode(F.sequence(F.lit(0), n - 1))

    left = queries.select(
        "__qid", "__q", "cell", F.pmod(F.xxhash64("__qid"), n_q[F.col("cell")]).cast("int").alias("__qb"),
        numbers(n_c[F.col("cell")]).alias("__cb"),
    )
    right = corpus.select(
        "__id", "__v", "cell", F.pmod(F.xxhash64("__id"), n_c[F.col("cell")]).cast("int").alias("__cb"),
        numbers(n_q[F.col("cell")]).alias("__qb"),
    )

    def compare(q: pa.Table, c: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        if not q.num_rows or not c.num_rows:
            return pa.Table.from_batches([], to_arrow_schema(schema))
        best = _Best(_matrix(q["__q"]), k)
        best.add(*_usable(c["__id"], c["__v"], length))
        return pa.Table.from_batches([best.candidates(_one(q["__qid"]), schema)])

    key = ["cell", "__qb", "__cb"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, schema)
