"""Helpers of the operators in this subpackage."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.session import scratch_path, store

__all__ = [
    "added_columns", "drop_table", "one_per_key", "row_keys", "sorted_groups", "store", "stored_at", "table",
    "texts_of", "unused_names",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be no column of `df`."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def added_columns(df: DataFrame, columns: str) -> StructType:
    """The schema of `df` with more columns, given as DDL, after it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(columns).fields])


def stored_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """`store`, with the path, for tables that are dropped once the next one is written."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def row_keys(*columns: Column) -> tuple[Column, Column]:
    """128 bits that tell rows apart by the values of `columns`, nulls among them, never null."""
    return F.xxhash64(*columns), F.xxhash64(F.lit(1), *reversed(columns))


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Any one row of each key. Tasks keep one row of a key before these are exchanged."""
    (nth,) = unused_names(df, "nth")
    window = Window.partitionBy(*keys).orderBy(keys[0])
    return df.withColumn(nth, F.row_number().over(window)).where(F.col(nth) == 1).drop(nth)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table that `stored_at` wrote."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def texts_of(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def sorted_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str], rows: int = 1 << 20
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Pieces of a stream sorted by `keys`, none of which cuts a group, and each piece's bounds.

    Group i of a piece has the rows from bounds[i] to bounds[i + 1]. Groups that are not
    bounded by their caller make large pieces.
    """

    def bounds_of(piece: pa.Table) -> np.ndarray:
        new = np.zeros(piece.num_rows - 1, bool)
        for key in keys:
            values = piece.column(key).to_numpy()
            new |= values[1:] != values[:-1]
        return np.concatenate([[0], np.flatnonzero(new) + 1, [piece.num_rows]])

    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        piece = pa.Table.from_batches(held).combine_chunks()
        bounds = bounds_of(piece)
        if len(bounds) > 2:
            yield piece.slice(0, bounds[-2]), bounds[:-1]
            held = piece.slice(bounds[-2]).combine_chunks().to_batches()
            n = sum(b.num_rows for b in held)
    if n:
        piece = pa.Table.from_batches(held).combine_chunks()
        yield piece, bounds_of(piece)
