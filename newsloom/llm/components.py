"""Connected components of a graph that no task has to hold."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import drop_table, stored_at


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (u bigint, v bigint): root is the smallest node of
    its component.

    Large-star and small-star steps by turns: each links the neighbours of a node to the
    smallest of them, until all components are stars. The smallest neighbours are aggregated
    map-side and stored, so that a node with very many neighbours is only one skewed join
    key, which adaptive execution splits. Every step is written to the shared scratch folder
    and cuts the lineage. Edges with a null end and loops count for nothing; without edges
    the result is empty.
    """
    spark = edges.sparkSession
    start = edges.select(
        F.greatest("u", "v").cast("bigint").alias("a"), F.least("u", "v").cast("bigint").alias("b")
    ).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now, path = stored_at(start.distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        for step in (_large_star, _small_star):
            mins, mins_path = stored_at(step(now, None), "mins")
            after, after_path = stored_at(step(now, mins).distinct(), "edges")
            drop_table(spark, mins_path)
            drop_table(spark, path)
            now, path = after, after_path
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
    )


def _large_star(edges: DataFrame, mins: DataFrame | None) -> DataFrame:
    """Links of each node's larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).unionAll(
        edges.select(F.col("b").alias("n"), F.col("a").alias("m"))
    )
    if mins is None:
        return both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
    return (
        both.where("m > n").join(mins, "n").select(F.col("m").alias("a"), F.col("low").alias("b"))
    )


def _small_star(edges: DataFrame, mins: DataFrame | None) -> DataFrame:
    """Links of each node and its smaller neighbours to the smallest of these."""
    if mins is None:
        return edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
    linked = edges.join(mins, F.col("a") == F.col("n"))
    return linked.select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").unionAll(
        mins.select(F.col("n").alias("a"), F.col("low").alias("b"))
    )
