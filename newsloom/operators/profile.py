"""Counts and lists over posts, sources and runs."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import number_suffix
from newsloom.functions.web import url_origin
from newsloom.operators.positions import group_positions
from newsloom.session import store


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs, most frequent first; null is no value."""
    return group_sizes(df, [column])


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, largest group first; rows with a null in the key do not count."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), *keys)
    )


def count_present(df: DataFrame, key: str, column: str) -> DataFrame:
    """Non-null values per key; a key without any is kept with 0."""
    return df.groupBy(key).agg(F.count(column).alias("count"))


def source_counts(posts: DataFrame, profile: str = "perfil", link: str = "link") -> DataFrame:
    """Posts per profile and origin of the linked article, most frequent first."""
    return group_sizes(posts.withColumn("article_source", url_origin(F.col(link))), [profile, "article_source"])


def repeated_sources(counts: DataFrame) -> DataFrame:
    """Sources a profile linked to more than once."""
    return counts.where(F.col("count") > 1)


def distinct_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, pos, value): per key the distinct values in order, from position 0.

    Pairs are made distinct map-side first.
    """
    pairs = store(df.select(key, value).where(F.col(value).isNotNull()).distinct(), "pairs")
    return group_positions(pairs, [key], [value]).select(key, "pos", value)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows; each task keeps k at most."""
    return df.orderBy(*order).limit(k)


def latest_article(articles: DataFrame, date: str = "publish_date", tie: str = "article_id") -> DataFrame:
    """The article published last; undated ones come after all others."""
    return top_k(articles, [F.desc_nulls_last(date), F.asc(tie)], 1)


def pick(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The k-th row, from 0, in a stated order."""
    return df.orderBy(*order).offset(k).limit(1)


def pick_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The k-th row of each group; only k + 1 rows per group and task are exchanged."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rn", F.row_number().over(window))
        .where(F.col("__rn") <= k + 1)
        .where(F.col("__rn") == k + 1)
        .drop("__rn")
    )


def latest_run(ledger: DataFrame, ord_col: str, run: str = "RUNID") -> DataFrame:
    """The run with the highest number; of several entries the one appended last.

    Run numbers order as numbers, so run 10 comes after run 9.
    """
    return top_k(
        ledger.withColumn("status", F.coalesce("status", F.lit("unknown"))).withColumn(
            "run_no", number_suffix(F.col(run))
        ),
        [F.desc("run_no"), F.desc(ord_col)],
        1,
    )


def by_number(files: DataFrame, name: str) -> DataFrame:
    """Batch files in the order of the number in their name."""
    return files.withColumn("file_no", number_suffix(F.col(name))).orderBy("file_no", name)


def batch_status(batches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What to do about a task's batches: WAIT, ALL_ERROR_END or ALL_COMPLETED_CONTINUE.

    A batch that is not completed counts as running. A completed one counts once for its
    output and once for its errors, if they are not empty. Without any such entry, as
    with no batches at all, the task ends in error. `wait_time` is 120 s per running batch.
    """
    running = ~F.coalesce(F.col("status") == "completed", F.lit(False))

    def saved(column: str) -> Column:
        return ~running & F.coalesce(F.col(column).rlike(r"\S"), F.lit(False))

    counts = batches.groupBy(*keys).agg(
        F.count_if(running).alias("n_running"),
        F.count_if(saved("output")).alias("n_completed"),
        F.count_if(saved("error")).alias("n_error"),
    )
    return counts.withColumn(
        "status",
        F.when(F.col("n_running") > 0, "WAIT")
        .when(F.col("n_completed") == 0, "ALL_ERROR_END")
        .otherwise("ALL_COMPLETED_CONTINUE"),
    ).withColumn("wait_time", F.when(F.col("n_running") > 0, F.col("n_running") * 120))
