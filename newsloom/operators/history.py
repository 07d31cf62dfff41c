"""Dedupe against earlier runs, and duplicates inside one table."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import store

ARTICLE_KEYS = ("article_title", "source_name")


def key_digest(keys: Sequence[str]) -> Column:
    """256 bits that are equal where all `keys` are, nulls among them, and never null.

    What is compared may be long texts; only digests are exchanged.
    """
    texts = [F.col(k).cast("string") for k in keys]
    # A length in front of each text, so that no two rows of keys read alike.
    parts = [F.coalesce(F.concat(F.octet_length(x), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.sha2(F.concat(*parts), 256)


def same_key(keys: Sequence[str]) -> Column:
    """Whether the keys have the digest __key. Written null-safe, though neither is null: the
    planner then exchanges both sides anew, also one that was just grouped by __key."""
    return key_digest(keys).eqNullSafe(F.col("__key"))


def history_keys(history: DataFrame, keys: Sequence[str] = ARTICLE_KEYS, run: str = "run_id") -> DataFrame:
    """One row per key, by its digest (__key): the lowest and highest run that holds it.

    A key of any frequency shrinks to one row per task before the exchange.
    """
    return history.groupBy(key_digest(keys).alias("__key")).agg(
        F.min(run).alias("__lo"), F.max(run).alias("__hi")
    )


def new_articles(
    current: DataFrame,
    history: DataFrame,
    keys: Sequence[str] = ARTICLE_KEYS,
    run: str = "run_id",
    prune_history: bool = False,
) -> DataFrame:
    """Rows of `current` whose key no other run of `history` holds.

    Nulls match nulls. Copies inside a run stay, and the run's own rows in the history do
    not count. `current` may hold many runs; each is checked against all the others.

    With `prune_history`, for a `current` that is a small part of the whole, the history is
    first cut to the keys that occur in it. The planner does that by broadcast or by a
    runtime filter at the scan, so that the rest of the history is never exchanged.
    """
    if prune_history:
        history = keys_within(history, current, keys)
    clash = (F.col("__lo") != F.col(run)) | (F.col("__hi") != F.col(run))
    return drop_known(current, history_keys(history, keys, run), keys, clash)


def keys_within(history: DataFrame, current: DataFrame, keys: Sequence[str] = ARTICLE_KEYS) -> DataFrame:
    """Rows of `history` whose key occurs in `current`; nulls match nulls."""
    wanted = current.select(key_digest(keys).alias("__wanted")).distinct()
    return history.join(wanted, key_digest(keys) == F.col("__wanted"), "left_semi")


def drop_known(current: DataFrame, known: DataFrame, keys: Sequence[str], clash: Column) -> DataFrame:
    """Rows of `current` without a row of `known` (from `history_keys`) that has the same key
    and meets `clash`.

    The join exchanges both sides anew, also where `known` was just grouped. That is small
    beside the articles, and only so can adaptive execution split a key that very many
    articles share.
    """
    return current.join(known, same_key(keys) & clash, "left_anti")


def last_per_key(df: DataFrame, keys: Sequence[str], ord_col: str) -> DataFrame:
    """The last row of each key. Spark keeps one row per key and task before the exchange."""
    window = Window.partitionBy(*keys).orderBy(F.col(ord_col).desc())
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; a report, nothing is removed.

    Digests are counted; the keys themselves are read only where they repeat.
    """
    digest = key_digest(keys)
    counts = df.groupBy(digest.alias("__key")).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
    named = df.select(*keys).join(store(counts, "repeated"), digest == F.col("__key"))
    firsts = [F.first(k).alias(k) for k in keys]
    return named.groupBy("__key").agg(*firsts, F.first("n_rows").alias("n_rows")).drop("__key")


def later_copies(df: DataFrame, key: str, ord_col: str) -> DataFrame:
    """Each row whose key occurred before it. Only digests of keys with copies enter the join."""
    first = (
        df.groupBy(key_digest([key]).alias("__key"))
        .agg(F.min(ord_col).alias("__first"), F.count("*").alias("__n"))
        .where(F.col("__n") > 1)
    )
    return df.join(
        first, same_key([key]) & (F.col(ord_col) > F.col("__first")), "left_semi"
    )
