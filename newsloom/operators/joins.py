"""Joins between article tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scores import any_relevant
from newsloom.operators.history import last_per_key
from newsloom.schemas import CRAWLED


def unite(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, by name; a column only one has is null in the other."""
    return first.unionByName(second, allowMissingColumns=True)


def merge_inner(
    left: DataFrame, right: DataFrame, on: str, suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """Inner join; columns that both sides have get a suffix instead of clashing."""
    shared = [c for c in left.columns if c in right.columns and c != on]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    return left.join(right, on)


def analysis_frame(
    embeddings: DataFrame, relevant: DataFrame, summaries: DataFrame, content: DataFrame
) -> DataFrame:
    """The four article tables side by side. All joins use one key, so that the exchange of
    one serves the next. The text of the articles is not read."""
    frame = merge_inner(embeddings, relevant, "article_id")
    frame = merge_inner(frame, summaries, "article_id")
    return merge_inner(frame, content.drop("content"), "article_id")


def attach_raw(outputs: DataFrame, raw: DataFrame, ord_col: str | None = None) -> DataFrame:
    """Model outputs with the columns of their raw article.

    Where both have a column the raw article's value holds, null aside. So the run and the
    language are the article's, while model and task are the output's: a crawled article's
    own model and task are set aside first. With `ord_col` the last copy of an id counts.
    """
    if ord_col:
        raw = last_per_key(raw, ["article_id"], ord_col).drop(ord_col)
    for c in ("model", "task_name"):
        if c in raw.columns:
            raw = raw.withColumn(
                c, F.when(F.col("crawling_source").eqNullSafe(CRAWLED), F.lit(None)).otherwise(F.col(c))
            )
    shared = [c for c in outputs.columns if c in raw.columns and c != "article_id"]
    out = outputs.withColumnsRenamed({c: f"__out_{c}" for c in shared})
    joined = out.join(raw, "article_id")
    columns = [
        F.coalesce(c, f"__out_{c}").alias(c) if c in shared else F.col(c)
        for c in [*outputs.columns, *[c for c in raw.columns if c not in outputs.columns]]
    ]
    return joined.select(*columns)


def relevant_articles(outputs: DataFrame, raw: DataFrame, ord_col: str | None = None) -> DataFrame:
    """Raw articles that some persona's score makes relevant; scores are filtered before the join."""
    return attach_raw(outputs.where(any_relevant(F.col("relevance"))), raw, ord_col)


def unmatched(outputs: DataFrame, raw: DataFrame) -> DataFrame:
    """Outputs whose article is not there, for the report."""
    return outputs.join(raw.select("article_id"), "article_id", "left_anti")


def drop_invalid(
    content: DataFrame, verdicts: DataFrame, keys: Sequence[str] = ("run_id", "article_id")
) -> DataFrame:
    """Content without the articles judged false; articles without a verdict stay."""
    false_keys = verdicts.where(~F.col("validity")).select(*keys)
    return content.join(false_keys, list(keys), "left_anti")
