"""Search hits: tag them with who searched, and fold them into one article per URL."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import normalize_source, surrogate_id
from newsloom.functions.web import url_origin
from newsloom.schemas import RAW_ARTICLES_SEARCHED

HEAD = ["date", "title", "body", "image", "source"]

# Hit columns under the names they have as articles.
ARTICLE_NAMES = {
    "title": "article_title",
    "url": "article_url",
    "body": "article_body",
    "image": "article_image_url",
    "source": "source_name",
    "date": "article_date",
}
SEARCH_NAMES = {"query": "ddgs_search_query", "persona": "query_original_personas"}


def keyword_table(persona_keywords: DataFrame) -> DataFrame:
    """(persona, query) rows of a persona -> keywords table."""
    return persona_keywords.select("persona", F.explode("keywords").alias("query"))


def tag_hits(hits: DataFrame, persona_keywords: DataFrame) -> DataFrame:
    """One row per hit and persona that searched for its query.

    The keyword side is left to the size check of the planner: it is broadcast while small
    and shuffled beyond that, where a query with very many hits is split at run time.
    """
    return hits.join(keyword_table(persona_keywords), "query")


def fold_hits(hits: DataFrame, ord_col: str = "ord") -> DataFrame:
    """One row per URL: of each column the first value that is not null. Hits without URL are
    dropped. Columns may come from different hits.

    The searches that found a URL are a table of their own (`hit_searches`), since a URL may
    have any number of them.
    """
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ord_col))).alias(c) for c in HEAD]
    return hits.where(F.col("url").isNotNull()).groupBy("url").agg(*firsts)


def hit_searches(hits: DataFrame, ord_col: str = "ord") -> DataFrame:
    """(url, ord, persona, query) of all hits with a URL: who found it by what, with repeats."""
    return hits.where(F.col("url").isNotNull()).select("url", F.col(ord_col).alias("ord"), "persona", "query")


def article_searches(hits: DataFrame, articles: DataFrame) -> DataFrame:
    """`hit_searches` by the article of the URL, for the articles of one run."""
    known = articles.select("run_id", "article_id", "article_url")
    return (
        hit_searches(hits)
        .join(known, F.col("url") == F.col("article_url"))
        .select("run_id", "article_id", "ord", "persona", "query")
        .withColumnsRenamed(SEARCH_NAMES)
    )


def hits_to_articles(
    folded: DataFrame, run_id: str, crawled_at: str, language: str = "es"
) -> DataFrame:
    """Folded hits in the columns of a searched article; hits without a source are dropped."""
    named = (
        folded.withColumn("source_url", url_origin(F.col("url")))
        .withColumn("source", normalize_source(F.col("source")))
        .where(F.col("source").isNotNull())
        .withColumn("run_id", F.lit(run_id))
        .withColumn("article_id", surrogate_id(F.col("source"), F.lit(run_id), F.col("url")))
        .withColumn("crawled_at", F.lit(crawled_at))
        .withColumn("article_language", F.lit(language))
        .withColumnsRenamed(ARTICLE_NAMES)
    )
    names = [field.split()[0] for field in RAW_ARTICLES_SEARCHED.split(", ")]
    return named.select(*names)
