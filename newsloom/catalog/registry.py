"""Registration of queries, and the test tables in the columns the operators expect."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; `sql` is what it must agree with."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Documents as articles of four runs. English ones have no source, so that null keys occur.
ARTICLES_SQL = """(
  SELECT doc_id, 'RUNID_' || (doc_id % 4) AS run_id, text AS article_title,
         nullif(lang, 'en') AS source_name, lang AS article_language
  FROM documents)"""


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.lit("RUNID_"), (F.col("doc_id") % 4).cast("string")).alias("run_id"),
        F.col("text").alias("article_title"),
        F.nullif("lang", F.lit("en")).alias("source_name"),
        F.col("lang").alias("article_language"),
    )


# Pages as search hits: the URL is the site, the persona the language of the page, the query
# the page's host without its first label. Some fields are missing.
HITS_SQL = r"""(
  SELECT page_id AS ord,
         array_to_string(string_split(url, '/')[1:3], '/') AS url,
         string_split(url, '/')[4][1:2] AS persona,
         string_split(url, '.')[-1] AS query,
         nullif(string_split(url, '/')[5], '') AS date,
         nullif(regexp_extract(url, '\?(.*)$', 1), '') AS title,
         nullif(regexp_extract(url, '#(.*)$', 1), '') AS body,
         url AS image,
         'Site ' || string_split(url, '/')[3] AS source
  FROM pages)"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    parts = F.split(url, "/")
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ord"),
        F.substring_index(url, "/", 3).alias("url"),
        F.substring(F.get(parts, F.lit(3)), 1, 2).alias("persona"),
        F.substring_index(url, ".", -1).alias("query"),
        F.nullif(F.get(parts, F.lit(4)), F.lit("")).alias("date"),
        F.nullif(F.regexp_extract(url, r"\?(.*)$", 1), F.lit("")).alias("title"),
        F.nullif(F.regexp_extract(url, r"#(.*)$", 1), F.lit("")).alias("body"),
        url.alias("image"),
        F.concat(F.lit("Site "), F.get(parts, F.lit(2))).alias("source"),
    )
