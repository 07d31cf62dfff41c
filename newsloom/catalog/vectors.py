"""Distances, neighbours, topics and projection."""

from pyspark.sql import functions as F

from newsloom.catalog.registry import query, table
from newsloom.functions.vectors import squared_l2
from newsloom.operators import cells, neighbours, terms, topics
from newsloom.session import scratch_path, spread, store

_CENTROID_SQL = """SELECT list(m ORDER BY i) AS q FROM (
    SELECT i, avg(CAST(v AS DOUBLE)) AS m
    FROM (SELECT unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY i)"""
_LABEL_CENTROIDS_SQL = """SELECT label, list(m ORDER BY i) AS q FROM (
    SELECT label, i, avg(CAST(v AS DOUBLE)) AS m
    FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label"""
_DISTANCE_SQL = """list_sum(list_transform(list_zip(CAST(e.embedding AS DOUBLE[]), q),
    lambda p: (p[1] - p[2]) * (p[1] - p[2])))"""


def _rounded(df):
    return df.withColumn("distance", F.round("distance", 6))


def _label_centroids(df):
    """One query vector per label: the mean of its vectors."""
    means = (
        df.select("label", F.posexplode("embedding").alias("i", "v"))
        .groupBy("label", "i")
        .agg(F.avg(F.col("v").cast("double")).alias("m"))
        .groupBy("label")
        .agg(F.sort_array(F.collect_list(F.struct("i", "m")))["m"].alias("q"))
    )
    # Stored, so that the planner knows how few they are.
    return store(means, "centroids")


@query(
    """SELECT i, round(avg(CAST(v AS DOUBLE)), 6) AS mean
       FROM (SELECT unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
       GROUP BY i"""
)
def centroid(spark, sf):
    return (
        neighbours.centroid(table(spark, sf, "embeddings"))
        .select(F.posexplode("centroid").alias("i", "mean"))
        .select(F.col("i").cast("bigint").alias("i"), F.round("mean", 6).alias("mean"))
    )


@query(
    f"""SELECT vec_id, round({_DISTANCE_SQL}, 6) AS distance
       FROM embeddings e JOIN ({_LABEL_CENTROIDS_SQL}) c ON c.label = e.label"""
)
def distance_to_label(spark, sf):
    df = table(spark, sf, "embeddings")
    return _rounded(
        df.join(_label_centroids(df), "label").select(
            "vec_id", squared_l2(F.col("embedding"), F.col("q")).alias("distance")
        )
    )


@query(
    f"""SELECT vec_id, round({_DISTANCE_SQL}, 6) AS distance, row_number() OVER (ORDER BY
           {_DISTANCE_SQL}, vec_id) AS rank
       FROM embeddings e, ({_CENTROID_SQL}) QUALIFY rank <= 5"""
)
def nearest_to_centroid(spark, sf):
    return _rounded(neighbours.nearest_to_centroid(table(spark, sf, "embeddings"), "vec_id"))


@query(
    f"""SELECT c.label, vec_id, round({_DISTANCE_SQL}, 6) AS distance,
         row_number() OVER (PARTITION BY c.label ORDER BY {_DISTANCE_SQL}, vec_id) AS rank
       FROM embeddings e, ({_LABEL_CENTROIDS_SQL}) c QUALIFY rank <= 5"""
)
def nearest_to_queries(spark, sf):
    df = table(spark, sf, "embeddings")
    return _rounded(
        neighbours.nearest(df, _label_centroids(df), "vec_id", "label", query_vector="q")
    )


@query(
    f"""SELECT query_id, vec_id, round({_DISTANCE_SQL}, 6) AS distance,
         row_number() OVER (PARTITION BY query_id ORDER BY {_DISTANCE_SQL}, vec_id) AS rank
       FROM embeddings e, (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q FROM embeddings)
       QUALIFY rank <= 5"""
)
def nearest_of_all(spark, sf):
    """Every vector as a query: more queries than may be sent to every task."""
    df = table(spark, sf, "embeddings")
    queries = df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    return _rounded(
        neighbours.nearest(
            df, queries, "vec_id", "query_id", query_vector="q", max_query_bytes=10_000
        )
    )


@query(
    f"""SELECT query_id, vec_id, round({_DISTANCE_SQL}, 6) AS distance,
         row_number() OVER (PARTITION BY query_id ORDER BY {_DISTANCE_SQL}, vec_id) AS rank
       FROM embeddings e, (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q FROM embeddings)
       QUALIFY rank <= 5"""
)
def nearest_by_cells(spark, sf):
    """Every vector as a query to an index by cells."""
    df = table(spark, sf, "embeddings")
    index = cells.build_cells(df, "vec_id", "embedding", scratch_path(spark, "cells"), cells=40)
    queries = df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    return _rounded(cells.nearest_in_cells(index, queries, "vec_id", "query_id", "q"))


@query(
    """SELECT vec_id, len(embedding) AS dimensions, CAST(list_slice(embedding, 2, 3)[2] AS DOUBLE) AS third,
         CAST(embedding[1] AS DOUBLE) AS first, ceil((vec_id + 1) / 200.0) AS n_batches FROM embeddings"""
)
def array_math(spark, sf):
    vector = F.col("embedding")
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.size(vector).cast("bigint").alias("dimensions"),
        F.get(F.slice(vector, 2, 2), F.lit(1)).cast("double").alias("third"),
        F.get(vector, F.lit(0)).cast("double").alias("first"),
        F.ceil((F.col("vec_id") + 1) / 200).cast("double").alias("n_batches"),
    )


@query()
def assign_topics(spark, sf):
    return topics.assign_topics(table(spark, sf, "embeddings")).select("vec_id", "topic")


@query()
def project(spark, sf):
    return topics.project(table(spark, sf, "embeddings")).select("vec_id", "label", "x", "y", "z")


def _vectors_sql(name, id_col, table_name):
    """Views `name` (id, dim, x): the non-zero entries of the vectors of a table's texts, with the
    rarity of words in `documents`."""
    return rf"""
       {name}_words AS (
         SELECT {id_col}, b, count(*) AS times FROM (
           SELECT {id_col}, unnest(list_transform(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'),
             lambda w: ('0x' || substr(md5(w), 1, 4))::INT)) AS b FROM {table_name})
         GROUP BY ALL),
       {name}_sums AS (
         SELECT {id_col}, b % 256 AS dim,
           sum(times * ln(((SELECT count(*) FROM documents) + 1) / (coalesce(n, 0) + 1))) AS x
         FROM {name}_words LEFT JOIN held USING (b) GROUP BY ALL),
       {name} AS (
         SELECT {id_col}, dim, CAST(x / sqrt(sum(x * x) OVER (PARTITION BY {id_col})) AS FLOAT) AS x
         FROM {name}_sums)"""


_HELD_SQL = r"""held AS (
         SELECT b, count(*) AS n FROM (
           SELECT DISTINCT doc_id, unnest(list_transform(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'),
             lambda w: ('0x' || substr(md5(w), 1, 4))::INT)) AS b FROM documents)
         GROUP BY b)"""
_WHOLE_SQL = """(SELECT {id_col}, list_transform(range(0, 256), lambda d: coalesce(m[d], 0)::DOUBLE) AS {vector}
         FROM (SELECT {id_col}, map(list(dim), list(x)) AS m FROM {name} GROUP BY ALL))"""


@query(
    f"""WITH {_HELD_SQL}, {_vectors_sql("d", "doc_id", "documents")}, {_vectors_sql("q", "item_id", "benchmark")}
       SELECT item_id, doc_id, round({_DISTANCE_SQL}, 6) AS distance,
         row_number() OVER (PARTITION BY item_id ORDER BY {_DISTANCE_SQL}, doc_id) AS rank
       FROM {_WHOLE_SQL.format(id_col="doc_id", vector="embedding", name="d")} e,
         {_WHOLE_SQL.format(id_col="item_id", vector="q", name="q")}
       QUALIFY rank <= 5"""
)
def search_texts(spark, sf):
    """The documents nearest to each benchmark text, both embedded alike."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    embed = terms.text_embedder(docs, "text")
    corpus = embed(spread(docs), "text", "embedding").select("doc_id", "embedding")
    queries = embed(table(spark, sf, "benchmark"), "text", "query").select("item_id", "query")
    return _rounded(neighbours.nearest(corpus, queries, "doc_id", "item_id", query_vector="query"))


@query(
    f"""WITH {_HELD_SQL}, {_vectors_sql("d", "doc_id", "documents")}
       SELECT doc_id, dim, round(CAST(x AS DOUBLE), 5) AS value FROM d WHERE x <> 0"""
)
def embed_texts(spark, sf):
    """The non-zero entries of each document's vector."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    embedded = terms.text_embedder(docs, "text")(spread(docs), "text", "embedding")
    each = embedded.select("doc_id", F.posexplode("embedding").alias("dim", "value")).where("value <> 0")
    return each.select("doc_id", "dim", F.round(F.col("value").cast("double"), 5).alias("value"))


@query(
    r"""SELECT b AS bucket, count(*) AS n_texts FROM (
         SELECT DISTINCT doc_id, unnest(list_transform(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'),
           lambda w: ('0x' || substr(md5(w), 1, 4))::INT)) AS b FROM documents)
       GROUP BY b
       UNION ALL SELECT -1, count(*) FROM documents"""
)
def term_counts(spark, sf):
    """The counts of each language's texts, added up."""
    docs = table(spark, sf, "documents")
    english, others = docs.where("lang = 'en'"), docs.where("lang <> 'en'")
    return terms.add_counts(terms.document_counts(english, "text"), terms.document_counts(others, "text"))


@query(
    f"""SELECT vec_id, round({_DISTANCE_SQL}, 6) AS distance, row_number() OVER (ORDER BY
           {_DISTANCE_SQL}, vec_id) AS rank
       FROM (SELECT * FROM embeddings WHERE vec_id % 7 > 2) e,
         ({_CENTROID_SQL.replace("FROM embeddings)", "FROM embeddings WHERE vec_id % 7 > 2)")})
       QUALIFY rank <= 5
       UNION ALL SELECT vec_id, NULL, -1 FROM embeddings WHERE vec_id % 7 <= 2"""
)
def nearest_among_faulty(spark, sf):
    """Vectors that are null, not finite or too short are left out, and reported."""
    df = table(spark, sf, "embeddings")
    kind, nan = F.col("vec_id") % 7, F.lit(float("nan")).cast("float")
    broken = df.withColumn(
        "embedding",
        F.when(kind == 0, None).when(kind == 1, F.transform("embedding", lambda x: nan))
        .when(kind == 2, F.concat("embedding", F.array(nan))).otherwise(F.col("embedding")),
    )
    found = _rounded(neighbours.nearest_to_centroid(broken, "vec_id"))
    left_out = neighbours.unusable(broken, "vec_id", length=64)
    return found.unionByName(
        left_out.select("vec_id", F.lit(None).cast("double").alias("distance"), F.lit(-1).cast("bigint").alias("rank"))
    )


@query("SELECT vec_id, true AS at_nearest_centre, 10 AS topics_used FROM embeddings")
def topic_properties(spark, sf):
    """Each vector is in the cluster whose centre is nearest, and all clusters are used."""
    df = store(topics.assign_topics(table(spark, sf, "embeddings"), centre="centre"), "topics")
    centres = store(df.select("topic", "centre").distinct(), "centres")
    found = neighbours.nearest(centres, df, "topic", "vec_id", "centre", "embedding", k=1)
    used = centres.agg(F.count("*").alias("topics_used"))
    return (
        df.select("vec_id", F.col("topic").alias("own"))
        .join(found, "vec_id")
        .select("vec_id", (F.col("own") == F.col("topic")).alias("at_nearest_centre"))
        .withColumn("topics_used", F.lit(used.first()["topics_used"]))
    )


@query("SELECT count(*) AS n, true AS centred, true AS falling, true AS uncorrelated FROM embeddings")
def projection_properties(spark, sf):
    """Components have mean 0, falling variances, and do not correlate."""
    placed = topics.project(table(spark, sf, "embeddings"))
    pairs = (("x", "y"), ("x", "z"), ("y", "z"))
    summed = placed.agg(
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"mean_{c}") for c in "xyz"],
        *[F.var_pop(c).alias(f"var_{c}") for c in "xyz"],
        *[F.corr(a, b).alias(f"corr_{a}{b}") for a, b in pairs],
    )

    def small(column):
        return F.abs(column) < 1e-6

    return summed.select(
        "n",
        (small(F.col("mean_x")) & small(F.col("mean_y")) & small(F.col("mean_z"))).alias("centred"),
        ((F.col("var_x") >= F.col("var_y")) & (F.col("var_y") >= F.col("var_z"))).alias("falling"),
        (small(F.col("corr_xy")) & small(F.col("corr_xz")) & small(F.col("corr_yz"))).alias("uncorrelated"),
    )
