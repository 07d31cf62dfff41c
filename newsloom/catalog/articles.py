"""Validation, naming, dedupe, joins, counts and batches."""

from pyspark.sql import functions as F

from newsloom.catalog.registry import ARTICLES_SQL, HITS_SQL, articles, hits, query, table
from newsloom.functions.text import (
    article_info,
    composite_key,
    format_day,
    normalize_source,
    row_json,
    split_key,
    surrogate_id,
    token_count,
)
from newsloom.functions.web import url_origin
from newsloom.operators import batching, history, joins, profile
from newsloom.operators.hits import fold_hits, hit_searches, tag_hits
from newsloom.operators.validation import REASON, has_payload, split_valid
from newsloom.plans import jobs
from newsloom.session import store


@query(
    """SELECT d.doc_id,
         nullif(concat_ws(', ', CASE WHEN d.source IS NULL THEN 'source' END,
                                CASE WHEN l.quality IS NULL THEN 'quality' END,
                                CASE WHEN l.toxic IS NULL THEN 'toxic' END), '') AS reject_reason
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
)
def validate_records(spark, sf):
    records = table(spark, sf, "documents").select("doc_id", "source").join(
        table(spark, sf, "labels"), "doc_id", "left"
    )
    # Read from both sides; the join runs once.
    valid, rejected = split_valid(store(records, "records"), ["source", "quality", "toxic"])
    return valid.select("doc_id", F.lit(None).cast("string").alias(REASON)).unionByName(
        rejected.select("doc_id", REASON)
    )


@query("SELECT doc_id, lang FROM documents WHERE text IS NOT NULL AND text <> ''")
def drop_empty(spark, sf):
    return table(spark, sf, "documents").where(has_payload("text")).dropna(subset=["source"]).select(
        "doc_id", "lang"
    )


@query("SELECT page_id, array_to_string(string_split(url, '/')[1:3], '/') AS origin FROM pages")
def page_origin(spark, sf):
    return table(spark, sf, "pages").select("page_id", url_origin(F.col("url")).alias("origin"))


@query(
    """SELECT replace(trim(string_split(string_split(url, 'https://')[2], '/')[1]), 'www.', '')
         AS source_name, url
       FROM pages WHERE contains(url, 'https://')"""
)
def register_sources(spark, sf):
    return jobs.register_sources(table(spark, sf, "pages").select("url"), "url")[0]


@query(
    """SELECT source_name, count(*) AS n_rows FROM (
         SELECT replace(trim(string_split(string_split(url, 'https://')[2], '/')[1]), 'www.', '')
           AS source_name
         FROM pages WHERE contains(url, 'https://'))
       GROUP BY source_name HAVING count(*) > 1"""
)
def repeated_source_names(spark, sf):
    return jobs.register_sources(table(spark, sf, "pages").select("url"), "url")[1]


@query("SELECT p_partkey, replace(lower(p_name), ' ', '_') AS source_name FROM part")
def normalized_names(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", normalize_source(F.col("p_name")).alias("source_name")
    )


@query(
    r"""SELECT doc_id, CASE lang
         WHEN 'en' THEN 'keywords: ' || array_to_string(string_split(text, ' '), ', ') || chr(10)
         WHEN 'fr' THEN text END AS article_info
       FROM documents"""
)
def describe_articles(spark, sf):
    kind = F.when(F.col("lang") == "en", "jina").when(F.col("lang") == "fr", "ddgs").otherwise("feed")
    return table(spark, sf, "documents").select(
        "doc_id", article_info(kind, F.split("text", " "), F.col("text")).alias("article_info")
    )


@query(
    """SELECT doc_id, key, CASE WHEN lang <> 'es' THEN 'RUNID_' || (doc_id % 4) END AS run_id,
         CASE WHEN lang <> 'es' THEN 'check_v0' END AS task_name,
         CASE WHEN lang <> 'es' THEN item END AS item_id
       FROM (SELECT doc_id, lang, item, 'RUNID_' || (doc_id % 4) || '--check_v0--' || item AS key
             FROM (SELECT doc_id, lang, CASE WHEN lang = 'es' THEN source || '--' || doc_id
                                             ELSE source || '_' || doc_id END AS item
                   FROM documents))"""
)
def composite_keys(spark, sf):
    docs = table(spark, sf, "documents").withColumn(
        "run_id", F.concat(F.lit("RUNID_"), (F.col("doc_id") % 4).cast("string"))
    )
    joint = F.when(F.col("lang") == "es", "--").otherwise("_")
    item = F.concat("source", joint, F.col("doc_id").cast("string"))
    keyed = docs.select("doc_id", composite_key(F.col("run_id"), F.lit("check_v0"), item).alias("key"))
    return keyed.select("doc_id", "key", split_key(F.col("key")).alias("p")).select(
        "doc_id", "key", "p.run_id", "p.task_name", "p.item_id"
    )


@query(
    """SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k
       FROM events"""
)
def row_json_round_trip(spark, sf):
    line = row_json("event_id", "event_type", "value", F.from_json("props", "k bigint").alias("props"))
    row = F.from_json(line, "event_id bigint, event_type string, value double, props struct<k: bigint>")
    return table(spark, sf, "events").select(row.alias("r")).select(
        "r.event_id", "r.event_type", "r.value", "r.props.k"
    )


@query(
    """SELECT page_id, 'site_' || sha256(concat_ws(chr(1), 'RUNID_1', url)) AS article_id FROM pages"""
)
def surrogate_ids(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", surrogate_id(F.lit("site"), F.lit("RUNID_1"), F.col("url")).alias("article_id")
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS publish_date FROM orders")
def publish_days(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", format_day(F.col("o_orderdate")).alias("publish_date")
    )


@query(
    """SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN 'unscored' ELSE 'scored' END AS state,
         coalesce(l.quality, -1) AS quality
       FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
)
def null_guards(spark, sf):
    scored = table(spark, sf, "documents").select("doc_id").join(
        table(spark, sf, "labels"), "doc_id", "left"
    )
    return scored.select(
        "doc_id",
        F.when(F.col("quality").isNull(), "unscored").otherwise("scored").alias("state"),
        F.coalesce("quality", F.lit(-1)).alias("quality"),
    )


@query(
    f"""SELECT a.doc_id, a.run_id, a.article_language FROM {ARTICLES_SQL} a
       WHERE NOT EXISTS (SELECT 1 FROM {ARTICLES_SQL} b
         WHERE a.article_title IS NOT DISTINCT FROM b.article_title
           AND a.source_name IS NOT DISTINCT FROM b.source_name AND a.run_id <> b.run_id)"""
)
def dedupe_history(spark, sf):
    rows = articles(spark, sf)
    return history.new_articles(rows, rows).select("doc_id", "run_id", "article_language")


@query(
    f"""SELECT a.doc_id, CASE WHEN a.doc_id % 8 = 0 THEN 'ddgs' ELSE 'jina' END AS crawling_source FROM {ARTICLES_SQL} a
       WHERE a.run_id = 'RUNID_0' AND NOT EXISTS (SELECT 1 FROM {ARTICLES_SQL} b
         WHERE a.article_title IS NOT DISTINCT FROM b.article_title
           AND a.source_name IS NOT DISTINCT FROM b.source_name AND b.run_id <> 'RUNID_0')"""
)
def combined_run(spark, sf):
    """The dedupe job of one run: both crawls together, against the pruned history."""
    rows = articles(spark, sf)
    current = rows.where("run_id = 'RUNID_0'")
    searched, crawled = current.where("doc_id % 8 = 0"), current.where("doc_id % 8 <> 0")
    return jobs.combine_and_dedupe(searched, crawled, rows).select("doc_id", "crawling_source")


@query(
    f"""SELECT a.doc_id FROM {ARTICLES_SQL} a
       WHERE NOT EXISTS (SELECT 1 FROM {ARTICLES_SQL} b
         WHERE a.article_title = b.article_title AND a.run_id <> b.run_id)"""
)
def dedupe_title(spark, sf):
    rows = articles(spark, sf)
    return history.new_articles(rows, rows, ["article_title"]).select("doc_id")


@query(
    """SELECT event_id, user_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""
)
def last_wins(spark, sf):
    return history.last_per_key(
        table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"),
        ["user_id"],
        "event_id",
    )


@query("SELECT text, count(*) AS n_rows FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_report(spark, sf):
    return history.duplicate_keys(table(spark, sf, "documents"), ["text"])


@query(
    """SELECT doc_id, source FROM documents
       QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1"""
)
def later_copies(spark, sf):
    return history.later_copies(
        table(spark, sf, "documents").select("doc_id", "source", "text"), "text", "doc_id"
    ).select("doc_id", "source")


@query(
    """SELECT e.vec_id AS article_id, e.label, d.run_id AS run_id_x, d.lang AS model_x, d.source,
         l.run_id AS run_id_y, l.model AS model_y, c.title
       FROM embeddings e
       JOIN (SELECT *, 'RUNID_' || (doc_id % 4) AS run_id FROM documents) d ON d.doc_id = e.vec_id
       JOIN (SELECT doc_id, 'RUNID_' || quality AS run_id, 'm' || toxic AS model FROM labels) l
         ON l.doc_id = e.vec_id
       JOIN (SELECT conv_id, text AS title FROM conversations) c ON c.conv_id = e.vec_id"""
)
def four_way_join(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    embeddings = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "label")
    run = F.concat(F.lit("RUNID_"), (F.col("doc_id") % 4).cast("string"))
    relevant = docs.select(
        F.col("doc_id").alias("article_id"), run.alias("run_id"), F.col("lang").alias("model"), "source"
    )
    summaries = labels.select(
        F.col("doc_id").alias("article_id"),
        F.concat(F.lit("RUNID_"), F.col("quality").cast("string")).alias("run_id"),
        F.concat(F.lit("m"), F.col("toxic").cast("string")).alias("model"),
    )
    content = table(spark, sf, "conversations").select(
        F.col("conv_id").alias("article_id"), F.col("text").alias("title"), F.col("role").alias("content")
    )
    return joins.analysis_frame(embeddings, relevant, summaries, content)


@query(
    """SELECT n_name, count(*) AS n_lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
       JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name"""
)
def joined_counts(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_quantity")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey")
    )
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey")
    )
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    # Orders meet their small dimensions before the large lines.
    dims = joins.merge_inner(joins.merge_inner(orders, customers, "custkey"), nations, "nationkey")
    return (
        joins.merge_inner(lines, dims.select("orderkey", "n_name"), "orderkey")
        .groupBy("n_name")
        .agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))
    )


@query(
    """SELECT doc_id, text AS article_title, NULL AS article_url, lang AS article_language,
         'jina' AS crawling_source FROM documents
       UNION ALL SELECT page_id, NULL, url, NULL, 'ddgs' FROM pages"""
)
def union_sources(spark, sf):
    crawled = table(spark, sf, "documents").select(
        "doc_id", F.col("text").alias("article_title"), F.col("lang").alias("article_language"),
        F.lit("jina").alias("crawling_source"),
    )
    searched = table(spark, sf, "pages").select(
        F.col("page_id").alias("doc_id"), F.col("url").alias("article_url"),
        F.lit("ddgs").alias("crawling_source"),
    )
    return joins.unite(searched, crawled)


@query(
    """SELECT 'd' || doc_id AS article_id, text AS article_title, source AS article_url,
         'keywords: ' || array_to_string(string_split(text, ' '), ', ') || chr(10) AS article_info
       FROM documents UNION ALL SELECT 'p' || page_id, url, url, html FROM pages"""
)
def unify_sources(spark, sf):
    none = F.lit(None).cast("string")
    crawled = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("article_id"),
        F.col("text").alias("article_title"),
        F.col("source").alias("article_url"),
        article_info(F.lit("jina"), F.split("text", " "), none).alias("article_info"),
    )
    searched = table(spark, sf, "pages").select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("article_id"),
        F.col("url").alias("article_title"),
        F.col("url").alias("article_url"),
        article_info(F.lit("ddgs"), F.array().cast("array<string>"), F.col("html")).alias("article_info"),
    )
    return joins.unite(searched, crawled)


_FIRSTS = ", ".join(
    f"arg_min({c}, ord) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in ("date", "title", "body", "image", "source")
)


@query(
    f"SELECT url, {_FIRSTS} FROM {HITS_SQL} GROUP BY url"
)
def consolidate_hits(spark, sf):
    return fold_hits(hits(spark, sf))


@query(
    f"""SELECT url, h.date, h.title, h.body, h.image, h.source, p.ord, p.persona, p.query
       FROM (SELECT url, {_FIRSTS} FROM {HITS_SQL} GROUP BY url) h
       JOIN (SELECT url, ord, persona, query FROM {HITS_SQL}) p USING (url)"""
)
def consolidate_hits_in_parts(spark, sf):
    """The two tables that hits are folded into, joined again."""
    found = hits(spark, sf)
    return fold_hits(found).join(hit_searches(found), "url")


@query(
    f"""SELECT 'RUNID_1' AS run_id,
         replace(lower(source), ' ', '_') || '_' || sha256('RUNID_1' || chr(1) || url) AS article_id,
         ord, persona AS query_original_personas, query AS ddgs_search_query
       FROM {HITS_SQL} JOIN (SELECT url, {_FIRSTS} FROM {HITS_SQL} GROUP BY url) f USING (url)
       WHERE f.date IS NOT NULL AND f.title IS NOT NULL AND f.body IS NOT NULL""".replace("lower(source)", "lower(f.source)")
)
def article_searches(spark, sf):
    """Who found each valid article, by what query."""
    found = hits(spark, sf)
    articles = jobs.consolidate_hits(found, "RUNID_1", "2025-01-01 00:00:00").table
    return jobs.searches_of(found, articles)


@query(
    f"""SELECT 'RUNID_1' AS run_id, replace(lower(source), ' ', '_') AS source_name, url AS source_url,
         replace(lower(source), ' ', '_') || '_' || sha256('RUNID_1' || chr(1) || url) AS article_id,
         date AS article_date, title AS article_title, url AS article_url, body AS article_body,
         image AS article_image_url, 'es' AS article_language, '2025-01-01 00:00:00' AS crawled_at,
         nullif(concat_ws(', ', CASE WHEN date IS NULL THEN 'article_date' END,
           CASE WHEN title IS NULL THEN 'article_title' END,
           CASE WHEN body IS NULL THEN 'article_body' END), '') AS reject_reason,
         n_personas
       FROM (SELECT url, {_FIRSTS}, count(*) AS n_personas FROM {HITS_SQL} GROUP BY url)"""
)
def searched_articles(spark, sf):
    outcome = jobs.consolidate_hits(hits(spark, sf), "RUNID_1", "2025-01-01 00:00:00")
    rows = outcome.table.withColumn(REASON, F.lit(None).cast("string")).unionByName(outcome.rejected)
    searches = jobs.searches_of(hits(spark, sf), rows).groupBy("article_id").agg(F.count("*").alias("n_personas"))
    return rows.join(searches, "article_id")


@query(
    f"""SELECT k.source AS persona, h.query, h.ord FROM (SELECT DISTINCT source, lang FROM documents) k
       JOIN (SELECT ord, persona AS query FROM {HITS_SQL}) h ON h.query = k.lang"""
)
def keyword_fanout(spark, sf):
    keywords = table(spark, sf, "documents").groupBy(F.col("source").alias("persona")).agg(
        F.collect_set("lang").alias("keywords")
    )
    found = hits(spark, sf).select("ord", F.col("persona").alias("query"))
    return tag_hits(found, keywords)


@query(
    f"""SELECT persona AS perfil, url AS article_source, count(*) AS count FROM {HITS_SQL}
       GROUP BY ALL"""
)
def source_profile(spark, sf):
    posts = hits(spark, sf).select(F.col("persona").alias("perfil"), F.col("image").alias("link"))
    return profile.source_counts(posts)


@query(
    f"""SELECT perfil, count(*) AS count FROM (
         SELECT persona AS perfil, url FROM {HITS_SQL} GROUP BY ALL HAVING count(*) > 1)
       GROUP BY perfil"""
)
def profiles_with_repeats(spark, sf):
    posts = hits(spark, sf).select(
        F.col("persona").alias("perfil"), F.lit("").alias("copy"), F.col("image").alias("link")
    )
    return jobs.profile_past_posts(posts)["profiles_with_repeats"]


@query(
    f"""SELECT ord, image FROM {HITS_SQL}
       WHERE persona = 'en' AND regexp_matches(image, 'spam.farm') AND contains(image, 'example.org')"""
)
def matching_links(spark, sf):
    """A regular expression, whose dot matches any character, and a literal."""
    return hits(spark, sf).where(
        (F.col("persona") == "en") & F.col("image").rlike("spam.farm") & F.contains("image", F.lit("example.org"))
    ).select("ord", "image")


@query("SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY ALL")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "events"), "event_type")


@query("SELECT user_id, count(nullif(event_type, 'error')) AS count FROM events GROUP BY user_id")
def count_present(spark, sf):
    events = table(spark, sf, "events").withColumn("ok", F.nullif("event_type", F.lit("error")))
    return profile.count_present(events, "user_id", "ok")


@query(
    f"""SELECT persona AS perfil, row_number() OVER (PARTITION BY persona ORDER BY url) - 1 AS pos,
         url AS article_source
       FROM (SELECT DISTINCT persona, url FROM {HITS_SQL})"""
)
def distinct_sources(spark, sf):
    posts = hits(spark, sf).select(F.col("persona").alias("perfil"), F.col("url").alias("article_source"))
    return profile.distinct_values(posts, "perfil", "article_source")


@query("SELECT DISTINCT source FROM documents")
def distinct_values(spark, sf):
    return table(spark, sf, "documents").select("source").distinct()


@query(f"SELECT run_id, count(*) AS n_rows FROM {ARTICLES_SQL} GROUP BY run_id")
def row_counts(spark, sf):
    return articles(spark, sf).groupBy("run_id").agg(F.count("*").alias("n_rows"))


@query("SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5")
def preview(spark, sf):
    return profile.top_k(table(spark, sf, "documents").select("doc_id", "lang", "source"), [F.asc("doc_id")], 5)


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS publish_date FROM orders
       ORDER BY publish_date DESC NULLS LAST, o_orderkey LIMIT 1"""
)
def latest_article(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", format_day(F.col("o_orderdate")).alias("publish_date")
    )
    return profile.latest_article(orders, tie="o_orderkey")


@query("SELECT doc_id, source, lang FROM documents WHERE source = 'src7' ORDER BY doc_id LIMIT 1 OFFSET 3")
def pick_row(spark, sf):
    docs = table(spark, sf, "documents").where(F.col("source") == "src7").select("doc_id", "source", "lang")
    return profile.pick(docs, [F.asc("doc_id")], 3)


@query(
    """SELECT doc_id, source, lang FROM documents
       QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 3"""
)
def pick_per_source(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return profile.pick_per_group(docs, ["source"], [F.asc("doc_id")], 2)


@query(
    """SELECT 'RUNID_' || user_id AS "RUNID", coalesce(nullif(event_type, 'view'), 'unknown') AS status,
         event_id, user_id AS run_no
       FROM events ORDER BY user_id DESC, event_id DESC LIMIT 1"""
)
def latest_run(spark, sf):
    ledger = table(spark, sf, "events").select(
        F.concat(F.lit("RUNID_"), F.col("user_id").cast("string")).alias("RUNID"),
        F.nullif("event_type", F.lit("view")).alias("status"),
        "event_id",
    )
    return profile.latest_run(ledger, "event_id")


@query(
    """SELECT 'RUNID_1--check_v0_BATCHFILE_' || doc_id || '.jsonl' AS name, doc_id AS file_no
       FROM documents"""
)
def files_by_number(spark, sf):
    names = table(spark, sf, "documents").select(
        F.concat(
            F.lit("RUNID_1--check_v0_BATCHFILE_"), F.col("doc_id").cast("string"), F.lit(".jsonl")
        ).alias("name")
    )
    return profile.by_number(names, "name")


@query(
    """SELECT user_id, n_running, n_completed, n_error,
         CASE WHEN n_running > 0 THEN 'WAIT' WHEN n_error = n_completed + n_error THEN 'ALL_ERROR_END'
              ELSE 'ALL_COMPLETED_CONTINUE' END AS status,
         120 * n_running AS wait_time
       FROM (SELECT user_id,
               count(*) FILTER (WHERE event_type = 'click' AND value > 30) AS n_running,
               count(*) FILTER (WHERE NOT (event_type = 'click' AND value > 30) AND value > 5) AS n_completed,
               count(*) FILTER (WHERE NOT (event_type = 'click' AND value > 30) AND event_type = 'error')
                 AS n_error
             FROM events GROUP BY user_id)"""
)
def batch_status(spark, sf):
    waiting = (F.col("event_type") == "click") & (F.col("value") > 30)
    batches = table(spark, sf, "events").select(
        "user_id",
        F.when(waiting, "in_progress").otherwise("completed").alias("status"),
        F.when(F.col("value") > 5, F.col("props")).otherwise(" \n").alias("output"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
    )
    return profile.batch_status(batches, ["user_id"]).withColumn(
        "wait_time", F.coalesce("wait_time", F.lit(0))
    )


@query(
    """SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos,
         (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS batch_no
       FROM documents"""
)
def assign_batches(spark, sf):
    return batching.assign_batches(table(spark, sf, "documents").select("doc_id"), ["doc_id"])


@query(
    f"""SELECT doc_id, run_id, row_number() OVER w - 1 AS pos, (row_number() OVER w - 1) // 200 AS batch_no
       FROM {ARTICLES_SQL} WINDOW w AS (PARTITION BY run_id ORDER BY doc_id)"""
)
def assign_batches_per_run(spark, sf):
    return batching.assign_batches(articles(spark, sf).select("doc_id", "run_id"), ["doc_id"], ["run_id"])


_COUNTED_SQL = r"""SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n,
    len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) AS token_count FROM documents"""


def _counted(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", "lang", token_count(F.col("text")).alias("token_count")
    )


@query(
    f"""WITH RECURSIVE c AS MATERIALIZED ({_COUNTED_SQL}),
       f AS (
         SELECT doc_id, lang, n, token_count, CAST(token_count > 8000 AS BIGINT) AS chunk_no,
           CASE WHEN token_count > 8000 THEN 0 ELSE token_count END AS running FROM c WHERE n = 1
         UNION ALL
         SELECT c.doc_id, c.lang, c.n, c.token_count,
           f.chunk_no + CAST(f.running + c.token_count > 8000 AS BIGINT),
           CASE WHEN f.running + c.token_count > 8000 THEN 0 ELSE f.running + c.token_count END
         FROM f JOIN c ON c.lang = f.lang AND c.n = f.n + 1)
       SELECT doc_id, lang, token_count, chunk_no FROM f"""
)
def token_chunks(spark, sf):
    return batching.token_chunks(_counted(spark, sf), ["lang"], ["doc_id"])


@query(
    f"""WITH RECURSIVE c AS MATERIALIZED ({_COUNTED_SQL}),
       f AS (
         SELECT doc_id, lang, n, token_count, CAST(0 AS BIGINT) AS chunk_no, token_count AS running
         FROM c WHERE n = 1
         UNION ALL
         SELECT c.doc_id, c.lang, c.n, c.token_count,
           f.chunk_no + CAST(f.running + c.token_count > 8000 AS BIGINT),
           CASE WHEN f.running + c.token_count > 8000 THEN c.token_count
                ELSE f.running + c.token_count END
         FROM f JOIN c ON c.lang = f.lang AND c.n = f.n + 1)
       SELECT doc_id, lang, token_count, chunk_no FROM f"""
)
def token_chunks_strict(spark, sf):
    """Over blocks so short that chunks run across them."""
    return batching.token_chunks(
        _counted(spark, sf), ["lang"], ["doc_id"], count_opener=True, block_rows=50
    )
