"""Links and texts of pages, validity, summaries and their token chunks."""

from pyspark.sql import functions as F

from newsloom.catalog.registry import query, table
from newsloom.functions.text import SENTENCE, sentences, token_count
from newsloom.functions.web import ERROR_BODY, html_published, html_text, html_title, page_links
from newsloom.operators import baselines, joins, tasks
from newsloom.plans import jobs
from newsloom.session import spread

# What the SQL takes for links, titles and page furniture: the forms that the test pages have.
HTML_LINK = r'(?is)<a href="([^"]*)">(.*?)</a>'
MARKDOWN_LINK = r"\[([^\[\]]+)\]\((https?://[^\s()]+)[^()]*\)"
TITLE = r"(?is)<title>(.*?)</title>"
FURNITURE = r"(?is)<(?:!--.*?-->|script.*?</script>|style.*?</style>|nav.*?</nav>|footer.*?</footer>|head>.*?</head>)"
BLOCK_END = r"(?i)<(?:/(?:p|h1|li|div)|br)>"
TAG = r"<[^>]*>"
PUBLISHED = r'<meta property="article:published_time" content="(\d{4}-\d{2}-\d{2})'
ENTITIES = [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def _decoded_sql(text):
    for entity, char in ENTITIES:
        text = f"replace({text}, {_quoted(entity)}, {_quoted(char)})"
    return text


def _replaced_sql(text, pattern, by):
    return f"regexp_replace({text}, {_quoted(pattern)}, {by}, 'g')"


def _squeezed_sql(text):
    text = _replaced_sql(text, r"[ \t\r]+", "' '")
    text = _replaced_sql(text, r" ?\n[ \n]*", "chr(10)")
    return _replaced_sql(text, r"^[ \n]+|[ \n]+$", "''")


def _all_sql(pattern, group):
    return f"regexp_extract_all(html, {_quoted(pattern)}, {group})"


_LINKS_SQL = f"""
  SELECT page_id, generate_subscripts(t, 1) - 1 AS link_no, unnest(t) AS t, unnest(u) AS url
  FROM (SELECT page_id, list_concat({_all_sql(HTML_LINK, 2)}, {_all_sql(MARKDOWN_LINK, 1)}) AS t,
          list_concat({_all_sql(HTML_LINK, 1)}, {_all_sql(MARKDOWN_LINK, 2)}) AS u FROM pages)"""
_LINK_TITLE_SQL = _squeezed_sql(_decoded_sql(_replaced_sql("t", TAG, "' '")))


@query(f"SELECT page_id, link_no, {_LINK_TITLE_SQL} AS title, url FROM ({_LINKS_SQL})")
def extract_links(spark, sf):
    return (
        spread(table(spark, sf, "pages"))
        .select("page_id", F.posexplode(page_links(F.col("html"))).alias("link_no", "link"))
        .select("page_id", F.col("link_no").cast("bigint").alias("link_no"), "link.title", "link.url")
    )


@query(
    f"""SELECT 'RUNID_1' AS run_id, 'p' || page_id AS source_name, title AS article_title,
         url AS article_url, 'p' || page_id || '_' ||
           sha256(concat_ws(chr(1), 'RUNID_1', CAST(link_no AS VARCHAR), url, title))
           AS article_id, '2025-01-01 00:00:00' AS crawled_at
       FROM (SELECT page_id, link_no, {_LINK_TITLE_SQL} AS title, url FROM ({_LINKS_SQL}))"""
)
def crawled_articles(spark, sf):
    """The whole extraction job: pages, requests, model, answers, ids, validation."""
    landed = jobs.landed_pages(
        table(spark, sf, "pages").select(
            "url",
            F.concat(F.lit("P"), F.col("page_id").cast("string")).alias("name"),
            F.col("html").alias("raw_content"),
            F.lit("2025-01-01 00:00:00").alias("crawl_time"),
        )
    )
    outcome = jobs.extract_articles(
        landed.table, "RUNID_1", "2025-01-01 00:00:00", tasks.link_task("m1"),
        baselines.links_predictor(),
    )
    return outcome.table.select(
        "run_id", "source_name", "article_title", "article_url", "article_id", "crawled_at"
    )


_ARTICLE = r"(?is)<article[^>]*>(.*)</article>"
_BODY_SQL = f"coalesce(nullif(regexp_extract(html, {_quoted(_ARTICLE)}, 1), ''), html)"
_TEXT_SQL = _squeezed_sql(
    _decoded_sql(
        _replaced_sql(
            _replaced_sql(_replaced_sql(_BODY_SQL, FURNITURE, "' '"), BLOCK_END, "chr(10)"), TAG, "' '"
        )
    )
)
_TITLE_SQL = _squeezed_sql(_decoded_sql(f"regexp_extract(html, {_quoted(TITLE)}, 1)"))
_DAY_SQL = f"nullif(regexp_extract(html, {_quoted(PUBLISHED)}, 1), '')"


@query(
    f"""SELECT page_id, {_TITLE_SQL} AS title, {_TEXT_SQL} AS content, {_DAY_SQL} AS publish_date
       FROM pages"""
)
def page_text(spark, sf):
    html = F.col("html")
    return spread(table(spark, sf, "pages")).select(
        "page_id",
        html_title(html).alias("title"),
        html_text(html).alias("content"),
        html_published(html).alias("publish_date"),
    )


@query(
    f"""SELECT CAST(page_id AS VARCHAR) AS article_id, {_TEXT_SQL} AS content, {_DAY_SQL} AS publish_date
       FROM pages WHERE {_TEXT_SQL} <> ''"""
)
def read_content(spark, sf):
    pages = table(spark, sf, "pages")
    relevant = pages.select(
        F.lit("RUNID_1").alias("run_id"), F.col("page_id").cast("string").alias("article_id"),
        F.col("url").alias("article_title"), F.col("url").alias("article_url"),
    )
    return jobs.read_content(relevant, pages).table.select("article_id", "content", "publish_date")


@query(
    f"""SELECT CAST(page_id AS VARCHAR) AS article_id, {_TEXT_SQL} AS content FROM pages WHERE {_TEXT_SQL} <> ''"""
)
def read_content_of_copies(spark, sf):
    """Pages that were downloaded twice give one content per article."""
    pages = table(spark, sf, "pages")
    relevant = pages.select(
        F.lit("RUNID_1").alias("run_id"), F.col("page_id").cast("string").alias("article_id"),
        F.col("url").alias("article_title"), F.concat_ws("#", "url", "page_id").alias("article_url"),
    )
    landed = pages.withColumn("url", F.concat_ws("#", "url", "page_id"))
    empty = landed.withColumn("html", F.lit("<p> </p>"))
    return jobs.read_content(relevant, landed.unionByName(landed).unionByName(empty)).table.select("article_id", "content")


@query(
    """SELECT doc_id AS article_id, source FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)"""
)
def valid_content(spark, sf):
    content = table(spark, sf, "documents").select(F.col("doc_id").alias("article_id"), "source")
    verdicts = table(spark, sf, "labels").select(
        F.col("doc_id").alias("article_id"), (F.col("quality") == 1).alias("validity")
    )
    return joins.drop_invalid(content, verdicts, ["article_id"])


def _valid_sql(text):
    notices = " OR ".join(f"contains(lower({text}), '{n}')" for n in baselines.NOTICES)
    return (
        f"(length({text}) >= 200 AND len(regexp_extract_all({text}, {_quoted(SENTENCE)})) >= 3 "
        f"AND NOT ({notices}) AND NOT regexp_matches({text}, {_quoted(ERROR_BODY)}))"
    )


@query(f"SELECT doc_id, {_valid_sql('text')} AS validity FROM documents")
def validity_rules(spark, sf):
    return spread(table(spark, sf, "documents")).select(
        "doc_id", baselines.is_article(F.col("text")).alias("validity")
    )


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS article_id, text AS content FROM documents
       WHERE {_valid_sql("text")}"""
)
def keep_valid(spark, sf):
    """The whole validity job."""
    content = table(spark, sf, "documents").select(
        F.lit("RUNID_1").alias("run_id"), F.col("doc_id").cast("string").alias("article_id"),
        F.col("text").alias("content"),
    )
    outcome = jobs.keep_valid(
        content, "RUNID_1", tasks.validity_task("m1"), baselines.validity_predictor()
    )
    return outcome.table.select("article_id", "content")


_LEAD_SQL = (
    f"array_to_string(list_transform(regexp_extract_all(text, {_quoted(SENTENCE)})[1:3], "
    "lambda s: trim(s, ' ')), ' ')"
)


@query(f"SELECT doc_id, {_LEAD_SQL} AS summary FROM documents")
def lead_summary(spark, sf):
    return spread(table(spark, sf, "documents")).select(
        "doc_id", baselines.lead_summary(F.col("text")).alias("summary")
    )


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS article_id, {_LEAD_SQL} AS summary,
         'baseline' AS model, 'RUNID_1' AS run_id, 'article_summarization_v0' AS task_name
       FROM documents"""
)
def summarize(spark, sf):
    content = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"), F.col("text").alias("content")
    )
    return jobs.summarize(
        content, "RUNID_1", tasks.summary_task("m1"), baselines.summary_predictor()
    ).table


# Scores, the penalty for what is said already, and the choice, from the contract alone.
_SCORED_SQL = r"""WITH RECURSIVE said AS (
         SELECT doc_id, regexp_extract_all(text, '[^.!?\s][^.!?]*[.!?]*') AS s FROM documents),
       per AS (
         SELECT doc_id, i, trim(s[i], ' ') AS s, list_transform(regexp_extract_all(lower(s[i]), '[\p{L}\p{N}]+'),
           lambda w: ('0x' || substr(md5(w), 1, 4))::INT) AS b
         FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM said)),
       pairs AS (SELECT DISTINCT doc_id, i, unnest(b) AS b FROM per),
       held AS (SELECT b, (SELECT count(*) FROM documents) // count(DISTINCT doc_id) AS share FROM pairs GROUP BY b),
       weights AS (
         SELECT doc_id, b, count(*) * (length(bin(any_value(share))) - 1) AS w
         FROM pairs JOIN held USING (b) GROUP BY doc_id, b),
       terms AS (SELECT doc_id, i, list({'b': b, 'w': w}) AS t FROM pairs JOIN weights USING (doc_id, b) GROUP BY doc_id, i),
       whole AS (
         SELECT doc_id, least(count(*), greatest(3, least(8, (count(*) + 4) // 5))) AS n,
           list({'i': i, 's': s, 'len': len(b), 't': coalesce(t, [])} ORDER BY i) AS x
         FROM per LEFT JOIN terms USING (doc_id, i) GROUP BY doc_id),
       steps AS (
         SELECT doc_id, 0 AS k, []::BIGINT[] AS taken, []::INT[] AS gone FROM whole
         UNION ALL
         SELECT doc_id, k + 1, list_append(taken, best), list_concat(gone, list_transform(x[best].t, lambda y: y.b))
         FROM (
           SELECT doc_id, k, taken, gone, x, list_position(scores, list_max(scores)) AS best
           FROM (
             SELECT doc_id, k, taken, gone, x, list_transform(x, lambda y: CASE WHEN list_contains(taken, y.i) THEN -1
               ELSE coalesce(list_sum(list_transform(list_filter(y.t, lambda z: NOT list_contains(gone, z.b)),
                                                     lambda z: z.w)), 0) * 1000 // (y.len + 10) END) AS scores
             FROM steps JOIN whole USING (doc_id) WHERE k < n)))
       SELECT CAST(d.doc_id AS VARCHAR) AS article_id, coalesce(array_to_string(list_transform(list_sort(taken),
           lambda i: x[i].s), ' '), '') AS summary, least(n, len(x)) AS n_sentences
       FROM documents d LEFT JOIN whole USING (doc_id) LEFT JOIN steps ON steps.doc_id = d.doc_id AND k = n"""


@query(_SCORED_SQL)
def scored_summaries(spark, sf):
    """The summary step with the sentences that score best among all of a text."""
    content = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"), F.col("text").alias("content")
    )
    task = tasks.summary_task("m1")
    summaries = jobs.summarize(content, "RUNID_1", task, baselines.scored_summary_predictor()).table
    sizes = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"), F.size(sentences(F.col("text"))).alias("m")
    )
    wanted = F.least("m", F.greatest(F.lit(3), F.least(F.lit(8), F.ceil(F.col("m") / 5)))).cast("bigint")
    return summaries.join(sizes, "article_id").select("article_id", "summary", wanted.alias("n_sentences"))


_CHUNKS_SQL = r"""WITH RECURSIVE c AS MATERIALIZED (
         SELECT doc_id, text, 'RUNID_1' AS run_id, row_number() OVER (ORDER BY lpad(doc_id::VARCHAR, 12, '0')) AS n,
           len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) AS token_count
         FROM documents),
       f AS (
         SELECT doc_id, text, n, token_count, CAST(token_count > 8000 AS BIGINT) AS chunk_no,
           CASE WHEN token_count > 8000 THEN 0 ELSE token_count END AS running FROM c WHERE n = 1
         UNION ALL
         SELECT c.doc_id, c.text, c.n, c.token_count,
           f.chunk_no + CAST(f.running + c.token_count > 8000 AS BIGINT),
           CASE WHEN f.running + c.token_count > 8000 THEN 0 ELSE f.running + c.token_count END
         FROM f JOIN c ON c.n = f.n + 1)"""


def _length_embedder():
    return lambda texts: [[float(len(t)), float(len(texts))] for t in texts]


@query(
    f"""{_CHUNKS_SQL}
       SELECT lpad(doc_id::VARCHAR, 12, '0') AS article_id, CAST(length(text) AS DOUBLE) AS n_chars,
         CAST(count(*) OVER (PARTITION BY chunk_no) AS DOUBLE) AS n_in_call, chunk_no
       FROM f"""
)
def embedding_calls(spark, sf):
    """Calls of a stand-in embedder that returns a text's length and the texts in its call."""
    summaries = table(spark, sf, "documents").select(
        F.lit("RUNID_1").alias("run_id"),
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("article_id"),
        F.col("text").alias("summary"),
    )
    chunks = jobs.embedding_calls(summaries)
    cut = summaries.join(chunks.drop("run_id", "token_count"), "article_id")
    vectors = tasks.embed_calls(cut, _length_embedder, "lengths")
    return vectors.join(chunks.select("article_id", "chunk_no"), "article_id").select(
        "article_id",
        F.get("summary_embedding", F.lit(0)).cast("double").alias("n_chars"),
        F.get("summary_embedding", F.lit(1)).cast("double").alias("n_in_call"),
        "chunk_no",
    )


@query(
    r"""SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) AS token_count
       FROM documents"""
)
def token_counts(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", token_count(F.col("text")).alias("token_count")
    )
