"""Scores, requests, predictors, answers, prompts and the selection."""

from pyspark.sql import functions as F

from newsloom.catalog.registry import query, table
from newsloom.functions.scores import any_relevant, contract_error, recode, score_columns
from newsloom.functions.text import escape_newlines
from newsloom.operators import baselines, joins, phrases, posts, tasks
from newsloom.operators.batching import assign_batches
from newsloom.operators.contracts import contract_fault
from newsloom.operators.validation import REASON
from newsloom.plans import jobs
from newsloom.session import spread
from newsloom.sources.writers import selection

PERSONAS = ("QUALITY", "TOXICITY")

# Words of the documents' four languages.
KEYWORDS = {
    "ANA": ["the", "and", "with"],
    "LUC": ["que", "pour", "dans"],
    "EVA": ["der", "für", "el"],
}


def _score_map():
    return F.create_map(
        F.lit(PERSONAS[0]), F.col("quality") * 2, F.lit(PERSONAS[1]), F.col("toxic") * 2
    )


def _outputs(spark, sf):
    return table(spark, sf, "labels").select(
        F.lit("m1").alias("model"),
        F.lit("RUNID_9").alias("run_id"),
        F.lit("relevance_check_v0").alias("task_name"),
        F.col("doc_id").alias("article_id"),
        _score_map().alias("relevance"),
        F.lit("ca").alias("article_language"),
    )


def _raw(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("article_id"),
        F.lit("raw").alias("model"),
        F.lit("crawl").alias("task_name"),
        F.lit("RUNID_1").alias("run_id"),
        F.nullif("lang", F.lit("de")).alias("article_language"),
        F.when(F.col("lang") == "fr", "ddgs").otherwise("jina").alias("crawling_source"),
        F.col("source").alias("source_name"),
    )


@query(
    """SELECT d.doc_id AS article_id, CASE WHEN d.lang = 'fr' THEN 'raw' ELSE 'm1' END AS model,
         'RUNID_1' AS run_id, CASE WHEN d.lang = 'fr' THEN 'crawl' ELSE 'relevance_check_v0' END AS task_name,
         CASE WHEN d.lang = 'de' THEN 'ca' ELSE d.lang END AS article_language,
         CASE WHEN d.lang = 'fr' THEN 'ddgs' ELSE 'jina' END AS crawling_source, d.source AS source_name,
         l.quality * 2 AS "QUALITY", l.toxic * 2 AS "TOXICITY"
       FROM labels l JOIN documents d ON d.doc_id = l.doc_id
       WHERE greatest(l.quality, l.toxic) = 1"""
)
def relevant_articles(spark, sf):
    found = joins.relevant_articles(_outputs(spark, sf), _raw(spark, sf))
    return found.select("*", *score_columns(F.col("relevance"), PERSONAS)).drop("relevance")


@query(
    """SELECT d.doc_id AS article_id FROM documents d
       WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""
)
def unmatched_outputs(spark, sf):
    outputs = table(spark, sf, "documents").select(F.col("doc_id").alias("article_id"))
    raw = table(spark, sf, "labels").select(F.col("doc_id").alias("article_id"))
    return joins.unmatched(outputs, raw)


@query(
    """SELECT doc_id AS article_id, perfil FROM (
         SELECT doc_id, 'QUALITY' AS perfil, quality AS hit FROM labels
         UNION ALL SELECT doc_id, 'TOXICITY', toxic FROM labels) WHERE hit = 1"""
)
def relevant_pairs(spark, sf):
    return posts.relevant_pairs(_outputs(spark, sf).select("article_id", "relevance"))


@query(
    """SELECT doc_id, quality * 2 AS "QUALITY", toxic * 2 AS "TOXICITY",
         greatest(quality, toxic) = 1 AS relevant FROM labels"""
)
def score_columns_per_persona(spark, sf):
    scored = table(spark, sf, "labels").withColumn("relevance", _score_map())
    return scored.select(
        "doc_id",
        *score_columns(F.col("relevance"), PERSONAS),
        any_relevant(F.col("relevance")).alias("relevant"),
    )


@query("SELECT doc_id FROM labels WHERE quality * 2 = 2 AND toxic = 0")
def scalar_relevance(spark, sf):
    return table(spark, sf, "labels").where(
        (F.col("quality") * 2 == 2) & (F.col("toxic") == 0)
    ).select("doc_id")


@query(
    """SELECT doc_id, CASE WHEN quality = 1 THEN 'R' ELSE 'NR' END AS quality,
         CASE toxic * 2 WHEN 2 THEN 'R' ELSE 'NR' END AS toxic FROM labels"""
)
def score_recode(spark, sf):
    return table(spark, sf, "labels").select(
        "doc_id",
        recode(F.col("quality") * 2).alias("quality"),
        recode(F.col("toxic") * 2).alias("toxic"),
    )


@query(
    """SELECT d.text AS "título", d.source AS url, CAST(NULL AS VARCHAR) AS "fecha de publicación", d.text AS resumen,
         d.source AS fuente, d.lang AS idioma, CASE WHEN l.quality = 1 THEN 'R' ELSE 'NR' END AS "QUALITY",
         CASE WHEN l.toxic = 1 THEN 'R' ELSE 'NR' END AS "TOXICITY"
       FROM documents d JOIN labels l USING (doc_id) WHERE d.lang IN ('en', 'es')"""
)
def select_rename(spark, sf):
    frame = (
        table(spark, sf, "documents")
        .where(F.col("lang").isin("en", "es"))
        .join(table(spark, sf, "labels"), "doc_id")
        .select(
            F.col("text").alias("article_title"),
            F.col("source").alias("article_url"),
            F.lit(None).cast("string").alias("publish_date"),
            F.col("text").alias("summary"),
            F.col("source").alias("source_name"),
            F.col("lang").alias("article_language"),
            *score_columns(_score_map(), PERSONAS),
        )
    )
    return selection(frame, PERSONAS)


@query(
    r"""SELECT doc_id, replace(text, chr(10), '\n') AS escaped, left(text, 2000) AS shown FROM documents"""
)
def truncate_escape(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        escape_newlines(F.col("text")).alias("escaped"),
        # What `keep_valid` shows of an article where it is told to cut.
        F.substring("text", 1, 2000).alias("shown"),
    )


@query(
    r"""SELECT 'RUNID_1--source_parsing_v0--' || doc_id AS custom_id, 'm1' AS model,
         replace(text, chr(10), '\n') AS user_content, 'json_schema' AS format, 2 AS n_messages,
         'article_links_list' AS required,
         (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS batch_no
       FROM documents"""
)
def request_lines(spark, sf):
    """The request lines of a task, read back from their JSON."""
    task = tasks.link_task("m1")
    items = assign_batches(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    requests = tasks.build_requests(
        items, task, F.lit("RUNID_1"), F.col("doc_id").cast("string"), F.col("text"), "batch_no"
    )
    line = F.from_json(
        tasks.request_json(task),
        "custom_id string, body struct<model: string, messages: array<struct<role: string, content: string>>, "
        "response_format: struct<type: string, json_schema: struct<schema: struct<required: array<string>>>>>",
    )
    return requests.select("batch_no", line.alias("r")).select(
        "r.custom_id",
        "r.body.model",
        F.get("r.body.messages", F.lit(1))["content"].alias("user_content"),
        F.col("r.body.response_format.type").alias("format"),
        F.size("r.body.messages").alias("n_messages"),
        F.get("r.body.response_format.json_schema.schema.required", F.lit(0)).alias("required"),
        "batch_no",
    )


def _envelopes(spark, sf, content):
    """Events as stored response lines; a view has no choices, a buy a key of four parts."""
    choice = F.array(F.struct(F.struct(content.alias("content")).alias("message")))
    return table(spark, sf, "events").select(
        F.concat(
            F.lit("RUNID_1--task_v0--"),
            F.when(F.col("event_type") == "purchase", "x--").otherwise(""),
            F.col("event_id").cast("string"),
        ).alias("custom_id"),
        F.struct(
            F.struct(
                F.lit("m1").alias("model"),
                F.when(F.col("event_type") == "view", F.filter(choice, lambda _: F.lit(False)))
                .otherwise(choice)
                .alias("choices"),
            ).alias("body")
        ).alias("response"),
    )


_EVENT_KEY = (
    "'RUNID_1--task_v0--' || CASE WHEN event_type = 'purchase' THEN 'x--' ELSE '' END || event_id"
)


@query(
    f"""SELECT {_EVENT_KEY} AS custom_id,
         CASE WHEN event_type NOT IN ('purchase', 'view') THEN CAST(k % 2 = 0 AS VARCHAR) END AS validity,
         CASE WHEN event_type = 'purchase' THEN 'bad custom_id' WHEN event_type = 'view' THEN 'no verdict' END
           AS reject_reason
       FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""
)
def validity_answers(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    content = F.concat(F.lit('{"validity": '), (k % 2 == 0).cast("string"), F.lit("}"))
    verdicts, rejected = tasks.parse_validity(tasks.flatten_envelope(_envelopes(spark, sf, content)))
    good = verdicts.select(
        F.concat_ws("--", "run_id", F.lit("task_v0"), "article_id").alias("custom_id"),
        F.col("validity").cast("string").alias("validity"),
        F.lit(None).cast("string").alias(REASON),
    )
    return good.unionByName(
        rejected.select("custom_id", F.lit(None).cast("string").alias("validity"), REASON)
    )


@query(
    f"""SELECT {_EVENT_KEY} AS custom_id,
         CASE WHEN event_type = 'purchase' THEN 'bad custom_id'
              WHEN event_type = 'view' THEN 'content is not JSON'
              WHEN k % 4 = 3 THEN 'score out of range'
              WHEN k % 5 = 4 THEN 'unknown language' END AS reject_reason,
         CASE WHEN event_type NOT IN ('purchase', 'view') AND k % 4 <> 3 AND k % 5 <> 4 THEN CAST(k % 4 AS VARCHAR) END AS score_a
       FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""
)
def relevance_answers(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    content = F.concat(
        F.lit('{"A": '), (k % 4).cast("string"), F.lit(', "B": '), (k % 3).cast("string"),
        F.lit(', "article_language": "'), F.when(k % 5 == 4, "xx").otherwise("es"), F.lit('"}'),
    )
    outputs, rejected = tasks.parse_relevance(
        tasks.flatten_envelope(_envelopes(spark, sf, content)), ["A", "B"]
    )
    good = outputs.select(
        F.concat_ws("--", "run_id", "task_name", "article_id").alias("custom_id"),
        F.lit(None).cast("string").alias(REASON),
        F.col("relevance")["A"].cast("string").alias("score_a"),
    )
    return good.unionByName(
        rejected.select("custom_id", REASON, F.lit(None).cast("string").alias("score_a"))
    )


@query(
    """SELECT doc_id, CASE WHEN quality * 2 + toxic NOT IN (0, 1, 2) THEN 'score out of range'
         END AS problem FROM labels"""
)
def contract_check(spark, sf):
    scores = F.create_map(
        F.lit("QUALITY"), F.col("quality") * 2 + F.col("toxic"), F.lit("TOXICITY"), F.col("toxic")
    )
    return table(spark, sf, "labels").select(
        "doc_id", contract_error(scores, F.lit("es"), PERSONAS).alias("problem")
    )


def _length_model():
    def answer(requests):
        for request in requests:
            if request["user_content"].startswith("L"):
                raise ValueError("no answer")
        return [str(len(request["user_content"])) for request in requests]

    return answer


def _counting_model():
    return lambda requests: [f" {len(r['user_content'])} characters\n" for r in requests]


@query(
    """SELECT 'RUNID_1--article_summarization_v0--' || doc_id AS custom_id, 'm1' AS model,
         CASE WHEN NOT starts_with(text, 'L') THEN CAST(length(text) AS VARCHAR) END AS content,
         CASE WHEN starts_with(text, 'L') THEN 'ValueError: no answer' END AS error
       FROM documents"""
)
def apply_predictor(spark, sf):
    """A model in Python that fails on some rows; their errors are rows too."""
    requests = tasks.build_requests(
        table(spark, sf, "documents"), tasks.summary_task("m1"), F.lit("RUNID_1"),
        F.col("doc_id").cast("string"), F.col("text"),
    )
    return tasks.python_predictor(_length_model)(requests)


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def _keyword_sql(words):
    hits = " + ".join(f"CAST(contains(w, ' {word} ') AS INT)" for word in words)
    return f"least({hits}, 2)"


@query(
    rf"""SELECT doc_id, {", ".join(f'{_keyword_sql(w)} AS "{p}"' for p, w in KEYWORDS.items())}
       FROM (SELECT doc_id, ' ' || regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' ' AS w
             FROM documents)"""
)
def keyword_relevance(spark, sf):
    scores = baselines.keyword_scores(F.col("text"), KEYWORDS)
    return spread(table(spark, sf, "documents")).select("doc_id", scores.alias("relevance")).select(
        "doc_id", *score_columns(F.col("relevance"), list(KEYWORDS))
    )


@query(
    """SELECT doc_id,
         CASE WHEN doc_id % 9 = 0 THEN '$: no JSON'
              WHEN doc_id % 9 = 1 THEN '$.article_links_list: no array'
              WHEN doc_id % 9 = 2 THEN '$.article_links_list[' || doc_id % 3 || '].url: missing'
              WHEN doc_id % 9 = 3 THEN '$.article_links_list[0].n' || doc_id || ': unknown key'
              WHEN doc_id % 9 = 4 AND source = 'src0' THEN '$.article_links_list[0].language: no string'
              WHEN doc_id % 9 = 5 THEN '$.article_links_list: missing'
              WHEN doc_id % 9 = 6 THEN '$.article_links_list[0].keywords[1]: no string'
         END AS link_fault,
         CASE WHEN quality + length(text) % 4 > 2 THEN '$.QUALITY: unknown value'
              WHEN toxic = 1 THEN '$.TOXICITY: no integer'
              WHEN lang NOT IN ('es', 'ca', 'en') THEN '$.article_language: unknown value' END AS score_fault
       FROM documents JOIN labels USING (doc_id)"""
)
def contract_faults(spark, sf):
    """Links and scores made from documents, with faults of all kinds, held to the tasks' contracts."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    kind = F.col("doc_id") % 9
    text, url = F.col("text").alias("title"), F.col("source").alias("url")
    language = F.col("lang").alias("language")
    words = F.slice(F.split("text", " "), 1, 2).alias("keywords")
    right = F.to_json(F.struct(text, url, words, language))
    without_url = F.to_json(F.struct(text, words, language))
    number = F.when(F.col("source") == "src0", F.lit("1")).otherwise(F.lit('"en"'))
    entry = (
        F.when(kind == 3, F.concat(F.lit("{"), F.lit('"n'), "doc_id", F.lit('": 0, '), F.substr(right, F.lit(2))))
        .when(kind == 4, F.concat(F.substr(F.to_json(F.struct(text, url, words)), F.lit(1), F.length(F.to_json(F.struct(text, url, words))) - 1),
                                  F.lit(', "language": '), number, F.lit("}")))
        .when(kind == 6, F.concat(F.lit('{"title": "", "url": "", "language": "", "keywords": ["a", true]}')))
        .otherwise(right)
    )
    entries = F.when(
        kind == 2, F.concat_ws(", ", F.array_repeat(right, (F.col("doc_id") % 3).cast("int")), without_url)
    ).otherwise(F.concat_ws(", ", entry, right))
    links = (
        F.when(kind == 0, "no links").when(kind == 1, '{"article_links_list": "none"}').when(kind == 5, "{}")
        .otherwise(F.concat(F.lit('{"article_links_list": ['), entries, F.lit("]}")))
    )
    scores = F.concat(
        F.lit('{"QUALITY": '), (F.col("quality") + F.length("text") % 4).cast("string"),
        F.lit(', "TOXICITY": '), F.when(F.col("toxic") == 1, '"1"').otherwise("0"),
        F.lit(', "article_language": "'), "lang", F.lit('"}'),
    )
    people = [(p, "") for p in PERSONAS]
    return docs.select(
        "doc_id",
        contract_fault(links, tasks.link_task("m1").contract).alias("link_fault"),
        contract_fault(scores, tasks.relevance_task("m1", people).contract).alias("score_fault"),
    )


_CLEANED_SQL = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


@query(
    f"""WITH k AS (
         SELECT 'PAIRS' AS persona, array_to_string(string_split(text, ' ')[3:4], ' ') AS keyword FROM documents
         UNION ALL
         SELECT lang, array_to_string(string_split(text, ' ')[6:8], ' ') FROM documents),
       p AS (SELECT DISTINCT persona, {_CLEANED_SQL.format("keyword")} AS phrase FROM k),
       t AS (SELECT doc_id, ' ' || {_CLEANED_SQL.format("text")} || ' ' AS w FROM documents)
       SELECT doc_id, persona, count(*) AS n_keywords
       FROM t JOIN p ON phrase <> '' AND contains(w, ' ' || phrase || ' ')
       WHERE persona IS NOT NULL GROUP BY doc_id, persona"""
)
def keyword_phrases(spark, sf):
    """Two keywords from each document, of two and of three words, looked for in all of them."""
    docs = table(spark, sf, "documents")
    words = F.split("text", " ")
    keywords = docs.select(F.lit("PAIRS").alias("persona"), F.array_join(F.slice(words, 3, 2), " ").alias("keyword")).union(
        docs.select("lang", F.array_join(F.slice(words, 6, 3), " "))
    )
    return phrases.phrase_hits(docs, keywords, "doc_id", "text")


@query(
    rf"""SELECT * FROM (
         SELECT doc_id AS article_id, source AS source_name, 'es' AS article_language, 'RUNID_1' AS run_id,
           {", ".join(f'{_keyword_sql(w)} AS "{p}"' for p, w in KEYWORDS.items())}
         FROM (SELECT *, ' ' || regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' ' AS w
               FROM documents))
       WHERE greatest({", ".join(f'"{p}"' for p in KEYWORDS)}) = 2"""
)
def score_articles(spark, sf):
    """The whole relevance job: requests, model, answers, filter, and the join back. Every
    article comes twice, and counts once."""
    raw = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("article_id"),
        F.col("text").alias("article_body"),
        F.lit("ddgs").alias("crawling_source"),
        F.array().cast("array<string>").alias("article_keywords"),
        F.lit("RUNID_1").alias("run_id"),
        F.col("source").alias("source_name"),
        F.lit("es").alias("article_language"),
    )
    task = tasks.relevance_task("m1", [(p, " ".join(w)) for p, w in KEYWORDS.items()])
    raw = raw.unionByName(raw)
    outcome = jobs.score_articles(
        raw, "RUNID_1", task, baselines.relevance_predictor(KEYWORDS), list(KEYWORDS)
    )
    return outcome.table.select(
        F.col("article_id").cast("bigint").alias("article_id"), "source_name", "article_language", "run_id",
        *score_columns(F.col("relevance"), list(KEYWORDS)),
    )


@query(
    f"""SELECT e.vec_id AS article_id, l.quality * 2 AS "{PERSONAS[0]}", l.toxic * 2 AS "{PERSONAS[1]}",
         d.text AS summary, d.lang AS title
       FROM embeddings e JOIN labels l ON l.doc_id = e.vec_id JOIN documents d ON d.doc_id = e.vec_id
       WHERE d.doc_id % 4 = 1"""
)
def analysed_articles(spark, sf):
    """The analysis job over one run: four tables side by side, a score column per persona."""
    docs = table(spark, sf, "documents")
    run = F.concat(F.lit("RUNID_"), (F.col("article_id") % 4).cast("string")).alias("run_id")
    embeddings = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "article_id").select("article_id", run)
    relevant = table(spark, sf, "labels").select(
        F.col("doc_id").alias("article_id"), _score_map().alias("relevance")
    ).select("*", run)
    summaries = docs.select(F.col("doc_id").alias("article_id"), F.col("text").alias("summary")).select("*", run)
    content = docs.select(
        F.col("doc_id").alias("article_id"), F.col("lang").alias("title"), F.col("text").alias("content")
    ).select("*", run)
    frame = jobs.analyse(embeddings, relevant, summaries, content, PERSONAS, runs=["RUNID_1"])
    return frame.select("article_id", *PERSONAS, "summary", "title")


@query(
    """SELECT 'RUNID_1--t--' || event_id AS custom_id, CASE WHEN event_id % 3 > 0 THEN props END AS content,
         CASE WHEN event_id % 3 = 0 THEN 'no stored answer' END AS error
       FROM events"""
)
def stored_answers(spark, sf):
    """Answers looked up among stored response lines; a third of the requests have none."""
    events = table(spark, sf, "events")
    key = F.concat(F.lit("RUNID_1--t--"), F.col("event_id").cast("string")).alias("custom_id")
    choice = F.array(F.struct(F.struct(F.col("props").alias("content")).alias("message")))
    body = F.struct(F.lit("m1").alias("model"), choice.alias("choices"))
    lines = events.where("event_id % 3 > 0").select(key, F.struct(body.alias("body")).alias("response"))
    empty = F.lit("").alias("system_content"), F.lit("").alias("user_content")
    requests = events.select(key, F.lit("m1").alias("model"), *empty)
    return tasks.stored_predictor(lines.unionByName(lines))(requests).select("custom_id", "content", "error")


def _people(spark, sf):
    return table(spark, sf, "region").select(
        F.coalesce(F.get(F.array(*[F.lit(p) for p in PERSONAS]), "r_regionkey"), F.col("r_name")).alias("name"),
        F.col("r_name").alias("linkedin_bio"),
        "r_regionkey",
    )


def _past(spark, sf):
    """Chat turns as past posts of the two personas."""
    return table(spark, sf, "conversations").select(
        F.concat_ws("_", "conv_id", "turn").alias("post_id"),
        F.when(F.col("role") == "user", PERSONAS[0]).otherwise(PERSONAS[1]).alias("perfil"),
        F.col("text").alias("copy"),
    )


def _article_summaries(spark, sf):
    scored = table(spark, sf, "labels").select("doc_id", _score_map().alias("relevance"))
    return table(spark, sf, "documents").join(scored, "doc_id").select(
        F.col("doc_id").alias("article_id"),
        F.concat_ws(" ", F.lit("Article"), "doc_id").alias("article_title"),
        F.col("lang").alias("article_language"),
        F.col("text").alias("summary"),
        F.col("source").alias("article_url"),
        "relevance",
    )


_PAST_SQL = f"""SELECT conv_id || '_' || turn AS post_id, text AS copy,
    CASE WHEN role = 'user' THEN '{PERSONAS[0]}' ELSE '{PERSONAS[1]}' END AS perfil FROM conversations"""


def _sampled_sql(rows, row_id, n, seed):
    return f"""SELECT * FROM ({rows}) QUALIFY
        row_number() OVER (PARTITION BY perfil ORDER BY md5({row_id} || ':{seed}'), {row_id}) <= {n}"""


_DRAWN_PAIRS_SQL = _sampled_sql(
    f"""SELECT d.doc_id AS article_id, p.perfil, d.lang, d.source, d.text FROM documents d
        JOIN (SELECT doc_id, '{PERSONAS[0]}' AS perfil, quality AS hit FROM labels
              UNION ALL SELECT doc_id, '{PERSONAS[1]}', toxic FROM labels) p
          ON p.doc_id = d.doc_id AND p.hit = 1""",
    "article_id", 5, 0,
)


@query(
    f"""WITH numbered AS (
         SELECT perfil, post_id, 'Example ' || row_number() OVER (PARTITION BY perfil ORDER BY post_id)
           || ':' || chr(10) || copy AS example
         FROM ({_sampled_sql(_PAST_SQL, "post_id", 5, 0)})),
       voices AS (SELECT perfil, string_agg(example, chr(10) || chr(10) ORDER BY post_id) AS examples
                  FROM numbered GROUP BY perfil),
       people AS (SELECT r_name, CASE r_regionkey WHEN 0 THEN '{PERSONAS[0]}' WHEN 1 THEN '{PERSONAS[1]}'
                    ELSE r_name END AS perfil FROM region)
       SELECT perfil, article_id, 'Article ' || article_id AS article_title, lang AS article_language,
         text AS summary, source AS article_url,
         concat_ws(chr(10) || chr(10),
           concat_ws(' ', {_quoted(posts.BRIEF)},
             CASE WHEN substr(md5(perfil || chr(1) || article_id || ':0'), 1, 1)
                    IN ('0', '2', '4', '6', '8', 'a', 'c', 'e') THEN {_quoted(posts.CLOSING)} END),
           'The executive:' || chr(10) || r_name,
           'Their earlier posts:' || chr(10) || chr(10) || examples,
           'Language of the post: ' || lang) AS system_content,
         trim('Article ' || article_id || chr(10) || text) AS user_content
       FROM ({_DRAWN_PAIRS_SQL}) JOIN people USING (perfil) LEFT JOIN voices USING (perfil)"""
)
def post_prompts(spark, sf):
    """Both sides of the prompts, with sampled articles and examples."""
    return posts.post_prompts(
        _article_summaries(spark, sf), _people(spark, sf), _past(spark, sf), "post_id"
    )


@query(
    """SELECT d.doc_id AS article_id, p.perfil, trim('Article ' || d.doc_id || chr(10) || d.text) AS user_content,
         d.lang AS article_language, d.source AS article_url
       FROM documents d JOIN (SELECT doc_id, 'QUALITY' AS perfil, quality AS hit FROM labels
                              UNION ALL SELECT doc_id, 'TOXICITY', toxic FROM labels) p
         ON p.doc_id = d.doc_id AND p.hit = 1"""
)
def post_messages(spark, sf):
    """The article's side of every prompt, with no article sampled away."""
    prompts = posts.post_prompts(
        _article_summaries(spark, sf), _people(spark, sf), _past(spark, sf), "post_id", n_articles=None
    )
    return prompts.select("article_id", "perfil", "user_content", "article_language", "article_url")


@query(
    """SELECT p.perfil, length(trim('Article ' || d.doc_id || chr(10) || d.text)) || ' characters' AS copy,
         'Article ' || d.doc_id AS article_title, d.lang AS article_language, d.text AS summary,
         d.source AS article_url
       FROM documents d JOIN (SELECT doc_id, 'QUALITY' AS perfil, quality AS hit FROM labels
                              UNION ALL SELECT doc_id, 'TOXICITY', toxic FROM labels) p
         ON p.doc_id = d.doc_id AND p.hit = 1"""
)
def generated_posts(spark, sf):
    """Posts of a stand-in model for every relevant article of every persona."""
    prompts = posts.post_prompts(
        _article_summaries(spark, sf), _people(spark, sf), _past(spark, sf), "post_id", n_articles=None
    )
    return posts.generate_posts(prompts, tasks.python_predictor(_counting_model), "m1")[0]


@query(
    """SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)),
         lambda x, i: 'Example ' || i || ':' || chr(10) || x), chr(10) || chr(10)) AS examples
       FROM documents"""
)
def numbered_examples(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", posts.numbered_examples(F.split("text", "\n")).alias("examples")
    )


@query(_sampled_sql(_PAST_SQL, "post_id", 5, 7))
def sampled_examples(spark, sf):
    return posts.seeded_sample(_past(spark, sf), ["perfil"], "post_id", 5, seed=7)


@query(
    """SELECT doc_id, substr(md5(doc_id || ':0'), 1, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e') AS chosen
       FROM documents"""
)
def call_to_action(spark, sf):
    return table(spark, sf, "documents").select("doc_id", posts.coin(F.col("doc_id")).alias("chosen"))
