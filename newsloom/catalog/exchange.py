"""Model steps that wait for answers as files, over the documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.catalog.registry import query, table
from newsloom.operators import tasks
from newsloom.plans import curation
from newsloom.plans.exchange import Exchange, Waiting
from newsloom.session import scratch_path, store

RUN_ID = "RUNID_1"


def _requests(spark, sf, task) -> DataFrame:
    documents = table(spark, sf, "documents")
    return tasks.build_requests(documents, task, F.lit(RUN_ID), F.col("doc_id").cast("string"), F.col("text"))


def _sent(exchange: Exchange) -> DataFrame:
    """What stands in the request files, as a vendor reads them: custom_id and the text."""
    lines = exchange.spark.read.schema(
        "custom_id string, body struct<messages: array<struct<content: string>>>"
    ).json(exchange.folder("requests"))
    return lines.select("custom_id", F.get("body.messages", F.lit(1))["content"].alias("text"))


def _land(exchange: Exchange, rows: DataFrame, content: Column | None, error: Column | None = None) -> None:
    """Answer files for rows with custom_id: the content, or the error where there is one."""
    choices = F.array(F.struct(F.struct(content.alias("content")).alias("message"))) if content is not None else None
    fields = [F.col("custom_id")]
    if choices is not None:
        response = F.struct(F.struct(F.lit("m1").alias("model"), choices.alias("choices")).alias("body"))
        fields.append((response if error is None else F.when(error.isNull(), response)).alias("response"))
    if error is not None:
        fields.append(F.when(error.isNotNull(), F.struct(F.lit("500").alias("code"), error.alias("message"))).alias("error"))
    rows.select(F.to_json(F.struct(*fields)).alias("value")).write.mode("append").text(exchange.folder("answers"))


def _ask(exchange: Exchange, requests: DataFrame) -> DataFrame | None:
    """The answers, or None if the step has to wait."""
    try:
        return exchange(requests)
    except Waiting:
        return None


def _long() -> Column:
    """The answer of a model that takes texts of 500 characters for articles."""
    return F.to_json(F.struct((F.length("text") >= 500).alias("validity")))


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS article_id,
         CASE WHEN lang <> 'fr' THEN CASE WHEN lang = 'en' AND length(text) < 1000 THEN false ELSE length(text) >= 500 END
         END AS validity,
         CASE WHEN lang = 'fr' THEN 'model error: error: 500: out of tokens' END AS reject_reason, 2 AS waits
       FROM documents"""
)
def answers_in_two_polls(spark, sf):
    """English answers land first; then the others, French ones as errors, and second answers to
    short English texts, which replace the first."""
    task = tasks.validity_task("m1")
    exchange = Exchange(spark, scratch_path(spark, "exchange"), RUN_ID, task)
    requests = _requests(spark, sf, task)
    lang = table(spark, sf, "documents").select(
        F.concat(F.lit(f"{RUN_ID}--{task.name}--"), F.col("doc_id").cast("string")).alias("custom_id"), "lang"
    )
    waits = int(_ask(exchange, requests) is None)
    # The model's answers, not the texts, meet the languages. They land in three parts; the
    # request files are read once.
    sent = _sent(exchange).select("custom_id", _long().alias("said"), (F.length("text") < 1000).alias("short"))
    sent = store(sent.join(lang, "custom_id"), "said")
    _land(exchange, sent.where("lang = 'en'"), F.col("said"))
    waits += int(_ask(exchange, requests) is None)
    _land(exchange, sent.where("lang <> 'en'"), F.col("said"), F.when(F.col("lang") == "fr", "out of tokens"))
    _land(exchange, sent.where("lang = 'en' AND short"), F.lit('{"validity": false}'))
    verdicts, rejected = tasks.parse_validity(_ask(exchange, requests))
    none = F.lit(None)
    lost = rejected.select(
        F.substring_index("custom_id", "--", -1).alias("article_id"), none.cast("boolean").alias("validity"), "reject_reason"
    )
    found = verdicts.select("article_id", "validity", none.cast("string").alias("reject_reason")).unionByName(lost)
    return found.withColumn("waits", F.lit(waits))


@query(
    """WITH sent AS (
         SELECT lang, (row_number() OVER (ORDER BY 'RUNID_1--content_validation_v0--' || doc_id) - 1) // 200 AS batch_no
         FROM documents)
       SELECT batch_no, count(*) AS n_requests, count(*) FILTER (WHERE lang <> 'de') AS n_answered,
         count(*) FILTER (WHERE lang = 'fr' OR (batch_no = 0 AND lang = 'de')) AS n_errors,
         CASE WHEN batch_no > 0 AND count(*) FILTER (WHERE lang = 'de') > 0 THEN 'running' ELSE 'completed' END AS status
       FROM sent GROUP BY batch_no"""
)
def waiting_batches(spark, sf):
    """Where the batches stand once all but the German answers have landed, and the first batch
    has been reported as expired."""
    task = tasks.validity_task("m1")
    exchange = Exchange(spark, scratch_path(spark, "exchange"), RUN_ID, task)
    requests = _requests(spark, sf, task)
    _ask(exchange, requests)
    lang = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    sent = _sent(exchange).select("custom_id", _long().alias("said"), F.substring_index("custom_id", "--", -1).alias("id"))
    sent = sent.join(lang, "id")
    _land(exchange, sent.where("lang <> 'de'"), F.col("said"), F.when(F.col("lang") == "fr", "out of tokens"))
    report = spark.range(1).select(F.lit('{"batch_no": 0, "status": "expired"}').alias("value"))
    report.write.mode("append").text(exchange.folder("answers"))
    _ask(exchange, requests)
    return exchange.batches().select("batch_no", "n_requests", "n_answered", "n_errors", "status")


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS article_id, substr(text, 1, 40) AS summary,
         'waiting at validity, waiting at summaries, success' AS steps
       FROM documents WHERE length(text) >= 500"""
)
def resumed_run(spark, sf):
    """A run from the validity step on: it writes requests and ends as waiting, twice, and goes on
    from where it stopped when answers have landed."""
    ws = curation.Workspace(spark, scratch_path(spark, "workspace"))
    documents = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("article_id"), "text", "lang")
    content = documents.select(
        "article_id", F.col("text").alias("content"), F.lit("t").alias("title"), F.lit("2025-01-01").alias("publish_date")
    )
    ws.write("article_content", content, RUN_ID)
    known = {"article_id": F.col("article_id"), "article_language": F.col("lang"), "relevance": F.create_map(F.lit("ANA"), F.lit(2))}
    fields = spark.createDataFrame([], schemas.RELEVANT_ARTICLES).schema.fields
    relevant = documents.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    ws.write("relevant_articles", relevant, RUN_ID)
    models = curation.batch_models(ws, RUN_ID, [("ANA", "data")], "m1")
    steps, resume = [], "validity"
    for exchange, answer in ((models.validity[1], _long()), (models.summary[1], F.substring("text", 1, 40)), (None, None)):
        status = curation.run_curation(ws, RUN_ID, ["ANA"], models, resume=resume)
        steps.append(status if status == "success" else f"{status} at {curation.open_step(ws, RUN_ID)}")
        resume = curation.OPEN
        if exchange:
            _land(exchange, _sent(exchange), answer)
    return ws.read("summaries", schemas.SUMMARIES, RUN_ID).select(
        "article_id", "summary", F.lit(", ".join(steps)).alias("steps")
    )
