"""Sources and sinks: write to a fresh scratch folder, read back."""

from pyspark.sql import functions as F

from newsloom.catalog.registry import ARTICLES_SQL, articles, query, table
from newsloom.operators import batching, tasks
from newsloom.session import scratch_path
from newsloom.sources import readers, writers
from newsloom.streaming.incremental import dedupe_landing, read_new

_ROWS = "doc_id bigint, article_title string, article_language string"


def _runs(spark, sf):
    return articles(spark, sf).select("doc_id", "run_id", "article_title", "article_language")


@query(f"SELECT doc_id, run_id, article_title, article_language FROM {ARTICLES_SQL}")
def run_table(spark, sf):
    """All runs, written twice; the second write replaces the first."""
    path = scratch_path(spark, "runs")
    writers.write_run(_runs(spark, sf).withColumn("article_title", F.lit("old")), path)
    writers.write_run(_runs(spark, sf), path)
    # An empty result leaves the table as it is.
    writers.write_run(_runs(spark, sf).where("doc_id < 0"), path)
    return readers.read_table(spark, path, f"{_ROWS}, run_id string")


@query(
    f"""SELECT doc_id, article_language FROM {ARTICLES_SQL} WHERE run_id = 'RUNID_1'
       UNION ALL SELECT NULL, 'none' FROM region WHERE r_regionkey = 0"""
)
def one_run(spark, sf):
    """One run of the table by its partition, and a table that is missing."""
    path = scratch_path(spark, "runs")
    writers.write_run(_runs(spark, sf), path)
    run = readers.read_table(spark, path, _ROWS, "RUNID_1", columns=["doc_id", "article_language"])
    missing = readers.read_table(spark, path + "-missing", _ROWS, required=False)
    state = missing.agg(
        F.max("doc_id").alias("doc_id"),
        F.when(F.count("*") == 0, "none").otherwise("some").alias("article_language"),
    )
    return run.unionByName(state)


@query(
    f"""SELECT doc_id, run_id, CASE WHEN article_language = 'fr' THEN 'new' ELSE article_title END
         AS article_title, article_language FROM {ARTICLES_SQL}"""
)
def upserted_run(spark, sf):
    path = scratch_path(spark, "upsert")
    writers.write_run(_runs(spark, sf), path)
    stored = readers.read_table(spark, path, _ROWS)
    changed = _runs(spark, sf).where(F.col("article_language") == "fr")
    fresh = changed.select(
        "doc_id", "run_id", F.explode(F.array(F.lit("older"), F.lit("new"))).alias("article_title"),
        "article_language",
    ).withColumn("ord", F.when(F.col("article_title") == "new", 2).otherwise(1))
    writers.upsert_run(stored, fresh, path, ["run_id", "doc_id"], "ord")
    return readers.read_table(spark, path, _ROWS)


@query(
    f"""SELECT doc_id AS article_id, run_id, article_title, article_language FROM {ARTICLES_SQL}
       WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)"""
)
def deleted_content(spark, sf):
    path, schema = scratch_path(spark, "delete"), _ROWS.replace("doc_id", "article_id")
    writers.write_run(_runs(spark, sf).withColumnRenamed("doc_id", "article_id"), path)
    stored = readers.read_table(spark, path, schema)
    verdicts = table(spark, sf, "labels").select(
        F.concat(F.lit("RUNID_"), (F.col("doc_id") % 4).cast("string")).alias("run_id"),
        F.col("doc_id").alias("article_id"),
        (F.col("quality") == 1).alias("validity"),
    )
    for run in ("RUNID_0", "RUNID_1", "RUNID_2", "RUNID_3"):
        writers.delete_invalid(stored, verdicts, path, run)
    return readers.read_table(spark, path, schema)


@query(
    """SELECT doc_id, text, lang, doc_id // 50 AS file_no,
         row_number() OVER (PARTITION BY doc_id // 50 ORDER BY doc_id) - 1 AS place FROM documents"""
)
def json_arrays(spark, sf):
    """Files of one JSON array each, read back in the order of their records."""
    path = scratch_path(spark, "arrays")
    records = F.sort_array(F.collect_list(F.struct("doc_id", "text", "lang")))
    files = table(spark, sf, "documents").groupBy((F.col("doc_id") / 50).cast("bigint")).agg(F.to_json(records).alias("value"))
    files.select("value").write.option("maxRecordsPerFile", 1).text(path)
    rows = readers.read_json_array(spark, path, "doc_id bigint, text string, lang string", ordinal=True)
    rows = rows.withColumn("file_no", (F.col("doc_id") / 50).cast("bigint"))
    first = rows.groupBy("file_no").agg(F.min("ord").alias("first"))
    return rows.join(first, "file_no").select("doc_id", "text", "lang", "file_no", (F.col("ord") - F.col("first")).alias("place"))


@query(
    """SELECT doc_id AS article_id, quality FROM labels WHERE quality = 1 OR (quality = 0 AND toxic = 1)"""
)
def relevant_by_either_form(spark, sf):
    """Stored relevance as the map of today, and as the single number of old runs."""
    path = scratch_path(spark, "relevant")
    labels = table(spark, sf, "labels")
    map_form = labels.where("quality = 0").select(
        "doc_id", "quality", F.create_map(F.lit("TOXICITY"), F.col("toxic") * 2).alias("relevance"),
        F.lit(None).cast("int").alias("relevance_scalar"),
    )
    old_form = labels.where("quality = 1").select(
        "doc_id", "quality", F.lit(None).cast("map<string,int>").alias("relevance"),
        (F.col("quality") * 2).alias("relevance_scalar"),
    )
    both = map_form.unionByName(old_form).withColumnRenamed("doc_id", "article_id")
    writers.write_run(both.withColumn("run_id", F.lit("RUNID_1")), path)
    schema = "article_id bigint, quality int, relevance map<string,int>, relevance_scalar int"
    return readers.read_relevant(spark, path, schema, "RUNID_1").select("article_id", "quality")


@query(
    """SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS batch_no, doc_id FROM documents
       WHERE lang <> 'en'"""
)
def rewritten_requests(spark, sf):
    """A run's requests written again with fewer batches; none of the first write stays."""
    path = scratch_path(spark, "requests")
    for documents in (table(spark, sf, "documents"), table(spark, sf, "documents").where("lang <> 'en'")):
        rows = batching.assign_batches(documents.select("doc_id"), ["doc_id"])
        rows = rows.withColumns({"run_id": F.lit("RUNID_1"), "task_name": F.lit("t")})
        writers.write_request_files(rows, path, F.to_json(F.struct("doc_id")))
    return spark.read.schema("doc_id bigint, batch_no bigint").json(f"{path}/run_id=RUNID_1/task_name=t")


@query(
    """SELECT user_id AS batch_id, event_id || CASE WHEN user_id % 2 = 0 THEN ' again' ELSE ' first' END AS line
       FROM events"""
)
def polled_bodies(spark, sf):
    """Two polls, the second with half of the batches: it replaces these and leaves the others."""
    path = scratch_path(spark, "polls")
    events = table(spark, sf, "events").withColumnRenamed("user_id", "batch_id")
    none = events.where("event_id < 0").select("batch_id", F.lit("").alias("body"))
    for poll, batches in (("first", events), ("again", events.where("batch_id % 2 = 0"))):
        bodies = batches.select("batch_id", F.concat_ws(" ", "event_id", F.lit(poll)).alias("body"))
        writers.write_saved_bodies(bodies, none, path)
    return readers.read_saved_lines(spark, path, "output", "bigint")


@query(
    """SELECT 'RUNID_1' AS run_id, 'content_validation_v0' AS task_name,
         (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS batch_no,
         'RUNID_1--content_validation_v0--' || doc_id AS custom_id, text AS user_content,
         CAST(0 AS DOUBLE) AS temperature
       FROM documents"""
)
def request_files(spark, sf):
    """One JSONL file per batch; the files' own lines and folders read back."""
    task = tasks.validity_task("m1")
    items = batching.assign_batches(table(spark, sf, "documents").select("doc_id", "text"), ["doc_id"])
    requests = tasks.build_requests(
        items, task, F.lit("RUNID_1"), F.col("doc_id").cast("string"), F.col("text"), "pos", "batch_no"
    ).withColumns({"run_id": F.lit("RUNID_1"), "task_name": F.lit(task.name)})
    path = scratch_path(spark, "requests")
    writers.write_request_files(requests, path, tasks.request_json(task))
    lines = spark.read.schema(
        "custom_id string, body struct<temperature: double, messages: array<struct<content: string>>>, "
        "run_id string, task_name string, batch_no bigint"
    ).json(path)
    return lines.select(
        "run_id", "task_name", "batch_no", "custom_id",
        F.get("body.messages", F.lit(1))["content"].alias("user_content"),
        F.col("body.temperature").cast("double").alias("temperature"),
    )


@query(
    """SELECT 'RUNID_1--t--' || event_id AS custom_id, 'm1' AS model, props AS content FROM events
       UNION ALL SELECT NULL, NULL, 'not json ' || r_regionkey FROM region"""
)
def response_files(spark, sf):
    """Response lines from JSONL, with bad lines set aside."""
    choice = F.array(F.struct(F.struct(F.col("props").alias("content")).alias("message")))
    line = F.to_json(
        F.struct(
            F.concat(F.lit("RUNID_1--t--"), F.col("event_id").cast("string")).alias("custom_id"),
            F.struct(F.struct(F.lit("m1").alias("model"), choice.alias("choices")).alias("body")).alias(
                "response"
            ),
        )
    )
    bad = table(spark, sf, "region").select(
        F.concat(F.lit("not json "), F.col("r_regionkey").cast("string")).alias("value")
    )
    path = scratch_path(spark, "responses")
    table(spark, sf, "events").select(line.alias("value")).unionByName(bad).write.text(path)
    good, rejected = readers.read_responses(spark, path)
    none = F.lit(None).cast("string")
    return tasks.flatten_envelope(good).select("custom_id", "model", "content").unionByName(
        rejected.select(none.alias("custom_id"), none.alias("model"), F.col("line").alias("content"))
    )


@query("SELECT url AS line FROM pages")
def text_lines(spark, sf):
    path = scratch_path(spark, "lines")
    table(spark, sf, "pages").select(F.col("url").alias("value")).write.text(path)
    return readers.read_lines(spark, path)


@query(
    """SELECT text AS "título", source AS url, lang AS idioma FROM documents"""
)
def selection_file(spark, sf):
    path = scratch_path(spark, "selection")
    frame = table(spark, sf, "documents").select(
        F.col("text").alias("article_title"), F.col("source").alias("article_url"),
        F.col("lang").alias("article_language"),
    )
    names = {k: writers.EXPORT_NAMES[k] for k in frame.columns}
    writers.write_selection(writers.selection(frame, [], names), path)
    return spark.read.schema("`título` string, url string, idioma string").option("header", True).csv(
        path, multiLine=True, escape='"'
    )


def _posts(spark, sf):
    return table(spark, sf, "conversations").select(
        F.col("role").alias("perfil"),
        F.concat_ws(" ", "conv_id", "turn").alias("article_title"),
        F.translate("text", "\n", " ").alias("copy"),
        F.concat(F.lit("u"), F.col("conv_id").cast("string")).alias("article_url"),
    )


@query(
    """SELECT role AS perfil, line, count(*) AS n FROM (
         SELECT role, unnest(['Title: ' || conv_id || ' ' || turn, 'URL: u' || conv_id, 'Copy:',
                              replace(text, chr(10), ' '), '']) AS line FROM conversations)
       GROUP BY ALL"""
)
def post_files(spark, sf):
    path = scratch_path(spark, "posts")
    writers.write_posts(_posts(spark, sf), path)
    lines = spark.read.schema("value string, perfil string").text(path)
    return lines.groupBy("perfil", F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query(
    """SELECT line, count(*) AS n FROM (
         SELECT unnest([replace(text, chr(10), ' '), 'u' || conv_id, '']) AS line FROM conversations)
       GROUP BY ALL"""
)
def post_log(spark, sf):
    path = scratch_path(spark, "log")
    rows = _posts(spark, sf)
    writers.append_post_log(rows.where("perfil = 'user'"), path)
    writers.append_post_log(rows.where("perfil <> 'user'"), path)
    return readers.read_lines(spark, path).groupBy("line").agg(F.count("*").alias("n"))


@query(
    """SELECT 'RUNID_' || user_id AS "RUNID", event_type AS status, value AS run_duration FROM events"""
)
def run_ledger(spark, sf):
    path = scratch_path(spark, "ledger")
    entries = table(spark, sf, "events").select(
        F.concat(F.lit("RUNID_"), F.col("user_id").cast("string")).alias("RUNID"),
        F.col("event_type").alias("status"), F.col("value").alias("run_duration"),
    )
    writers.append_ledger(entries.where("status = 'error'"), path)
    writers.append_ledger(entries.where("status <> 'error'"), path)
    return spark.read.schema("RUNID string, status string, run_duration double").parquet(path)


@query(
    """SELECT 'output' AS kind, user_id AS batch_id, 'c' || event_id AS line FROM events WHERE value > 5
       UNION ALL
       SELECT 'error', user_id, 'failed ' || part FROM events, (VALUES (1), (2)) p (part)
       WHERE event_type = 'error'"""
)
def saved_bodies(spark, sf):
    """Outputs read back as responses, errors of two lines each as they are."""
    line = F.to_json(F.struct(F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("custom_id")))
    batches = table(spark, sf, "events").select(
        F.col("user_id").alias("batch_id"),
        F.lit("completed").alias("status"),
        F.when(F.col("value") > 5, F.concat(line, F.lit("\n"))).otherwise(" ").alias("output"),
        F.when(F.col("event_type") == "error", "failed 1\nfailed 2").alias("error"),
    )
    path = scratch_path(spark, "bodies")
    writers.write_saved_bodies(*tasks.split_saved(batches), path)
    outputs = readers.read_saved_responses(spark, path, "bigint").select(
        F.lit("output").alias("kind"), "batch_id", F.col("custom_id").alias("line")
    )
    errors = readers.read_saved_lines(spark, path, "error", "bigint")
    return outputs.unionByName(errors.withColumn("kind", F.lit("error")))


@query(
    f"""SELECT a.doc_id, a.run_id FROM {ARTICLES_SQL} a
       WHERE NOT EXISTS (SELECT 1 FROM {ARTICLES_SQL} b
         WHERE a.article_title IS NOT DISTINCT FROM b.article_title
           AND a.source_name IS NOT DISTINCT FROM b.source_name AND b.run_id < a.run_id)"""
)
def incremental_dedupe(spark, sf):
    """All runs land as files, two at a time, and go through the stream."""
    landing, output = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    rows = articles(spark, sf).select("doc_id", "run_id", "article_title", "source_name")
    for runs in (("RUNID_0", "RUNID_1"), ("RUNID_2", "RUNID_3")):
        rows.where(F.col("run_id").isin(*runs)).write.mode("append").parquet(landing)
        dedupe_landing(
            spark, landing, "doc_id bigint, run_id string, article_title string, source_name string",
            output, f"{output}/_progress",
        )
    return read_new(spark, output, "doc_id bigint, run_id string")
