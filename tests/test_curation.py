"""A run over a workspace, from landed pages to embeddings."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import tasks
from newsloom.plans import curation, jobs
from newsloom.sources.readers import read_responses
from newsloom.sources.writers import write_run

PERSONAS = [("ANA", "data"), ("LUC", "brands")]
NAMES = [name for name, _ in PERSONAS]
KEYWORDS = {"ANA": ["datos", "inteligencia"], "LUC": ["marca", "publicidad"]}
BODY = "<p>" + "Una frase con sentido sobre el tema de hoy. " * 10 + "</p>"


def page(links):
    return "Title: x\n\n" + "\n".join(f"* [{title}]({url})" for title, url in links)


def land(ws, run, pages, hits=()):
    spark = ws.spark
    df = spark.createDataFrame(
        [(f"https://{name}.com", name, content, "2025-01-01 00:00:00", run) for name, content in pages],
        schemas.SOURCE_RAW_CONTENT + ", run_id string",
    )
    write_run(df, ws.location("source_raw_content"))
    if hits:
        write_run(
            spark.createDataFrame([(*h, i, run) for i, h in enumerate(hits)], schemas.SEARCH_HITS + ", ord bigint, run_id string"),
            ws.location("search_hits"),
        )


@pytest.fixture
def ws(spark, tmp_path):
    ws = curation.Workspace(spark, str(tmp_path / "ws"))
    article_pages = [(f"https://a.com/{i}", f"<article>{BODY}</article>") for i in range(1, 4)]
    article_pages += [("https://a.com/4", "<article>403 Forbidden</article>"), ("https://b.com/1", f"<article>{BODY}</article>")]
    spark.createDataFrame(article_pages, "url string, html string").write.parquet(ws.location("article_pages"))
    return ws


def run(ws, run_id, **kw):
    return curation.run_curation(
        ws, run_id, NAMES, curation.baseline_models(PERSONAS, KEYWORDS), crawled_at="2025-01-01 00:00:00", **kw
    )


def titles(ws, table, schema, run_id):
    return sorted(r["article_title"] for r in ws.read(table, schema, run_id).collect())


def test_two_runs(spark, ws):
    land(
        ws, "RUNID_1",
        [("My Site", page([("Datos e inteligencia", "https://a.com/1"), ("Deporte", "https://a.com/2"),
                           ("Inteligencia y datos", "https://a.com/4")])),
         ("blocked", '{"data": null, "code": 451, "message": "[x](https://x.com)"}'), ("empty", "")],
        [("ANA", "datos", "2025-01-01", "Marca y publicidad", "marca publicidad", "https://b.com/1", "img", "The B"),
         ("LUC", "marca", "2025-01-01", None, "marca publicidad", "https://b.com/1", "img", "The B"),
         ("LUC", "marca", None, "Sin fecha", "x", "https://b.com/2", "img", "The B")],
    )
    assert run(ws, "RUNID_1") == "success"
    raw = ws.read("raw_articles", schemas.RAW_ARTICLES, "RUNID_1")
    assert titles(ws, "raw_articles", schemas.RAW_ARTICLES, "RUNID_1") == [
        "Datos e inteligencia", "Deporte", "Inteligencia y datos", "Marca y publicidad",
    ]
    assert {r["source_name"] for r in raw.collect()} == {"my_site", "the_b"}
    searched = raw.where("crawling_source = 'ddgs'").first()["article_id"]
    found = ws.read("article_searches", schemas.ARTICLE_SEARCHES, "RUNID_1").orderBy("ord").collect()
    assert [(r["article_id"], r["query_original_personas"], r["ddgs_search_query"]) for r in found] == [
        (searched, "ANA", "datos"), (searched, "LUC", "marca"),
    ]
    assert ws.counts["raw_articles_crawled", "RUNID_1"] == 3
    assert ws.counts["raw_articles_searched_rejected", "RUNID_1"] == 1
    # The hit without a date is no valid article.
    assert ws.read("raw_articles_searched_rejected", "reject_reason string").first()["reject_reason"] == "article_date"

    assert titles(ws, "relevant_articles", schemas.RELEVANT_ARTICLES, "RUNID_1") == [
        "Datos e inteligencia", "Inteligencia y datos", "Marca y publicidad",
    ]
    content = ws.read("article_content", schemas.ARTICLE_CONTENT, "RUNID_1")
    valid = ws.read("valid_content", schemas.ARTICLE_CONTENT, "RUNID_1")
    assert sorted(r["title"] for r in valid.collect()) == ["Datos e inteligencia", "Marca y publicidad"]
    assert content.count() == 3
    summaries = ws.read("summaries", schemas.SUMMARIES, "RUNID_1")
    embeddings = ws.read("embeddings", schemas.EMBEDDINGS, "RUNID_1")
    assert rows(summaries.select("article_id")) == rows(valid.select("article_id")) == rows(embeddings.select("article_id"))

    # The second run sees one old and one new title, and no search results.
    land(ws, "RUNID_2", [("My Site", page([("Datos e inteligencia", "https://a.com/9"), ("Datos, marca y publicidad", "https://a.com/3")]))])
    assert run(ws, "RUNID_2") == "success"
    assert titles(ws, "raw_articles", schemas.RAW_ARTICLES, "RUNID_2") == ["Datos, marca y publicidad"]
    assert titles(ws, "relevant_articles", schemas.RELEVANT_ARTICLES, "RUNID_2") == ["Datos, marca y publicidad"]

    # Running a run again gives the same articles with the same ids.
    ids = rows(raw.select("article_id"))
    assert run(ws, "RUNID_1", resume="dedupe") == "success"
    assert rows(ws.read("raw_articles", schemas.RAW_ARTICLES, "RUNID_1").select("article_id")) == ids

    # Scores that make nothing relevant leave nothing of the run behind.
    none = curation.baseline_models(PERSONAS, {"ANA": [], "LUC": []})
    assert curation.run_curation(ws, "RUNID_2", NAMES, none, resume="relevance") == "success"
    assert titles(ws, "relevant_articles", schemas.RELEVANT_ARTICLES, "RUNID_2") == []
    assert ws.read("embeddings", schemas.EMBEDDINGS, "RUNID_2").count() == 0
    assert run(ws, "RUNID_2", resume="relevance") == "success"

    ledger = spark.read.schema(schemas.RUNS_METADATA).parquet(ws.location("runs_metadata"))
    assert rows(ledger.select("RUNID", "status")) == [("RUNID_1", "success")] * 2 + [("RUNID_2", "success")] * 3

    frame = jobs.analyse(
        ws.read("embeddings", schemas.EMBEDDINGS), ws.read("relevant_articles", schemas.RELEVANT_ARTICLES),
        ws.read("summaries", schemas.SUMMARIES), ws.read("valid_content", schemas.ARTICLE_CONTENT), NAMES,
    )
    topics = spark.read.parquet(ws.location("topics"))
    assert {"article_id", "topic", "x", "y", "z", "run_id"} == set(topics.columns)
    assert rows(topics.select("article_id")) == rows(frame.select("article_id"))
    assert spark.read.parquet(f"{ws.location('central_articles')}/run_id=RUNID_1").count() == 2
    # Counts of terms grow with the runs; done again, a run replaces its own.
    assert curation.past_counts(ws).where("bucket = -1").first()["n_texts"] == 3
    assert curation.past_counts(ws, "RUNID_2").where("bucket = -1").first()["n_texts"] == 2
    asked = spark.createDataFrame([(1, "frase con sentido")], "query_id int, text string")
    found = curation.search(ws, asked, 2).orderBy("rank").collect()
    assert [r["rank"] for r in found] == [1, 2] and all(r["article_title"] and r["article_url"] for r in found)
    assert frame.count() == 3
    assert {(r["ANA"], r["LUC"]) for r in frame.collect()} == {(2, 0), (0, 2), (1, 2)}
    assert jobs.central_articles(frame, 2).count() == 2
    assert {"topic", "x", "y", "z"} <= set(jobs.topics_and_map(frame).columns)
    queries = frame.select(F.col("article_id").alias("query_id"), F.col("summary_embedding").alias("query"))
    nearest = jobs.search(frame, queries, 1).collect()
    assert all(r["distance"] == 0 for r in nearest)


def test_ingest_and_hosted_embedder(spark, ws, tmp_path):
    hits = [
        {"persona": p, "query": "datos", "date": "2025-01-01", "title": t, "body": "marca publicidad",
         "url": "https://b.com/1", "image": "i", "source": "B"}
        for p, t in (("LUC", None), ("ANA", "Uno"), ("LUC", "Dos"))
    ]
    (tmp_path / "hits.json").write_text(json.dumps(hits), encoding="utf-8")
    (tmp_path / "pages.json").write_text("[]", encoding="utf-8")
    ws.ingest("search_hits", str(tmp_path / "hits.json"), schemas.SEARCH_HITS, "RUNID_3")
    land(ws, "RUNID_3", [("site", page([("Datos e inteligencia", "https://a.com/1")]))])
    models = curation.baseline_models(PERSONAS, KEYWORDS)
    models.embedder = ("lengths", lambda: lambda texts: [[float(len(t)), 1.0] for t in texts])
    assert curation.run_curation(ws, "RUNID_3", NAMES, models) == "success"
    article = ws.read("raw_articles_searched", schemas.RAW_ARTICLES_SEARCHED, "RUNID_3").first()
    assert article["article_title"] == "Uno"
    searches = ws.read("article_searches", schemas.ARTICLE_SEARCHES, "RUNID_3").orderBy("ord").collect()
    assert [r["query_original_personas"] for r in searches] == ["LUC", "ANA", "LUC"]
    found = ws.read("embeddings", schemas.EMBEDDINGS, "RUNID_3").collect()
    assert len(found) == 2 and {r["embedding_model"] for r in found} == {"lengths"}
    assert all(r["summary_embedding"][1] == 1.0 for r in found)


def test_a_failed_step_is_recorded(spark, ws):
    assert run(ws, "RUNID_5", resume="relevance") == "failed"
    row = spark.read.schema(schemas.RUNS_METADATA).parquet(ws.location("runs_metadata")).first()
    assert (row["RUNID"], row["status"], row["failed_step"]) == ("RUNID_5", "failed", "relevance")
    assert row["error"]
    with pytest.raises(ValueError):
        run(ws, "RUNID_5", resume="nothing")


def test_request_files(spark, ws):
    items = spark.range(450).select(F.col("id").cast("string").alias("id"))
    task = tasks.summary_task("m")
    requests = tasks.build_requests(items, task, F.lit("RUNID_1"), F.col("id"), F.col("id"))
    curation.write_requests(ws, "RUNID_1", task, requests)
    files = spark.read.text(ws.location("requests")).withColumn("file", F.input_file_name())
    sizes = sorted(r["count"] for r in files.groupBy("batch_no", "file").count().collect())
    assert sizes == [50, 200, 200]


def test_past_posts(spark):
    posts = spark.createDataFrame(
        [("ANA", "c", "https://a.com/1"), ("ANA", "c", "https://a.com/2"), ("LUC", "c", None)], schemas.PAST_POSTS
    )
    found = jobs.profile_past_posts(posts)
    assert rows(found["repeated"]) == [("ANA", "https://a.com", 2)]
    assert rows(found["posts"]) == [("ANA", 2), ("LUC", 1)]
    assert rows(found["source_lists"]) == [("ANA", 0, "https://a.com")]


def test_a_run_on_stored_answers_up_to_post_files(spark, ws, tmp_path):
    """Answers of all steps come from files; the first run writes them, the second reads them."""
    land(ws, "RUNID_1", [("site", page([("Datos e inteligencia", "https://a.com/1"), ("Marca y publicidad", "https://a.com/2")]))])
    spark.createDataFrame([("ANA", "r", "Runs data.", "-")], schemas.PERSONAS).write.parquet(ws.location("personas"))
    spark.createDataFrame([("ANA", "An old post", None)], schemas.PAST_POSTS).write.parquet(ws.location("past_posts"))

    def recorded(predictor, name):
        def run(requests, keep=()):
            out = predictor(requests, keep)
            choice = F.array(F.struct(F.struct("content").alias("message")))
            body = F.struct(F.struct("model", choice.alias("choices")).alias("body"))
            out.select(F.to_json(F.struct("custom_id", body.alias("response"))).alias("value")).write.text(str(tmp_path / name))
            return out

        return run

    def models(wrap):
        made = curation.baseline_models(PERSONAS, KEYWORDS)
        for name in ("links", "relevance", "validity", "summary"):
            task, predictor = getattr(made, name)
            setattr(made, name, (task, wrap(predictor, name)))
        made.posts = ("writer", wrap(tasks.expression_predictor(lambda c: F.concat(F.lit("Post on "), c), "writer"), "posts"))
        return made

    def results():
        found = ws.read("generated_posts", schemas.GENERATED_POSTS, "RUNID_1")
        return rows(found.select("perfil", "copy", "article_title")), rows(ws.read("analysis", "article_id string, ANA int", "RUNID_1").select("article_id", "ANA"))

    assert curation.run_curation(ws, "RUNID_1", NAMES, models(recorded), "2025-01-01 00:00:00") == "success"
    first = results()
    assert [(p, t) for p, _, t in first[0]] == [("ANA", "Datos e inteligencia")] and len(first[1]) == 2
    assert ws.read("generated_posts_rejected", "reject_reason string", "RUNID_1").first()[0] == "persona is not listed"
    assert rows(spark.read.parquet(f"{ws.location('past_posts')}").select("perfil", "copy")) == [("ANA", "An old post")]
    assert spark.read.parquet(f"{ws.location('profile_sources')}/run_id=RUNID_1").count() >= 0
    lines = [r[0] for r in spark.read.text(f"{ws.location('post_files')}/run_id=RUNID_1/perfil=ANA").collect()]
    assert "Title: Datos e inteligencia" in lines
    header = spark.read.option("header", True).csv(f"{ws.location('selection')}/run_id=RUNID_1")
    assert {(r["ANA"], r["LUC"]) for r in header.collect()} == {("R", "NR"), ("NR", "R")}

    stored = models(lambda _, name: tasks.stored_predictor(read_responses(spark, str(tmp_path / name))[0]))
    assert curation.run_curation(ws, "RUNID_1", NAMES, stored, "2025-01-01 00:00:00") == "success"
    assert results() == first


def test_sources_are_registered_and_checked(spark, ws, tmp_path):
    lines = ["https://www.a.com/x", "  https://b.com ", "http://c.com", "https://a.com", "", "https://"]
    (tmp_path / "sources.txt").write_text("\n".join(lines), encoding="utf-8")
    for _ in range(2):
        curation.register_sources(ws, str(tmp_path / "sources.txt"))
    found = spark.read.schema(schemas.SOURCES).parquet(ws.location("sources"))
    assert rows(found.where("source_name <> ''")) == [
        ("a.com", "https://a.com"), ("a.com", "https://www.a.com/x"), ("b.com", "https://b.com"),
    ]
    repeated = spark.read.schema("source_name string, n_rows bigint").parquet(ws.location("sources_repeated"))
    assert rows(repeated) == [("a.com", 2)]
