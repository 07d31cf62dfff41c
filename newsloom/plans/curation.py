"""A run over a workspace of tables. Steps pass data through stored tables only, so that a
run can be taken up again at any step."""

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import baselines, posts, tasks
from newsloom.operators.batching import assign_batches
from newsloom.operators.tasks import Predictor, Task, request_json
from newsloom.operators.terms import COUNTS, add_counts, document_counts, text_embedder
from newsloom.operators.validation import validate
from newsloom.plans import jobs
from newsloom.plans.exchange import Exchange, Waiting
from newsloom.session import scratch_scope, store
from newsloom.sources.readers import read_json_array, read_lines, read_table
from newsloom.sources.writers import (
    append_ledger,
    replace_run,
    selection,
    write_posts,
    write_request_files,
    write_run,
    write_selection,
)

RUN = ", run_id string"
# The step to resume is the one the run last ended at.
OPEN = "open"

log = logging.getLogger(__name__)


@dataclass
class Models:
    """A task and a predictor for each model step."""

    links: tuple[Task, Predictor]
    relevance: tuple[Task, Predictor]
    validity: tuple[Task, Predictor]
    summary: tuple[Task, Predictor]
    # Name and factory of a hosted embedder, as `tasks.embed_calls` takes it; without one,
    # summaries become hashed word counts of `dimensions`.
    embedder: tuple[str, Callable] | None = None
    dimensions: int = 256
    # Name and predictor of the model that writes posts; without one, a run ends before them.
    posts: tuple[str, Predictor] | None = None


def baseline_models(
    personas: Sequence[tuple[str, str]],
    keywords: Mapping[str, Sequence[str]] | DataFrame,
    counts: DataFrame | None = None,
) -> Models:
    """The built-in models; `keywords` as lists by persona, or as a table (persona, keyword);
    `counts` as from `past_counts`, for the rarity of words in summaries."""
    name = baselines.NAME
    if isinstance(keywords, DataFrame):
        relevance = baselines.phrase_relevance_predictor(keywords, [p for p, _ in personas])
    else:
        relevance = baselines.relevance_predictor(keywords)
    return Models(
        (tasks.link_task(name), baselines.links_predictor()),
        (tasks.relevance_task(name, personas), relevance),
        (tasks.validity_task(name), baselines.validity_predictor()),
        (tasks.summary_task(name), baselines.scored_summary_predictor(counts)),
    )


def batch_models(ws: "Workspace", run_id: str, personas: Sequence[tuple[str, str]], model: str) -> Models:
    """Models that take requests as files and answer as files, in the folder `exchange`."""

    def step(task: Task) -> tuple[Task, Predictor]:
        return task, Exchange(ws.spark, ws.location("exchange"), run_id, task)

    return Models(
        step(tasks.link_task(model)), step(tasks.relevance_task(model, personas)),
        step(tasks.validity_task(model)), step(tasks.summary_task(model)),
    )


class Workspace:
    """Run-partitioned Parquet tables under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        # Rows last written per table and run.
        self.counts: dict[tuple[str, str], int] = {}

    def location(self, table: str) -> str:
        return f"{self.path}/{table}"

    def read(self, table: str, schema: str, run_id: str | None = None, required: bool = True) -> DataFrame:
        return read_table(self.spark, self.location(table), schema, run_id, required)

    def write(self, table: str, df: DataFrame, run_id: str) -> None:
        """Replace the run's rows. They are counted as they are written."""
        rows = Observation()
        counted = df.observe(rows, F.count(F.lit(1)).alias("n"))
        replace_run(counted, self.location(table), run_id)
        self.counts[table, run_id] = rows.get["n"]
        log.info("%s of %s: %d rows", table, run_id, rows.get["n"])

    def ingest(self, table: str, path: str, schema: str, run_id: str) -> None:
        """Take in a run's JSON array; `ord` keeps the order of its records."""
        rows = read_json_array(self.spark, path, schema, ordinal=True)
        self.write(table, rows, run_id)

    def write_outcome(self, table: str, outcome: jobs.Outcome, run_id: str) -> None:
        self.write(table, outcome.table, run_id)
        rejected = outcome.rejected
        context = F.to_json(F.struct(*[c for c in rejected.columns if c != "reject_reason"]))
        self.write(
            f"{table}_rejected", rejected.select("reject_reason", context.alias("record")), run_id
        )


def register_sources(ws: Workspace, path: str) -> None:
    """Take in a list of source URLs: tables `sources`, `sources_rejected` and, as a report, the
    names that repeat, `sources_repeated`."""
    sources, repeated = jobs.register_sources(read_lines(ws.spark, path))
    valid, rejected = validate(sources, "sources")
    for name, rows in (("sources", valid), ("sources_rejected", rejected), ("sources_repeated", repeated)):
        rows.write.mode("overwrite").parquet(ws.location(name))


def run_curation(
    ws: Workspace,
    run_id: str,
    personas: Sequence[str],
    models: Models,
    crawled_at: str | None = None,
    resume: str | None = None,
    location: str = "local",
) -> str:
    """Run all steps, or those from `resume` on, and add the run to the ledger.

    The workspace must hold the landed pages (source_raw_content), and the article pages
    (article_pages: url, html) once articles are known; search_hits may be missing. With a
    model for posts, it also holds `personas`, and `past_posts` if there are any: then the
    run goes on to the analysis table, the selection file, and posts per persona.
    Returns the status, which is recorded with the step that ended the run. A model that takes
    files (`batch_models`) makes the run end as waiting once its requests are written, and
    again until its answers have landed. `resume` is the name of a step, or OPEN: the step at
    which the run last ended, from the ledger, or the first step of a run that is not in it.
    """
    crawled_at = crawled_at or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    steps: dict[str, Callable[[], None]] = {
        "crawl": lambda: _crawl(ws, run_id, models, crawled_at),
        "search": lambda: _search(ws, run_id, crawled_at),
        "dedupe": lambda: _dedupe(ws, run_id),
        "relevance": lambda: _relevance(ws, run_id, models, personas),
        "content": lambda: _content(ws, run_id),
        "validity": lambda: _validity(ws, run_id, models),
        "summaries": lambda: _summaries(ws, run_id, models),
        "embeddings": lambda: _embeddings(ws, run_id, models),
        "analysis": lambda: _analysis(ws, run_id, personas),
        "topics": lambda: _topics(ws, run_id),
    }
    if models.posts:
        steps["posts"] = lambda: _posts(ws, run_id, models)
    names = list(steps)
    if resume == OPEN:
        resume = open_step(ws, run_id)
    if resume is not None and resume not in steps:
        raise ValueError(f"unknown step {resume!r}; steps are {names}")
    start, status, stopped, error = time.time(), "success", None, None
    for name in names[names.index(resume) if resume else 0:]:
        try:
            with scratch_scope(ws.spark):
                steps[name]()
        except Waiting as e:
            log.info("step %s of %s waits: %s", name, run_id, e)
            status, stopped, error = "waiting", name, str(e)
            break
        except Exception as e:
            log.exception("step %s of %s failed", name, run_id)
            status, stopped, error = "failed", name, str(e)
            break
    entry = (
        run_id, status, location, time.time() - start,
        datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"), stopped, error,
    )
    append_ledger(
        ws.spark.createDataFrame([entry], schemas.RUNS_METADATA), ws.location("runs_metadata")
    )
    return status


def open_step(ws: Workspace, run_id: str) -> str | None:
    """The step at which a run last ended without success; None if it is not in the ledger or
    has succeeded."""
    own = ws.read("runs_metadata", schemas.RUNS_METADATA, required=False).where(F.col("RUNID") == run_id)
    last = own.agg(F.max(F.struct("pipeline_finish_time", "failed_step"))["failed_step"].alias("step"))
    return last.first()["step"]


def write_requests(ws: Workspace, run_id: str, task: Task, requests: DataFrame) -> None:
    """The request files of a task, for a model that takes them as files.

    `requests` is from `build_requests`; batches hold 200 rows in the order of custom_id.
    """
    batched = assign_batches(requests, ["custom_id"])
    write_request_files(
        batched.withColumns({"run_id": F.lit(run_id), "task_name": F.lit(task.name)}),
        ws.location("requests"),
        request_json(task),
    )


def _crawl(ws: Workspace, run_id: str, models: Models, crawled_at: str) -> None:
    pages = jobs.landed_pages(ws.read("source_raw_content", schemas.SOURCE_RAW_CONTENT + RUN, run_id))
    ws.write_outcome(
        "raw_articles_crawled",
        jobs.extract_articles(pages.table, run_id, crawled_at, *models.links),
        run_id,
    )


def _search(ws: Workspace, run_id: str, crawled_at: str) -> None:
    hits = ws.read("search_hits", schemas.SEARCH_HITS + ", ord bigint" + RUN, run_id, required=False)
    ws.write_outcome("raw_articles_searched", jobs.consolidate_hits(hits, run_id, crawled_at), run_id)
    found = ws.read("raw_articles_searched", schemas.RAW_ARTICLES_SEARCHED, run_id)
    ws.write("article_searches", jobs.searches_of(hits, found), run_id)


def _dedupe(ws: Workspace, run_id: str) -> None:
    searched = ws.read(
        "raw_articles_searched", schemas.RAW_ARTICLES_SEARCHED, run_id, required=False
    )
    crawled = ws.read("raw_articles_crawled", schemas.RAW_ARTICLES_CRAWLED, run_id)
    history = ws.read("raw_articles", schemas.RAW_ARTICLES, required=False)
    fresh = jobs.combine_and_dedupe(searched, crawled, history)
    # The table that is read as history is also the one written. Without new articles the
    # run keeps what it had.
    write_run(store(fresh, "fresh"), ws.location("raw_articles"))


def _relevance(ws: Workspace, run_id: str, models: Models, personas: Sequence[str]) -> None:
    raw = ws.read("raw_articles", schemas.RAW_ARTICLES, run_id)
    outcome = jobs.score_articles(raw, run_id, *models.relevance, personas)
    ws.write_outcome("relevant_articles", outcome, run_id)


def _content(ws: Workspace, run_id: str) -> None:
    relevant = ws.read("relevant_articles", schemas.RELEVANT_ARTICLES, run_id)
    pages = ws.spark.read.schema("url string, html string").parquet(ws.location("article_pages"))
    ws.write_outcome("article_content", jobs.read_content(relevant, pages), run_id)


def _validity(ws: Workspace, run_id: str, models: Models) -> None:
    content = ws.read("article_content", schemas.ARTICLE_CONTENT + RUN, run_id)
    ws.write_outcome("valid_content", jobs.keep_valid(content, run_id, *models.validity), run_id)
    valid = ws.read("valid_content", schemas.ARTICLE_CONTENT, run_id)
    ws.write("term_counts", document_counts(valid, "content"), run_id)


def past_counts(ws: Workspace, run_id: str | None = None) -> DataFrame:
    """How many valid texts of all runs, but for `run_id`, hold each term. A run adds its own
    counts, and replaces them when it is done again."""
    counts = ws.read("term_counts", COUNTS, required=False)
    return add_counts(counts if run_id is None else counts.where(F.col("run_id") != run_id))


def search(ws: Workspace, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k articles of all runs nearest to each query (query_id, text): query_id, article_id,
    distance, rank, article_title, article_url."""
    found = jobs.search_summaries(ws.read("summaries", schemas.SUMMARIES), queries, past_counts(ws), k)
    known = ws.read("relevant_articles", schemas.RELEVANT_ARTICLES)
    named = known.groupBy("article_id").agg(
        F.max(F.struct("run_id", "article_title", "article_url")).alias("a")
    )
    return found.join(named, "article_id", "left").select(
        "query_id", "article_id", "distance", "rank", "a.article_title", "a.article_url"
    )


def _topics(ws: Workspace, run_id: str) -> None:
    """The run's articles with their topic and place on the map, and the most central ones."""
    analysed = ws.spark.read.parquet(f"{ws.location('analysis')}/run_id={run_id}")
    frame = store(analysed.select("article_id", "summary_embedding"), "frame")
    if frame.isEmpty():
        return
    ws.write("topics", jobs.topics_and_map(frame).drop("summary_embedding"), run_id)
    ws.write("central_articles", jobs.central_articles(frame), run_id)


def _summaries(ws: Workspace, run_id: str, models: Models) -> None:
    content = ws.read("valid_content", schemas.ARTICLE_CONTENT + RUN, run_id)
    ws.write_outcome("summaries", jobs.summarize(content, run_id, *models.summary), run_id)


def _embeddings(ws: Workspace, run_id: str, models: Models) -> None:
    summaries = ws.read("summaries", schemas.SUMMARIES, run_id)
    if models.embedder:
        name, factory = models.embedder
        calls = jobs.embedding_calls(summaries).drop("token_count")
        # Read from both sides; the model must answer only once.
        answers = store(
            tasks.embed_calls(
                summaries.join(calls, ["run_id", "article_id"]), factory, name
            ),
            "embeddings",
        )
        failed = answers.where(F.col("error").isNotNull()).select(
            "article_id", F.concat(F.lit("model error: "), "error").alias("reject_reason")
        )
        done = answers.where(F.col("error").isNull()).drop("error")
        ws.write_outcome("embeddings", jobs.Outcome(done, failed), run_id)
        return
    embed = text_embedder(dimensions=models.dimensions)
    embedded = jobs.embed_summaries(summaries, embed, f"hashed-{models.dimensions}")
    ws.write("embeddings", embedded, run_id)


def _analysis(ws: Workspace, run_id: str, personas: Sequence[str]) -> None:
    """The joined table of the run's articles, and the selection that people read."""
    frame = jobs.analyse(
        ws.read("embeddings", schemas.EMBEDDINGS, run_id).withColumn("run_id", F.lit(run_id)),
        ws.read("relevant_articles", schemas.RELEVANT_ARTICLES, run_id),
        ws.read("summaries", schemas.SUMMARIES, run_id),
        ws.read("valid_content", schemas.ARTICLE_CONTENT, run_id).withColumn("run_id", F.lit(run_id)),
        personas,
    )
    # Columns that two of the tables have are kept once.
    one = frame.withColumnsRenamed({f"{c}_x": c for c in ("run_id", "model", "task_name")})
    ws.write("analysis", one.drop(*[c for c in one.columns if c.endswith("_y")]), run_id)
    analysed = ws.spark.read.parquet(f"{ws.location('analysis')}/run_id={run_id}")
    write_selection(selection(analysed, personas), f"{ws.location('selection')}/run_id={run_id}")


def _posts(ws: Workspace, run_id: str, models: Models) -> None:
    name, predictor = models.posts
    relevant = ws.read("relevant_articles", schemas.RELEVANT_ARTICLES, run_id)
    summaries = ws.read("summaries", schemas.SUMMARIES, run_id).select("article_id", "summary")
    articles = relevant.join(summaries, "article_id")
    personas = ws.spark.read.schema(schemas.PERSONAS).parquet(ws.location("personas"))
    past = ws.read("past_posts", schemas.PAST_POSTS, required=False)
    for table, profile in jobs.profile_past_posts(past).items():
        ws.write(f"profile_{table}", profile, run_id)
    past = past.withColumn("post_id", F.sha2("copy", 256))
    prompts = posts.post_prompts(articles, personas, past, "post_id")
    good, rejected = posts.generate_posts(prompts, predictor, name)
    unlisted = posts.unlisted_pairs(articles, personas)
    ws.write_outcome("generated_posts", jobs.Outcome(good, rejected.unionByName(unlisted)), run_id)
    written = ws.read("generated_posts", schemas.GENERATED_POSTS, run_id)
    write_posts(written, f"{ws.location('post_files')}/run_id={run_id}")
