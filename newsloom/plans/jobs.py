"""The jobs, each from tables to tables. `curation` runs them on a workspace."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scores import score_columns
from newsloom.functions.text import (
    article_info,
    normalize_source,
    row_json,
    strip,
    surrogate_id,
    token_count,
)
from newsloom.functions.web import html_published, html_text, url_host
from newsloom.operators import profile
from newsloom.operators.batching import TOKEN_BUDGET, token_chunks
from newsloom.operators.history import duplicate_keys, last_per_key, new_articles
from newsloom.operators.hits import article_searches, fold_hits, hits_to_articles
from newsloom.operators.joins import analysis_frame, drop_invalid, relevant_articles, unite
from newsloom.operators.neighbours import nearest, nearest_to_centroid
from newsloom.operators.tasks import (
    Predictor,
    Task,
    build_requests,
    parse_links,
    parse_relevance,
    parse_summaries,
    parse_validity,
)
from newsloom.operators.terms import text_embedder
from newsloom.operators.topics import assign_topics, project
from newsloom.operators.validation import has_payload, validate
from newsloom.schemas import CRAWLED, SEARCHED
from newsloom.session import compute_once, spread, store

@dataclass
class Outcome:
    """A job's table and the rows it set aside, with their reason."""

    table: DataFrame
    rejected: DataFrame


def register_sources(lines: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(sources, duplicate names) of a list of URLs; lines without https:// are skipped."""
    sources = lines.where(F.contains(line, F.lit("https://"))).select(
        url_host(F.col(line)).alias("source_name"), strip(F.col(line)).alias("url")
    )
    return sources, duplicate_keys(sources, ["source_name"])


def landed_pages(pages: DataFrame) -> Outcome:
    """Crawled pages that hold something, by normalised source name."""
    named = pages.where(has_payload("raw_content")).withColumn("name", normalize_source(F.col("name")))
    return Outcome(*validate(named, "source_raw_content"))


def extract_articles(
    pages: DataFrame, run_id: str, crawled_at: str, task: Task, predictor: Predictor
) -> Outcome:
    """Articles linked from the crawled pages."""
    requests = build_requests(spread(pages), task, F.lit(run_id), F.col("name"), F.col("raw_content"))
    links, rejected = parse_links(predictor(requests), task.contract)
    articles = links.withColumn("crawled_at", F.lit(crawled_at)).withColumn(
        "article_id",
        surrogate_id(
            F.col("source_name"), F.col("run_id"), F.col("link_no").cast("string"),
            F.col("article_url"), F.col("article_title"),
        ),
    )
    valid, invalid = validate(articles, "raw_articles_crawled")
    return Outcome(valid.drop("link_no"), unite(rejected, invalid))


def consolidate_hits(hits: DataFrame, run_id: str, crawled_at: str) -> Outcome:
    """One searched article per URL."""
    # Read from both sides; hits are folded once.
    articles = store(hits_to_articles(fold_hits(hits), run_id, crawled_at), "searched")
    return Outcome(*validate(articles, "raw_articles_searched"))


def searches_of(hits: DataFrame, articles: DataFrame) -> DataFrame:
    """Personas and queries that found the searched articles, a row per hit."""
    return article_searches(hits, articles)


def one_row(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The row of each key that is greatest by `order`."""
    return last_per_key(df.withColumn("__order", order), keys, "__order").drop("__order")


def combine_and_dedupe(searched: DataFrame, crawled: DataFrame, history: DataFrame) -> DataFrame:
    """This run's articles from both crawls that no other run has brought."""
    both = unite(
        searched.withColumn("crawling_source", F.lit(SEARCHED)),
        crawled.withColumn("crawling_source", F.lit(CRAWLED)),
    )
    return new_articles(both, history, prune_history=True)


def score_articles(
    raw: DataFrame, run_id: str, task: Task, predictor: Predictor, personas: Sequence[str]
) -> Outcome:
    """Relevant articles of the run, with the scores of every persona. Of several rows of an
    article the one crawled last counts."""
    when = [F.col("crawled_at")] if "crawled_at" in raw.columns else []
    raw = one_row(raw, ["article_id"], F.struct(*when, F.xxhash64(*raw.columns)))
    described = raw.withColumn(
        "article_info",
        article_info(F.col("crawling_source"), F.col("article_keywords"), F.col("article_body")),
    )
    requests = build_requests(
        described, task, F.lit(run_id), F.col("article_id"), row_json("*")
    )
    outputs, rejected = parse_relevance(predictor(requests), personas)
    return Outcome(relevant_articles(outputs, raw), rejected)


def read_content(relevant: DataFrame, pages: DataFrame, url: str = "url", html: str = "html") -> Outcome:
    """Text and publish day of the relevant articles, from their downloaded pages.

    The few articles go to the many pages: the planner broadcasts them while they are small,
    and no page without an article is exchanged or parsed. Of several copies of a page one
    is read: that with content, of these that with the greatest digest.
    """
    wanted = relevant.select("run_id", "article_id", "article_title", "article_url")
    found = pages.select(F.col(url).alias("article_url"), F.col(html).alias("html")).join(
        wanted, "article_url"
    )
    read = compute_once(found, content=F.nullif(html_text(F.col("html")), F.lit(""))).select(
        "run_id",
        "article_id",
        "content",
        F.col("article_title").alias("title"),
        html_published(F.col("html")).alias("publish_date"),
    )
    copies = read.where(F.col("content").isNotNull())
    one = one_row(copies, ["run_id", "article_id"], F.sha2(F.concat_ws("\u0001", "publish_date", "content"), 256))
    # Read from both sides; pages are parsed once.
    content = store(one, "content")
    rejected = wanted.join(content, ["run_id", "article_id"], "left_anti").select(
        "run_id", "article_id", F.lit("no content").alias("reject_reason")
    )
    return Outcome(content, rejected)


def keep_valid(
    content: DataFrame, run_id: str, task: Task, predictor: Predictor, chars: int | None = None
) -> Outcome:
    """Content without what the model calls no article. With `chars` the model is shown only
    so many characters of each; the stored content stays whole."""
    seen = F.col("content") if chars is None else F.substring("content", 1, chars)
    requests = build_requests(spread(content), task, F.lit(run_id), F.col("article_id"), seen)
    verdicts, rejected = parse_validity(predictor(requests), task.contract)
    return Outcome(drop_invalid(content, verdicts), rejected)


def summarize(content: DataFrame, run_id: str, task: Task, predictor: Predictor) -> Outcome:
    requests = build_requests(spread(content), task, F.lit(run_id), F.col("article_id"), F.col("content"))
    return Outcome(*parse_summaries(predictor(requests)))


def embedding_calls(
    summaries: DataFrame, counter=token_count, budget: int = TOKEN_BUDGET, count_opener: bool = False
) -> DataFrame:
    """(run_id, article_id, token_count, chunk_no): the call that each summary goes out with;
    a null summary goes out with none."""
    counted = summaries.where(F.col("summary").isNotNull()).select(
        "run_id", "article_id", counter(F.col("summary")).alias("token_count")
    )
    return token_chunks(
        counted, ["run_id"], ["article_id"], budget=budget, count_opener=count_opener
    )


def embed_summaries(summaries: DataFrame, embed, model: str) -> DataFrame:
    """`embed` as from `text_embedder`; ids stay in the row with their vector."""
    return embed(summaries, "summary", "summary_embedding").select(
        "run_id", "article_id", "summary_embedding", F.lit(model).alias("embedding_model")
    )


def analyse(
    embeddings: DataFrame,
    relevant: DataFrame,
    summaries: DataFrame,
    content: DataFrame,
    personas: Sequence[str],
    runs: Sequence[str] | None = None,
) -> DataFrame:
    """The joined article table with a score column per persona, of all runs or some."""
    if runs is not None:
        keep = F.col("run_id").isin(*runs)
        embeddings, relevant, summaries, content = (
            df.where(keep) for df in (embeddings, relevant, summaries, content)
        )
    # Embeddings and content once had no run column; theirs would only repeat the others'.
    frame = analysis_frame(
        embeddings.drop("run_id"), relevant, summaries, content.drop("run_id")
    )
    return frame.select("*", *score_columns(F.col("relevance"), personas)).drop("relevance")


def topics_and_map(frame: DataFrame, vector: str = "summary_embedding") -> DataFrame:
    """Each article with its topic and its place on three axes."""
    return project(assign_topics(frame, vector), vector)


def search(frame: DataFrame, queries: DataFrame, k: int = 5, vector: str = "summary_embedding") -> DataFrame:
    """The k articles nearest to each query vector (query_id, query)."""
    return nearest(frame, queries, "article_id", "query_id", vector, "query", k)


def search_summaries(
    summaries: DataFrame, queries: DataFrame, counts: DataFrame | None = None, k: int = 5
) -> DataFrame:
    """The k articles whose summaries are nearest to each query (query_id, text).

    Both are embedded here, with the words' rarity by `counts`: stored vectors of several
    runs could only be compared without it.
    """
    embed = text_embedder(counts=counts)
    corpus = embed(spread(summaries), "summary", "vector").select("article_id", "vector")
    asked = embed(queries, "text", "query").select("query_id", "query")
    return nearest(corpus, asked, "article_id", "query_id", "vector", "query", k)


def central_articles(frame: DataFrame, k: int = 5, vector: str = "summary_embedding") -> DataFrame:
    return nearest_to_centroid(frame, "article_id", vector, k)


def profile_past_posts(posts: DataFrame) -> dict[str, DataFrame]:
    """Counts per profile, links, sources per profile, repeated ones, and source lists."""
    counts = profile.source_counts(posts)
    repeated = profile.repeated_sources(counts)
    return {
        "posts": profile.value_counts(posts, "perfil"),
        "links": profile.count_present(posts, "perfil", "link"),
        "sources": counts,
        "repeated": repeated,
        "profiles_with_repeats": profile.value_counts(repeated, "perfil"),
        "source_lists": profile.distinct_values(counts, "perfil", "article_source"),
    }
