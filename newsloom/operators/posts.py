"""Post prompts per persona and article."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.scores import RELEVANT
from newsloom.functions.text import dedent, strip
from newsloom.operators.tasks import Predictor
from newsloom.operators.validation import REASON
from newsloom.session import store

# Examples and articles drawn per persona.
EXAMPLES = 5
ARTICLES = 5

# What a post should be, where the caller does not say.
BRIEF = (
    "Tell the executive's network what the article reports and what it changes for people in their "
    "line of work, as they themselves would say it."
)
# What about half of the prompts ask for besides.
CLOSING = "Invite readers to add what they have seen."


def _draw(row_id: Column, seed: int) -> Column:
    """A number in hexadecimal digits that depends on the id and the seed only."""
    return F.md5(F.concat_ws(":", row_id.cast("string"), F.lit(str(seed))))


def seeded_sample(
    df: DataFrame, keys: Sequence[str], id_col: str, n: int, seed: int = 0
) -> DataFrame:
    """min(n, size) rows of each group, those first by the MD5 of id and seed: the same on every run.

    Only n rows per group and task are exchanged.
    """
    window = Window.partitionBy(*keys).orderBy(_draw(F.col(id_col), seed), id_col)
    return df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") <= n).drop("__rn")


def coin(id_col: Column, seed: int = 0) -> Column:
    """True for about half of the ids: the first digit of the MD5 of id and seed is even."""
    return F.substring(_draw(id_col, seed), 1, 1).isin(*"02468ace")


def numbered_examples(examples: Column) -> Column:
    """`Example 1:` and so on over the texts of an array, blank lines between."""
    return F.array_join(
        F.transform(
            examples,
            lambda text, i: F.concat(F.lit("Example "), (i + 1).cast("string"), F.lit(":\n"), text),
        ),
        "\n\n",
    )


def example_posts(past: DataFrame, id_col: str, n: int = EXAMPLES, seed: int = 0) -> DataFrame:
    """(perfil, examples): up to n past posts of each profile."""
    drawn = seeded_sample(past.where(F.col("copy").isNotNull()), ["perfil"], id_col, n, seed)
    items = F.sort_array(F.collect_list(F.struct(id_col, "copy")))
    return drawn.groupBy("perfil").agg(items["copy"].alias("examples"))


def relevant_pairs(articles: DataFrame) -> DataFrame:
    """One row per article and persona to whom it is relevant."""
    return (
        articles.select("*", F.explode("relevance").alias("perfil", "score"))
        .where(F.col("score") == RELEVANT)
        .drop("score", "relevance")
    )


def unlisted_pairs(articles: DataFrame, personas: DataFrame) -> DataFrame:
    """(article_id, perfil, reject_reason) of relevant pairs whose persona is not in `personas`."""
    pairs = relevant_pairs(articles.select("article_id", "relevance"))
    listed = personas.select(F.col("name").alias("perfil"))
    return pairs.join(listed, "perfil", "left_anti").select(
        "article_id", "perfil", F.lit("persona is not listed").alias(REASON)
    )


def post_prompts(
    articles: DataFrame,
    personas: DataFrame,
    past: DataFrame,
    past_id: str,
    n_articles: int | None = ARTICLES,
    n_examples: int = EXAMPLES,
    seed: int = 0,
    brief: str = BRIEF,
    closing: str = CLOSING,
) -> DataFrame:
    """One (system, user) prompt per persona and drawn article.

    `n_articles` = None keeps every relevant article. `brief` says what to write, `closing` what
    a prompt adds to it when its coin says so. The prompt of an article stands
    alone and holds nothing of the prompts before it. Personas must be in `personas`: the
    pairs of others are in `unlisted_pairs`, for a reject table.
    """
    pairs = relevant_pairs(
        articles.select(
            "article_id", "article_title", "article_language", "summary", "article_url", "relevance"
        )
    )
    if n_articles is not None:
        pairs = seeded_sample(pairs, ["perfil"], "article_id", n_articles, seed)
    bios = personas.select(F.col("name").alias("perfil"), "linkedin_bio")
    # One row per persona. Stored, so that the planner knows its size: a few personas are
    # broadcast and their many articles stay where they are.
    voices = store(
        bios.join(example_posts(past, past_id, n_examples, seed), "perfil", "left"), "voices"
    )
    joined = pairs.join(voices, "perfil")
    tossed = coin(F.concat_ws("\u0001", "perfil", "article_id"), seed)
    task = F.concat_ws(" ", F.lit(brief), F.when(tossed, F.lit(closing)))
    system = F.concat_ws(
        "\n\n",
        task,
        F.concat(F.lit("The executive:\n"), F.coalesce("linkedin_bio", F.lit(""))),
        F.when(
            F.col("examples").isNotNull(),
            F.concat(F.lit("Their earlier posts:\n\n"), numbered_examples(F.col("examples"))),
        ),
        F.concat(F.lit("Language of the post: "), F.coalesce("article_language", F.lit("en"))),
    )
    user = strip(dedent(F.concat_ws("\n", "article_title", "summary")))
    return joined.select(
        "perfil",
        "article_id",
        "article_title",
        "article_language",
        "summary",
        "article_url",
        system.alias("system_content"),
        user.alias("user_content"),
    )


def generate_posts(
    prompts: DataFrame, predictor: Predictor, model: str
) -> tuple[DataFrame, DataFrame]:
    """(generated posts, prompts that gave none with the reason), from `post_prompts`."""
    keep = ["perfil", "article_id", "article_title", "article_language", "summary", "article_url"]
    requests = prompts.withColumns(
        {
            "custom_id": F.concat_ws("--", "perfil", F.lit("post"), "article_id"),
            "model": F.lit(model),
        }
    )
    # Read from both sides; the model must answer only once.
    answers = store(predictor(requests, keep), "posts")
    good = answers.where(F.col("content").isNotNull()).select(
        "perfil", strip(F.col("content")).alias("copy"),
        "article_title", "article_language", "summary", "article_url",
    )
    reason = F.coalesce(F.concat(F.lit("model error: "), "error"), F.lit("no content"))
    rejected = answers.where(F.col("content").isNull()).select("perfil", "article_id", reason.alias(REASON))
    return good, rejected


def article_user_message(*columns: str) -> Column:
    """The article as JSON, for a prompt about a single article."""
    return F.concat(
        F.lit("The article:\n\n"),
        F.to_json(F.struct(*columns), {"pretty": "true", "ignoreNullFields": "false"}),
    )


def post_text(post: Column, title: Column, url: Column) -> Column:
    """A record of the per-persona export."""
    return F.concat(F.lit("Title: "), title, F.lit("\nURL: "), url, F.lit("\nCopy:\n"), post, F.lit("\n"))
