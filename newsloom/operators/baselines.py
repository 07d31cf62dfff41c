"""Built-in stand-ins for the models, as column expressions. A hosted model replaces them
through `tasks.python_predictor`; answers keep the same form."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scores import LANGUAGE_KEY, LANGUAGES
from newsloom.functions.text import SENTENCE, bind, sentences
from newsloom.functions.web import ERROR_BODY, page_links
from newsloom.operators.phrases import phrase_scores
from newsloom.operators.tasks import Predictor, expression_predictor
from newsloom.operators.terms import add_counts, document_counts, scored_summary

NAME = "baseline"

# Notices that stand where an article should be.
NOTICES = (
    "subscribe to continue",
    "subscribe to read",
    "log in to continue",
    "sign in to continue",
    "enable javascript",
    "403 forbidden",
    "404 not found",
    "page not found",
    "access denied",
    "error 451",
)
MIN_CHARS = 200
MIN_SENTENCES = 3


def words_only(text: Column) -> Column:
    """Lower-case words with one space before and after each."""
    return F.concat(
        F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" ")
    )


def keyword_score(words: Column, keywords: Sequence[str]) -> Column:
    """2 for two or more of the keywords, 1 for one, 0 for none; `words` from `words_only`."""
    # Keywords are cleaned like the text, so that those with marks in them match.
    hits = [F.contains(words, words_only(F.lit(keyword))).cast("int") for keyword in keywords]
    return F.least(sum(hits, F.lit(0)), F.lit(2))


def keyword_scores(text: Column, persona_keywords: Mapping[str, Sequence[str]]) -> Column:
    """map<persona, score>."""
    words = words_only(text)
    entries = []
    for persona, keywords in persona_keywords.items():
        entries += [F.lit(persona), keyword_score(words, keywords)]
    return F.create_map(*entries)


def is_article(text: Column) -> Column:
    """Long enough, of several sentences, and neither an error body nor a notice."""
    lowered = F.lower(text)
    notice = F.lit(False)
    for phrase in NOTICES:
        notice = notice | F.contains(lowered, F.lit(phrase))
    return (
        (F.length(text) >= MIN_CHARS) & (F.regexp_count(text, F.lit(SENTENCE)) >= MIN_SENTENCES) & ~notice
        & ~text.rlike(ERROR_BODY)
    )


def lead_summary(text: Column, n: int = 3) -> Column:
    """The first `n` sentences; fewer only if the text has fewer."""
    return F.array_join(F.transform(F.slice(sentences(text), 1, n), lambda s: F.trim(s)), " ")


def links_predictor() -> Predictor:
    def content(page: Column) -> Column:
        links = F.transform(
            page_links(page),
            lambda link: F.struct(
                link["title"].alias("title"),
                link["url"].alias("url"),
                F.array().cast("array<string>").alias("keywords"),
                F.lit("").alias("language"),
            ),
        )
        # The request holds line feeds as two characters.
        return F.to_json(F.struct(links.alias("article_links_list")))

    return expression_predictor(lambda c: content(F.replace(c, F.lit("\\n"), F.lit("\n"))), NAME)


def relevance_predictor(
    persona_keywords: Mapping[str, Sequence[str]], language: str = "es"
) -> Predictor:
    """Scores the texts of the article inside the request; the language is a constant."""

    def answer(article: Column) -> Column:
        known = F.when(article["article_language"].isin(*LANGUAGES), article["article_language"])
        return bind(
            words_only(F.concat_ws(" ", article["article_title"], article["article_info"])),
            lambda words: F.to_json(
                F.struct(
                    *[keyword_score(words, k).alias(p) for p, k in persona_keywords.items()],
                    F.coalesce(known, F.lit(language)).alias(LANGUAGE_KEY),
                )
            ),
        )

    def content(request: Column) -> Column:
        schema = "article_title string, article_info string, article_language string"
        return bind(F.from_json(request, schema), answer)

    return expression_predictor(content, NAME)


def phrase_relevance_predictor(keywords: DataFrame, personas: Sequence[str], language: str = "es") -> Predictor:
    """As `relevance_predictor`, with a table (persona, keyword) of any number of rows."""

    def run(requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        article = F.from_json("user_content", "article_title string, article_info string, article_language string")
        texts = requests.select(
            "custom_id", F.concat_ws(" ", article["article_title"], article["article_info"]).alias("text")
        )
        scores = phrase_scores(texts, keywords, "custom_id", "text", personas).withColumnRenamed("custom_id", "__id")
        known = F.when(article["article_language"].isin(*LANGUAGES), article["article_language"])
        # The texts are not exchanged for the join.
        asked = requests.select("custom_id", F.coalesce(known, F.lit(language)).alias("__language"), *keep)
        joined = asked.join(scores, F.col("custom_id").eqNullSafe(F.col("__id")), "left")
        fields = [F.coalesce(F.col("scores")[p], F.lit(0)).alias(p) for p in personas]
        return joined.select(
            "custom_id",
            F.lit(NAME).alias("model"),
            F.to_json(F.struct(*fields, F.col("__language").alias(LANGUAGE_KEY))).alias("content"),
            F.lit(None).cast("string").alias("error"),
            *keep,
        )

    return run


def validity_predictor() -> Predictor:
    return expression_predictor(
        lambda text: F.to_json(F.struct(is_article(text).alias("validity"))), NAME
    )


def summary_predictor(n: int = 3) -> Predictor:
    return expression_predictor(lambda text: lead_summary(text, n), NAME)


def scored_summary_predictor(counts: DataFrame | None = None) -> Predictor:
    """Summaries of the sentences that score best; see `terms.scored_summary`.

    Rarity is that of the texts asked about and of the corpus behind `counts`, if given, as
    from `terms.document_counts`. The texts are read twice.
    """

    def run(requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        own = document_counts(requests, "user_content")
        known = own if counts is None else add_counts(own, counts)
        predict = expression_predictor(lambda text: scored_summary(text, known), NAME)
        return predict(requests, keep)

    return run
