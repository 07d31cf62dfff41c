"""Column expressions on score maps (persona -> 0, 1 or 2)."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

RELEVANT = 2
SCORES = (0, 1, 2)
LANGUAGES = ("es", "ca", "en")
LANGUAGE_KEY = "article_language"


def any_relevant(scores: Column) -> Column:
    """Whether some persona's score is the top one; an empty or null map has none."""
    return F.coalesce(F.exists(F.map_values(scores), lambda s: s == RELEVANT), F.lit(False))


def score_columns(scores: Column, personas: Sequence[str]) -> list[Column]:
    """One column per persona."""
    return [F.try_element_at(scores, F.lit(p)).alias(p) for p in personas]


def recode(score: Column) -> Column:
    """R for relevant, NR for the two lower scores."""
    return F.when(score == RELEVANT, "R").when(score.isin(0, 1), "NR")


def without_language(answer: Column) -> Column:
    """The scores of an answer that also holds the article's language."""
    kept = F.map_filter(answer, lambda k, _: k != LANGUAGE_KEY)
    return F.transform_values(kept, lambda _, v: v.try_cast("int"))


def answer_language(answer: Column) -> Column:
    return F.try_element_at(answer, F.lit(LANGUAGE_KEY))


def contract_error(scores: Column, language: Column, personas: Sequence[str]) -> Column:
    """Why an answer breaks the contract, or null if it keeps it.

    It must score exactly the given personas, each 0, 1 or 2, and name a known language.
    """
    wanted = F.array(*[F.lit(p) for p in personas])
    keys = F.map_keys(scores)
    return (
        F.when(scores.isNull(), "no scores")
        .when(F.size(F.array_except(wanted, keys)) > 0, "missing persona")
        .when(F.size(F.array_except(keys, wanted)) > 0, "unknown persona")
        .when(
            ~F.forall(F.map_values(scores), lambda s: F.coalesce(s.isin(*SCORES), F.lit(False))),
            "score out of range",
        )
        .when(~F.coalesce(language.isin(*LANGUAGES), F.lit(False)), "unknown language")
    )
