"""Model tasks: request rows, a predictor over them, and its parsed answers."""

import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scores import (
    SCORES,
    LANGUAGES,
    LANGUAGE_KEY,
    answer_language,
    contract_error,
    without_language,
)
from newsloom.functions.text import bind, escape_newlines, readable_key, split_key
from newsloom.operators.contracts import contract_fault
from newsloom.operators.validation import REASON
from newsloom.session import spread, store

RESPONSE = "custom_id string, model string, content string, error string"

# The names of the tasks, and of the forms their answers take.
LINKS, LINKS_FORM = "source_parsing_v0", "ArticleLinksList"
RELEVANCE, RELEVANCE_FORM = "relevance_check_v0", "ArticleRelevanceCheck"
VALIDITY, VALIDITY_FORM = "content_validation_v0", "ArticleContentValidity"
SUMMARY = "article_summarization_v0"

REQUEST = ["custom_id", "model", "system_content", "user_content"]


class Predictor(Protocol):
    """Turns request rows (the REQUEST columns) into RESPONSE rows, one each. Columns named
    in `keep` stay in the row, so that nothing has to be joined back."""

    def __call__(self, requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame: ...


@dataclass(frozen=True)
class Task:
    """What is asked of a model: its instructions, the form of the answer, and options."""

    name: str
    model: str
    system_prompt: str
    contract: dict | None = None
    contract_name: str | None = None
    temperature: float | None = None
    escape: bool = False

    def response_format(self) -> str | None:
        if self.contract is None:
            return None
        return json.dumps(
            {
                "type": "json_schema",
                "json_schema": {
                    "name": self.contract_name,
                    "strict": True,
                    "schema": self.contract,
                },
            }
        )


def _closed_object(properties: dict, **extra) -> dict:
    return {
        "type": "object",
        "properties": properties,
        "required": list(properties),
        "additionalProperties": False,
        **extra,
    }


def described(schema: dict, defs: dict | None = None) -> str:
    """A JSON schema in plain words, for the instructions of a task."""
    defs = schema.get("$defs", defs or {})
    if "$ref" in schema:
        return described(defs[schema["$ref"].rsplit("/", 1)[1]], defs)
    if "enum" in schema:
        return "one of " + ", ".join(str(x) for x in schema["enum"])
    if schema["type"] == "array":
        return f"a list, each entry {described(schema['items'], defs)}"
    if schema["type"] == "object":
        keys = [f"{name} ({described(inner, defs)})" for name, inner in schema["properties"].items()]
        return f"an object with the keys {', '.join(keys)}"
    return {"string": "text", "integer": "a whole number", "boolean": "true or false"}[schema["type"]]


def _with_form(instructions: str, contract: dict) -> str:
    return f"{instructions}\nReply in JSON: {described(contract)}."


# The tasks differ between users; what a model is told beside the form of its answer is theirs to
# pass. These lines stand in for it.
LINK_LINE = "Which articles does this page link to?"
RELEVANCE_LINE = "Rate this article for each of the readers below; the highest score is for what they must not miss."
VALIDITY_LINE = "Is this the text of an article?"
SUMMARY_LINE = "Give the gist of this text in 3 to 8 sentences."


def link_task(model: str, instructions: str = LINK_LINE) -> Task:
    text = {"type": "string"}
    link = _closed_object(
        {"title": text, "url": text, "keywords": {"type": "array", "items": text}, "language": text}
    )
    contract = _closed_object(
        {"article_links_list": {"type": "array", "items": {"$ref": "#/$defs/article_link"}}},
        **{"$defs": {"article_link": link}},
    )
    return Task(LINKS, model, _with_form(instructions, contract), contract, LINKS_FORM, escape=True)


def relevance_task(
    model: str, personas: Sequence[tuple[str, str]], instructions: str = RELEVANCE_LINE
) -> Task:
    """`personas`: (name, what the person cares about)."""
    readers = "".join(f"\n* {name}, {focus}" for name, focus in personas)
    properties = {
        name: {"type": "integer", "description": f"Relevance for {name}", "enum": list(SCORES)}
        for name, _ in personas
    }
    properties[LANGUAGE_KEY] = {"type": "string", "enum": list(LANGUAGES)}
    contract = _closed_object(properties)
    return Task(RELEVANCE, model, _with_form(instructions + readers, contract), contract, RELEVANCE_FORM, escape=True)


def validity_task(model: str, instructions: str = VALIDITY_LINE) -> Task:
    contract = _closed_object({"validity": {"type": "boolean"}})
    return Task(VALIDITY, model, _with_form(instructions, contract), contract, VALIDITY_FORM, temperature=0.0)


def summary_task(model: str, instructions: str = SUMMARY_LINE) -> Task:
    return Task(SUMMARY, model, instructions)


def build_requests(
    items: DataFrame, task: Task, run: Column, item_id: Column, content: Column, *keep: str
) -> DataFrame:
    """One request per row: its parts as columns, to which `request_json` adds the JSON line.

    Escaped tasks get line feeds as two characters in both messages.
    """
    prompt = F.lit(task.system_prompt)
    return items.select(
        *keep,
        readable_key(run, F.lit(task.name), item_id).alias("custom_id"),
        F.lit(task.model).alias("model"),
        (escape_newlines(prompt) if task.escape else prompt).alias("system_content"),
        (escape_newlines(content) if task.escape else content).alias("user_content"),
    )


def request_json(task: Task) -> Column:
    """The request as one JSON line."""
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.col("system_content").alias("content")),
        F.struct(F.lit("user").alias("role"), F.col("user_content").alias("content")),
    )
    body = [F.col("model")]
    if task.temperature is not None:
        body.append(F.lit(task.temperature).alias("temperature"))
    body.append(messages.alias("messages"))
    if task.contract is not None:
        body.append(F.parse_json(F.lit(task.response_format())).alias("response_format"))
    return F.to_json(
        F.struct(
            "custom_id",
            F.lit("POST").alias("method"),
            F.lit("/chat/completions").alias("url"),
            F.struct(*body).alias("body"),
        )
    )


def python_predictor(
    factory: Callable[[], Callable[[list[dict]], Iterable[str | None]]],
    concurrency: int | None = None,
    call_size: int = 1000,
) -> Predictor:
    """A predictor from Python code, such as a client of a hosted model.

    `concurrency` spreads the requests over that many tasks: more than the input has splits
    where the model is slow and the table small, or fewer to spare the model.

    `factory` runs once per task on the executors and returns a function from a list of
    requests to as many answers. It gets `call_size` requests at a time. If it fails on a
    list, the halves are tried, down to the request that fails, which gives a row with the
    error. The parse functions store what they read; elsewhere store the answers before
    using them twice.
    """

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = factory()
        for pdf in batches:
            requests = pdf[REQUEST].to_dict("records")
            answers = []
            for i in range(0, len(requests), call_size):
                answers += _answers(answer, requests[i : i + call_size])
            out = pdf.drop(columns=["system_content", "user_content"])
            out["content"] = pd.Series([a for a, _ in answers], index=pdf.index, dtype=object)
            out["error"] = pd.Series([e for _, e in answers], index=pdf.index, dtype=object)
            yield out

    def run(requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        kept = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in requests.select(*keep).schema)
        rows = requests.select(*REQUEST, *keep)
        if concurrency:
            rows = rows.repartition(concurrency, "custom_id")
        return rows.mapInPandas(predict, RESPONSE + kept)

    return run


def _answers(answer: Callable[[list], Iterable], requests: list) -> list[tuple]:
    """(answer, None) or (None, error) for each request."""
    try:
        found = list(answer(requests))
        if len(found) != len(requests):
            raise ValueError(f"{len(found)} answers to {len(requests)} requests")
        return [(content, None) for content in found]
    except Exception as e:
        if len(requests) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        half = len(requests) // 2
        return _answers(answer, requests[:half]) + _answers(answer, requests[half:])


def expression_predictor(content: Callable[[Column], Column], model: str) -> Predictor:
    """A predictor from a column expression on the user message; it stays inside the JVM."""

    def run(requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return requests.select(
            "custom_id",
            F.lit(model).alias("model"),
            content(F.col("user_content")).alias("content"),
            F.lit(None).cast("string").alias("error"),
            *keep,
        )

    return run


def stored_predictor(lines: DataFrame) -> Predictor:
    """A predictor that looks answers up among stored response lines, as from `read_responses`.

    Of several answers to a request the last one by `ord` counts, without such a column the
    greatest; a request without any gives a row with the error.
    """
    answer = F.struct("content", F.col("model").alias("by"), "error")
    last = F.struct("ord", answer.alias("a")) if "ord" in lines.columns else F.struct(answer.alias("a"))
    found = (
        flatten_envelope(lines, *[c for c in lines.columns if c == "ord"])
        .groupBy(F.col("custom_id").alias("__id"))
        .agg(F.max(last)["a"].alias("a"))
    )

    def run(requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        joined = requests.join(found, F.col("custom_id") == F.col("__id"), "left")
        missing = F.when(F.col("__id").isNull(), "no stored answer")
        return joined.select(
            "custom_id",
            F.coalesce("a.by", "model").alias("model"),
            F.col("a.content").alias("content"),
            F.coalesce("a.error", missing).alias("error"),
            *keep,
        )

    return run


def embed_calls(
    texts: DataFrame,
    factory: Callable[[], Callable[[list[str]], Iterable[list[float]]]],
    model: str,
    text: str = "summary",
    keys: Sequence[str] = ("run_id",),
    id_col: str = "article_id",
) -> DataFrame:
    """One call per `chunk_no` of each group, with all its texts; ids stay with their text.

    `texts` is cut by `batching.token_chunks`, so a call's texts are few. `factory` runs
    once per task. Returns the keys, the id, summary_embedding, embedding_model and error.
    """
    call = [*keys, "chunk_no"]
    rows = (
        texts.select(*call, id_col, text)
        .repartition(*call)
        .sortWithinPartitions(*call, id_col)
    )

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embedder = factory()

        def done(pdf: pd.DataFrame) -> pd.DataFrame:
            answers = _answers(embedder, pdf[text].tolist())
            out = pdf[[*keys, id_col]].copy()
            out["summary_embedding"] = [a for a, _ in answers]
            out["embedding_model"] = model
            out["error"] = [e for _, e in answers]
            return out

        # A call's rows follow on one another, but a batch may end inside a call.
        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            number = (pdf[call] != pdf[call].shift()).any(axis=1).cumsum()
            for n, group in pdf.groupby(number, sort=True):
                if n < number.iloc[-1]:
                    yield done(group)
            rest = pdf[number == number.iloc[-1]]
        if rest is not None and len(rest):
            yield done(rest)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keys, id_col).schema)
    return rows.mapInPandas(
        embed, f"{kept}, summary_embedding array<float>, embedding_model string, error string"
    )


def flatten_envelope(lines: DataFrame, *keep: str) -> DataFrame:
    """Stored response lines (TASK_RESPONSE) as RESPONSE rows; lines may hold an `error`."""
    body = F.col("response.body")
    return lines.select(
        "custom_id",
        body["model"].alias("model"),
        F.get(body["choices"], F.lit(0))["message"]["content"].alias("content"),
        (F.col("error") if "error" in lines.columns else F.lit(None).cast("string")).alias("error"),
        *keep,
    )


def _parse(responses: DataFrame, parsed: Column, problem: Column) -> tuple[DataFrame, DataFrame]:
    """(rows with their `key` and `answer`, rejected rows).

    Parsed rows are stored once and read from both sides. So the model that `responses` may
    come from answers once, and no filter is moved below the parsing, which would repeat it
    for every field the filter looks at.
    """
    rows = (
        spread(responses).withColumn("key", split_key(F.col("custom_id")))
        .withColumn("answer", parsed)
        .withColumn(
            REASON,
            F.when(F.col("error").isNotNull(), F.concat(F.lit("model error: "), "error"))
            .when(F.col("key").isNull(), "bad custom_id")
            .otherwise(problem),
        )
    )
    parsed_rows = store(
        rows.select(
            "custom_id", "model", "key", "answer", REASON,
            F.when(F.col(REASON).isNotNull(), F.col("content")).alias("content"),
        ),
        "parsed",
    )
    rejected = parsed_rows.where(F.col(REASON).isNotNull()).select(
        "custom_id", "model", "content", REASON
    )
    return parsed_rows.where(F.col(REASON).isNull()), rejected


def _contract_problem(content: Column, contract: Mapping | None) -> Column:
    """Null without a contract."""
    fault = F.lit(None).cast("string") if contract is None else contract_fault(content, contract)
    return F.concat(F.lit("contract: "), fault)


def parse_links(responses: DataFrame, contract: Mapping | None = None) -> tuple[DataFrame, DataFrame]:
    """One row per extracted link (before ids and stamps), and the rejected answers.

    No answer at all counts as an empty list of links. With the `contract` of the task an
    answer that breaks it anywhere is rejected; without one, fields that are missing or of
    another type are empty and further keys are let through.
    """
    schema = (
        "article_links_list array<struct<title: string, url: string, "
        "keywords: array<string>, language: string>>"
    )
    given = F.nullif("content", F.lit(""))
    good, rejected = _parse(
        responses,
        F.from_json(F.coalesce(given, F.lit("{}")), f"{schema}, _corrupt_record string"),
        F.when(F.col("answer._corrupt_record").isNotNull(), "content is not JSON").when(
            given.isNotNull(), _contract_problem(given, contract)
        ),
    )
    links = good.select(
        "model", "key", F.posexplode("answer.article_links_list").alias("link_no", "link")
    ).select(
        "model",
        F.col("key.run_id").alias("run_id"),
        F.col("key.task_name").alias("task_name"),
        F.col("key.item_id").alias("source_name"),
        "link_no",
        F.coalesce("link.title", F.lit("")).alias("article_title"),
        F.coalesce("link.url", F.lit("")).alias("article_url"),
        F.coalesce("link.keywords", F.array().cast("array<string>")).alias("article_keywords"),
        F.coalesce("link.language", F.lit("")).alias("article_language"),
    )
    return links, rejected


def parse_relevance(responses: DataFrame, personas: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(outputs with the `relevance` map, answers that break the contract)."""
    answer = bind(
        F.from_json("content", "map<string,string>"),
        lambda found: F.struct(
            without_language(found).alias("scores"), answer_language(found).alias("language")
        ),
    )
    scores, language = F.col("answer.scores"), F.col("answer.language")
    good, rejected = _parse(
        responses,
        answer,
        F.when(scores.isNull(), "content is not JSON").otherwise(
            contract_error(scores, language, personas)
        ),
    )
    return (
        good.select(
            "model",
            "key.run_id",
            "key.task_name",
            F.col("key.item_id").alias("article_id"),
            scores.alias("relevance"),
            language.alias("article_language"),
        ),
        rejected,
    )


def parse_validity(responses: DataFrame, contract: Mapping | None = None) -> tuple[DataFrame, DataFrame]:
    """(verdicts, rejected answers); with the `contract` of the task also those that break it
    beside their verdict."""
    good, rejected = _parse(
        responses,
        F.from_json("content", "validity boolean"),
        F.when(F.col("answer.validity").isNull(), "no verdict").otherwise(
            _contract_problem(F.col("content"), contract)
        ),
    )
    return (
        good.select(
            "key.run_id", F.col("key.item_id").alias("article_id"), F.col("answer.validity").alias("validity")
        ),
        rejected,
    )


def parse_summaries(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    good, rejected = _parse(
        responses, F.col("content"), F.when(F.col("content").isNull(), "no content")
    )
    return (
        good.select(
            "model",
            F.col("answer").alias("summary"),
            F.col("key.item_id").alias("article_id"),
            "key.run_id",
            "key.task_name",
        ),
        rejected,
    )


def split_saved(batches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(outputs to save, errors to save) of completed batches; empty bodies are not saved
    and a batch may have both."""
    done = batches.where(F.col("status") == "completed")

    def body(column: str) -> DataFrame:
        # Spaces around the body go, as they would before it is saved.
        text = F.regexp_replace(column, r"^\s+|\s+$", "")
        return done.select("batch_id", text.alias("body")).where(F.col("body") != "")

    return body("output"), body("error")
