"""Column expressions on strings, keys and dates."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.schemas import CRAWLED, SEARCHED

KEY_SEPARATOR = "--"

# Words, and single marks between them; the same in Java and RE2.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"

# A stretch of text up to and with its closing marks; a tail without one counts too.
SENTENCE = r"[^.!?\s][^.!?]*[.!?]*"


def normalize_source(name: Column) -> Column:
    """Lower case, spaces as underscores."""
    return F.lower(F.replace(name, F.lit(" "), F.lit("_")))


def escape_newlines(text: Column) -> Column:
    """Line feeds as the two characters backslash and n."""
    return F.replace(text, F.lit("\n"), F.lit("\\n"))


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def dedent(text: Column) -> Column:
    """Without the indentation that all non-blank lines share."""
    lines = F.split(text, "\n")
    indents = F.transform(
        F.filter(lines, lambda line: F.trim(line) != ""),
        lambda line: F.length(F.regexp_extract(line, r"^[ \t]*", 0)),
    )
    margin = F.coalesce(F.array_min(indents), F.lit(0))
    return F.array_join(
        F.transform(
            lines,
            lambda line: F.when(F.trim(line) == "", F.lit("")).otherwise(
                line.substr(margin + 1, F.length(line))
            ),
        ),
        "\n",
    )


def article_info(source: Column, keywords: Column, body: Column) -> Column:
    """The descriptive text of an article: its keywords if crawled, its body if searched."""
    return F.when(
        source == CRAWLED, F.concat(F.lit("keywords: "), F.array_join(keywords, ", "), F.lit("\n"))
    ).when(source == SEARCHED, body)


def composite_key(run: Column, task: Column, item: Column) -> Column:
    """run--task--item; null if a part is null."""
    sep = F.lit(KEY_SEPARATOR)
    return F.concat(run, sep, task, sep, item)


def readable_key(run: Column, task: Column, item: Column) -> Column:
    """`composite_key` that fails where `split_key` would not give the parts back, as with a
    part that holds the separator."""
    key = composite_key(run, task, item)
    same = split_key(key).eqNullSafe(F.struct(run.alias("run_id"), task.alias("task_name"), item.alias("item_id")))
    unreadable = F.raise_error(F.concat(F.lit("no part of a key may hold --: "), key)).cast("string")
    return F.when(key.isNull() | same, key).otherwise(unreadable)


def split_key(key: Column) -> Column:
    """struct(run_id, task_name, item_id), or null unless the key has exactly three parts."""
    parts = F.split(key, KEY_SEPARATOR)
    return F.when(
        F.size(parts) == 3,
        F.struct(
            F.get(parts, F.lit(0)).alias("run_id"),
            F.get(parts, F.lit(1)).alias("task_name"),
            F.get(parts, F.lit(2)).alias("item_id"),
        ),
    )


def surrogate_id(source: Column, *identity: Column) -> Column:
    """An id that a retried task computes again: source and a digest of what identifies the row."""
    return F.concat_ws("_", source, F.sha2(F.concat_ws("\u0001", *identity), 256))


def number_suffix(name: Column) -> Column:
    """The integer after the last underscore, so that run 9 sorts before run 10."""
    return F.regexp_extract(name, r"_(\d+)(?:\.[^_]*)?$", 1).try_cast("bigint")


def format_day(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM-dd")


def token_count(text: Column) -> Column:
    """Words and marks; stands in for a model's own tokenizer, which callers can pass instead."""
    return F.regexp_count(text, F.lit(TOKEN)).cast("bigint")


def sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


def row_json(*columns) -> Column:
    """The row as JSON, with its null fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with `value` computed once however often it is used."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))
