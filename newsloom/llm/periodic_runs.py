"""Runs of words that repeat with a period, found online by the lags at which words match."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsloom.llm.common import added_columns, texts_of, unused_names

# A run has at least so many words, and so many times its period.
MIN_WORDS = 24
MIN_PERIODS = 3
# Words of the shortest context. A run of period q <= 16 has at least q + 16 words.
SHORTEST = 16
# Texts whose results are held at a time.
_ROWS = 256


def contexts(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(k, names) for k = 16, 32, 64...: names[i] names words i to i+k-1, equal for equal words.

    Names of k words are numbered pairs of names of k/2, so that they are exact. It ends
    where no k words occur twice, or are too many for a run of their period.
    """
    k, names = 1, ids
    while len(names) and MIN_PERIODS * k // 2 <= len(ids) and (distinct := int(names.max()) + 1) < len(names):
        if k >= SHORTEST:
            yield k, names
        pairs = names[:-k] * distinct + names[k:]
        k, names = 2 * k, np.unique(pairs, return_inverse=True)[1]


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in the words `ids`, by start, then period.

    Words are taken from left to right. An earlier occurrence of a word at lag q lengthens
    the match of that lag by one word; when another lag takes its place, the match ends,
    and is a run if it is long enough. Which earlier occurrences can matter is narrowed
    without loss: in a run of period q, k words with q <= k have their latest earlier
    occurrence at lag q, as a primitive word is not inside its square but at its ends. The
    run has k + q words if k < 2q or if k is 16. So each word is taken with its context of
    k words, for the one k of the powers of two with k/2 < q <= k (16 for all q below), and
    only the latest occurrence counts: one active lag for each k, and a run is met once.
    """
    found = []
    for k, names in contexts(ids):
        least = k // 2 if k > SHORTEST else 0
        latest: dict[int, int] = {}
        active = matched = 0
        for i, name in enumerate(names.tolist()):
            lag = i - latest.get(name, i)
            latest[name] = i
            if not least < lag <= k:
                lag = 0
            if lag == active:
                matched += 1
                continue
            if active and active + matched >= max(MIN_WORDS, MIN_PERIODS * active):
                found.append((i + k - 1 - matched - active, active + matched, active))
            active, matched = lag, k
        if active and active + matched >= max(MIN_WORDS, MIN_PERIODS * active):
            found.append((len(ids) - matched - active, active + matched, active))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


def find_runs(documents: DataFrame, text: str = "text") -> DataFrame:
    """All rows with `runs` (start, length, period in words, by start, then period) and
    `collapsed`, the text with each run cut to its first period and one space between words.

    A run is a stretch of consecutive words with smallest period q, of at least 24 words and
    3q, that no neighbouring word extends. A null or empty text has no run and collapses to
    an empty one. Rows are read one by one: texts of any length whole, in memory in
    proportion to their words; repeated rows get the same runs; an empty table gives an
    empty one. The added columns take other names, with underscores in front, where the
    table has a column of that name.
    """
    at = documents.columns.index(text)
    names = unused_names(documents, "runs", "collapsed")
    run = "array<struct<start: bigint, length: bigint, period: bigint>>"
    schema = added_columns(documents, f"`{names[0]}` {run}, `{names[1]}` string")
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def read(body: bytes) -> tuple[list[dict], bytes]:
        words = body.split()
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        runs = runs_of(ids)
        return [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], collapse(words, runs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                runs, collapsed = zip(*map(read, texts_of(part.column(at))), strict=True)
                added = [pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, *names])

    return documents.mapInArrow(find, schema)
