"""Quality rules as a cascade that stops at the first rule that rejects a text."""

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import added_columns, texts_of, unused_names

SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_SPACE = b" \t\n\v\f\r"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SMALL = bytes(range(ord("a"), ord("z") + 1))
# Signs of sums and shares, which are part of prose.
_FIGURE_SIGN = re.compile(rb"\$(?=[0-9])|(?<=[0-9])%")
# Letters of scripts that put no spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
_SPACELESS = re.compile(
    "[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"
)
# Words in a window that counts as repeated.
WINDOW = 5


def _code_points(text: bytes) -> int:
    return len(text) - _count(text, _CONTINUATION)


def _count(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


class Text:
    """What the rules ask of a text. Each answer is found when first asked for, and kept."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return _code_points(self.text) - _count(self.text, _SPACE)

    @cached_property
    def n_symbols(self) -> int:
        return _count(self.text, SYMBOLS)

    @cached_property
    def odd_signs(self) -> int:
        """Symbols other than the signs of figures and the bars of table rows."""
        bars = sum(x.count(b"|") for x in self.lines if x.lstrip().startswith(b"|")) if b"|" in self.text else 0
        return self.n_symbols - bars - len(_FIGURE_SIGN.findall(self.text))

    @cached_property
    def n_spaceless(self) -> int:
        """Letters of scripts without spaces, where these are more than half of the text, else 0."""
        if self.text.isascii():
            return 0
        n = len(_SPACELESS.findall(self.text.decode("utf-8", "replace")))
        return n if 2 * n > self.word_chars else 0

    @cached_property
    def lines(self) -> list[bytes]:
        """The lines that hold a word."""
        return [x for x in self.text.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def capitals(self) -> tuple[int, int]:
        """(capital letters, all letters) from A to Z."""
        upper = _count(self.text, _CAPITALS)
        return upper, upper + _count(self.text, _SMALL)

    @cached_property
    def word_ids(self) -> np.ndarray:
        ids: dict[bytes, int] = {}
        return np.fromiter((ids.setdefault(w, len(ids)) for w in self.words), np.int64, self.n_words)

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the word before."""
        return int((self.word_ids[1:] == self.word_ids[:-1]).sum())

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside a window of five that the text holds twice or more."""
        n = self.n_words - WINDOW + 1
        if n < 2:
            return 0
        ids = self.word_ids.astype(np.uint64)
        mixed = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n]
            mixed ^= mixed >> np.uint64(29)
        order = np.argsort(mixed)
        same = mixed[order][1:] == mixed[order][:-1]
        if not same.any():
            return 0
        # Windows with an equal mix are compared word by word.
        maybe = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
        windows = [tuple(row) for row in ids[maybe[:, None] + np.arange(WINDOW)].tolist()]
        times = Counter(windows)
        starts = maybe[np.fromiter((times[w] > 1 for w in windows), bool, len(windows))]
        edges = np.zeros(self.n_words + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WINDOW, -1)
        return int((np.cumsum(edges) > 0).sum())


@dataclass(frozen=True)
class Rule:
    """`rejects` says of a text whether the rule rejects it."""

    name: str
    rejects: Callable[[Text], bool]


BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < 10),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 20 * t.n_words),
)
# Beside the base: texts of symbols, of capitals, of words said twice, of lines said twice, and
# of no words in the usual sense. Signs count by the characters of the text, where signs of
# figures and bars of tables count for none; long words may be sentences of a script without spaces.
RULES = BASE_RULES + (
    Rule("symbols", lambda t: 10 * t.odd_signs > t.word_chars),
    Rule("capitals", lambda t: t.capitals[1] >= 20 and 10 * t.capitals[0] > 6 * t.capitals[1]),
    Rule("stutter", lambda t: 10 * t.n_stutters > 3 * t.n_words),
    Rule("repeated_lines", lambda t: len(t.lines) >= 4 and 2 * t.n_dup_lines > len(t.lines)),
    Rule("word_length", lambda t: t.word_chars < 2 * t.n_words or (t.word_chars > 25 * t.n_words and not t.n_spaceless)),
)
# What the pipeline drops by: the same, but that few words do if they are of a script with spaces.
# In the query few words always fail the base.
PIPELINE_RULES = (Rule("few_words", lambda t: t.n_words < 10 and t.n_spaceless < 20), *RULES[1:])
# Texts that the order of the rules is estimated on, about.
SAMPLE_ROWS = 2000


def order_rules(
    documents: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 1,
) -> list[Rule]:
    """The rules by rejections per second of work, most first.

    A random sample of about `sample_rows` rows over all of the table is read once; on each
    text, every rule starts anew and is timed. One row per rule comes to the driver. The
    order changes the time that the cascade takes, never its verdict. Without rows the
    order stays as it is.
    """
    total = documents.count()
    sample = documents.select(F.col(text).cast("string").alias("text"))
    if total > sample_rows:
        sample = sample.sample(fraction=sample_rows / total, seed=seed)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, hits = [0.0] * len(rules), [0] * len(rules)
        for batch in batches:
            for body in texts_of(batch.column(0)):
                for i, rule in enumerate(rules):
                    start = time.perf_counter()
                    hits[i] += bool(rule.rejects(Text(body)))
                    spent[i] += time.perf_counter() - start
        yield pa.RecordBatch.from_pydict({"rule": list(range(len(rules))), "s": spent, "n": hits})

    found = sample.mapInArrow(measure, "rule bigint, s double, n bigint").groupBy("rule")
    worth = {r["rule"]: r["n"] / max(r["s"], 1e-9) for r in found.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    return sorted(rules, key=lambda rule: -worth.get(rules.index(rule), 0.0))


def _passes(text: Text, rules: Sequence[Rule]) -> bool:
    return not any(rule.rejects(text) for rule in rules)


def keep_good(
    documents: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text"
) -> DataFrame:
    """The rows whose text no rule rejects, with all their columns.

    Rules run in the order of `order_rules` and stop at the first rejection. A null text is
    an empty one. Rows are judged one by one: repeated rows share their verdict, and other
    columns, whatever their names, pass through.
    """
    order = order_rules(documents, rules, text)
    at = documents.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = texts_of(batch.column(at))
            yield batch.filter(pa.array([_passes(Text(b), order) for b in bodies], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)


def judge(
    documents: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    signals: Sequence[str] = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
) -> DataFrame:
    """All rows with the `signals` of their text (long), `base_failed` and `kept`.

    The added columns take other names, with underscores in front, where the table has a
    column of that name. Else as `keep_good`; the signals are counted for every row.
    """
    order = order_rules(documents, rules, text)
    at = documents.columns.index(text)
    names = unused_names(documents, *signals, "base_failed", "kept")
    kinds = ["bigint"] * len(signals) + ["boolean", "boolean"]
    schema = added_columns(documents, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [Text(b) for b in texts_of(batch.column(at))]
            added = [pa.array([getattr(t, s) for t in bodies], pa.int64()) for s in signals]
            added.append(pa.array([not _passes(t, BASE_RULES) for t in bodies], pa.bool_()))
            added.append(pa.array([_passes(t, order) for t in bodies], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    return documents.mapInArrow(run, schema)
