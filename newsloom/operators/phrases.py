"""Keywords of any number, kept as a table, found in texts by join.

A text is cut into its runs of words of the lengths that keywords have. Those that may be keywords,
by a table of bits, meet the keywords by equality. So the cost grows with the texts, not with the
number of keywords.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.session import spread, store

# Bits that keywords leave, and bits of each; a run passes if it has all of its own.
BLOOM_BITS, BLOOM_HASHES = 1 << 26, 3
# The base of a run's code, an odd number.
BASE = 0x5851F42D4C957F2D
# Bytes of texts that are cut into runs at a time.
TEXT_BYTES = 1 << 20


def clean_text(text: Column) -> Column:
    """The lower-case words of letters and digits with one space between; of a null text none."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def clean_words(text: Column) -> Column:
    """The words of `clean_text`."""
    return F.filter(F.split(clean_text(text), " "), lambda w: w != "")


def phrase_table(keywords: DataFrame) -> DataFrame:
    """(persona, phrase, n) of rows (persona, keyword): the keyword's words with one space
    between, and their number. Rows without a persona or without a word are left out, and
    spellings of the same words are one phrase."""
    words = keywords.select("persona", clean_words(F.col("keyword")).alias("w"))
    return (
        words.where(F.col("persona").isNotNull() & (F.size("w") > 0))
        .select("persona", F.array_join("w", " ").alias("phrase"), F.size("w").alias("n"))
        .distinct()
    )


class _Runs:
    """The runs of words in texts, found by numbers instead of strings.

    `text` is bytes of words with one space between, texts one after the other. A run's code is
    a polynomial of its bytes, from running sums. `seen` has the bits of the codes
    of keywords: a run without its bits is no keyword, one with them is looked up by its text.
    """

    def __init__(self, lengths: Sequence[int], seen: np.ndarray | None = None):
        self.lengths, self.seen = lengths, seen
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) <= n:
            size = 1 << n.bit_length()
            with np.errstate(over="ignore"):
                self.power = np.cumprod(np.r_[np.uint64(1), np.full(size, BASE, np.uint64)])
                self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(size, pow(BASE, -1, 1 << 64), np.uint64)])

    def bits(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """The bits, from 0, of the stretches [start, end) of a text."""
        self._powers(len(text))
        with np.errstate(over="ignore"):
            sums = np.r_[np.uint64(0), np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.power[: len(text)])]
            code = (sums[end] - sums[start]) * self.inverse[start]
            code = (code ^ (code >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(29)
            step = (code >> np.uint64(32)) | np.uint64(1)
            return [((code + np.uint64(i) * step) % np.uint64(BLOOM_BITS)).astype(np.int64) for i in range(BLOOM_HASHES)]

    def found(self, text: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, start, end) of the runs that may be keywords, of words (row, start, end)."""
        out = []
        for n in self.lengths:
            first, last = slice(0, max(0, len(row) - n + 1)), slice(n - 1, None)
            same = np.flatnonzero(row[first] == row[last])
            run = row[first][same], start[first][same], end[last][same]
            keep = np.ones(len(same), bool)
            for bit in self.bits(text, run[1], run[2]):
                keep &= (self.seen[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            out.append([x[keep] for x in run])
        return tuple(np.concatenate(x) for x in zip(*out))


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of strings, and where each begins and the last ends."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), offsets


def _bloom(table: DataFrame) -> np.ndarray:
    """The bits of all phrases: 8 MB at any number of them, more only lets more runs through."""
    # Spark counts the bits of its bitmaps, and their buckets, from 1.

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs([])
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                text, offsets = _buffers(batch.column(0).slice(at, 20_000))
                base, text = offsets[0], text[offsets[0] : offsets[-1]]
                for bit in runs.bits(text, offsets[:-1] - base, offsets[1:] - base):
                    yield pa.RecordBatch.from_arrays([pa.array(bit + 1)], ["bit"])

    bits = table.select("phrase").mapInArrow(places, "bit bigint")
    parts = bits.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    seen = np.zeros(BLOOM_BITS // 8, np.uint8)
    for r in parts.collect():
        own = np.frombuffer(bytes(r["bits"]), np.uint8)
        seen[(r["part"] - 1) * len(own) : r["part"] * len(own)] = own
    return seen


def _candidates(texts: DataFrame, lengths: Sequence[int], seen: np.ndarray) -> DataFrame:
    """(__key, phrase) of the runs in `__clean` that may be keywords, once for each row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(lengths, seen)
        for batch in batches:
            text, offsets = _buffers(batch.column(1))
            at = 0
            while at < batch.num_rows:
                # Some texts at a time, one at least.
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + TEXT_BYTES, side="right")) - 1)
                to = min(to, batch.num_rows)
                own, ends = text[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
                # A word begins where a text does, and after a space.
                space = np.flatnonzero(own == 32)
                filled = np.flatnonzero(np.diff(ends))
                start = np.sort(np.r_[ends[:-1][filled], space + 1])
                end = np.sort(np.r_[ends[1:][filled], space])
                row = np.searchsorted(ends, start, side="right") - 1
                row, start, end = runs.found(own, row, start, end)
                at, base = to, at
                if not len(row):
                    continue
                size = end - start
                to_ = np.cumsum(size)
                taken = own[np.arange(to_[-1]) + np.repeat(start - (to_ - size), size)]
                phrase = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(np.r_[0, to_].astype(np.int64)), pa.py_buffer(taken))
                pairs = pa.table({"row": pa.array(row + base), "phrase": phrase.cast(pa.string())})
                one = pairs.group_by(["row", "phrase"]).aggregate([]).combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(one["row"].combine_chunks()), one["phrase"].combine_chunks()], ["__key", "phrase"]
                )

    return texts.mapInArrow(scan, T.StructType([texts.schema["__key"], T.StructField("phrase", T.StringType())]))


def phrase_hits(texts: DataFrame, keywords: DataFrame, key: str, text: str) -> DataFrame:
    """(key, persona, n_keywords): how many of a persona's keywords each text holds, as whole
    words in a row; only where there is one at least.

    `keywords` has rows (persona, keyword), any number of them. Rows of `texts` that share a
    key count as one text; a null key is a key. Texts are not exchanged: what leaves a task is
    key and phrase of the runs that pass a table of bits (8 MB, by way of the driver), nearly all
    of them keywords. They meet the keywords by equality; if these are too many to be
    broadcast, the planner's splitting of skewed keys applies, since the join is a plain one.
    """
    table = phrase_table(keywords).withColumn("id", F.monotonically_increasing_id())
    table = store(table, "phrases")
    # Numbers of words of a keyword, not keywords.
    lengths = sorted(r["n"] for r in table.select("n").distinct().collect()) or [1]
    cleaned = spread(texts.select(F.col(key).alias("__key"), F.col(text).alias("__text"))).select(
        "__key", clean_text(F.col("__text")).alias("__clean")
    )
    found = _candidates(cleaned, lengths, _bloom(table))
    return (
        found.join(table.select("persona", "phrase", "id"), "phrase")
        .groupBy("__key", "persona")
        # Of a persona's phrases each has its own number.
        .agg(F.count_distinct("id").alias("n_keywords"))
        .select(F.col("__key").alias(key), "persona", "n_keywords")
    )


def phrase_scores(texts: DataFrame, keywords: DataFrame, key: str, text: str, personas: Sequence[str]) -> DataFrame:
    """(key, scores) of the texts that hold a keyword of one of `personas`: a map with 2 for two
    or more of a persona's keywords, and 1 for one; personas without any are not in it."""
    own = keywords.where(F.col("persona").isin(*personas))
    return (
        phrase_hits(texts, own, key, text)
        .groupBy(F.col(key))
        # As many entries as there are personas, at most.
        .agg(F.collect_list(F.struct("persona", F.least("n_keywords", F.lit(2)).cast("int"))).alias("__entries"))
        .select(key, F.map_from_entries("__entries").alias("scores"))
    )
