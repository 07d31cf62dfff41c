"""Best-fit packing of documents into sequences of several permitted lengths."""

import re
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import texts_of

LENGTHS = (512, 1024, 2048, 4096)
# What a sequence costs beside its length, in words.
OVERHEAD = 64
# Bytes of text that a task packs, and words that are packed together. While there are fewer tasks
# than this for each core, a task packs less.
TASK_BYTES = 512 << 20
BLOCK_BYTES = 16 << 20
BLOCK_WORDS = 4 << 20
TASKS_PER_CORE = 16
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cut(text: bytes, longest: int) -> list[tuple[int, int, bytes]]:
    """(first word, words, text) of the pieces of a text, each of at most `longest` words."""
    n = len(text.split())
    if n <= longest:
        return [(0, n, text)] if n else []
    pieces, start, end = [], 0, 0
    for i, word in enumerate(_WORD.finditer(text)):
        if i % longest == 0:
            if i:
                pieces.append((i - longest, longest, text[start:end]))
            start = word.start()
        end = word.end()
    first = (n - 1) // longest * longest
    return [*pieces, (first, n - first, text[start:end])]


def best_fit(
    sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD
) -> list[tuple[int, list[int]]]:
    """(length, items) of each bin. `sizes` go from large to small, none above the largest length.

    An item goes to the open bin that it leaves least room in. If none has room, a bin is
    opened: of the lengths that hold the item, that with the least cost per word, where a
    bin costs its length and `overhead`, and is taken to be filled with what best fit would
    place in the room beside the item of the sizes still to come, the largest that fits
    first; of equals the shorter. So a long bin is opened only where the sizes that are left
    fill it. At the end each bin gets the shortest length that holds its contents.
    """
    lengths = sorted(lengths)
    smaller = [-s for s in sizes]
    room: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    used: list[int] = []

    def filled(left: int, after: int) -> int:
        """Words that go into a room of `left` words, of the sizes from the place `after` on."""
        start, at = left, after
        while left and (at := bisect_left(smaller, -left, at)) < len(sizes):
            size = sizes[at]
            # As many of the same size as there are and fit.
            same = bisect_left(smaller, 1 - size, at) - at
            left -= size * min(same, left // size)
            at += same
        return start - left

    for i, size in enumerate(sizes):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, chosen = room.pop(at)
        else:
            costs = [
                ((length + overhead) / (size + filled(length - size, i + 1)), length)
                for length in lengths if length >= size
            ]
            left = min(costs)[1]
            chosen = len(bins)
            bins.append([])
            used.append(0)
        bins[chosen].append(i)
        used[chosen] += size
        insort(room, (left - size, chosen))
    return [(lengths[bisect_left(lengths, n)], items) for n, items in zip(used, bins, strict=True)]


_BINS = (
    "bin_id bigint, length int, n_words int, doc_ids array<bigint>, "
    "first_words array<bigint>, words array<int>, text string"
)


def pack(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    lengths: Sequence[int] = LENGTHS,
    overhead: int = OVERHEAD,
    task_bytes: int = TASK_BYTES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per sequence: bin_id, length (one of `lengths`), n_words in it, and its pieces in
    order: doc_ids, first_words (place in their document), words, and the texts, joined by
    an empty line.

    A document longer than the longest sequence is cut into pieces of that length and a rest.
    Pieces are dealt out evenly, whatever their document or source, to tasks of `task_bytes` that
    each pack theirs, `block_words` at a time. A word is in exactly one sequence. Texts without words
    are in none; a null doc_id stays null; repeated rows are packed as often as they come.
    Other columns are not read.
    """
    longest = max(lengths)
    slim = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (i, *piece)
                for i, body in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True)
                for piece in cut(body, longest)
            ]
            ids, firsts, words, bodies = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(firsts, pa.int64()), pa.array(words, pa.int32()), pa.array(bodies, pa.binary()).cast(pa.string())],
                ["doc_id", "first_word", "n", "text"],
            )

    def bins(rows: list[tuple], start: int) -> pa.RecordBatch:
        rows.sort(key=lambda r: (-r[2], r[0] is None, r[0], r[1]))
        out = []
        for k, (length, items) in enumerate(best_fit([r[2] for r in rows], lengths, overhead)):
            own = [rows[i] for i in items]
            ids, firsts, words, bodies = map(list, zip(*own, strict=True))
            out.append((start + k, length, sum(words), ids, firsts, words, b"\n\n".join(bodies)))
        columns = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        arrays[-1] = arrays[-1].cast(pa.string())
        return pa.RecordBatch.from_arrays(
            arrays, ["bin_id", "length", "n_words", "doc_ids", "first_words", "words", "text"]
        )

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id, held, words = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(3)]
            for row in zip(*columns, texts_of(batch.column(3)), strict=True):
                held.append(row)
                words += row[2]
                if words >= block_words:
                    done = bins(held, next_id)
                    next_id += done.num_rows
                    held, words = [], 0
                    yield done
        if held:
            yield bins(held, next_id)

    dealt = slim.mapInArrow(pieces, "doc_id bigint, first_word bigint, n int, text string")
    cores = documents.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-total // task_bytes), min(cores * TASKS_PER_CORE, -(-total // BLOCK_BYTES)))
    return dealt.repartition(tasks).mapInArrow(fill, _BINS)
