"""A quality classifier on random-indexing word vectors."""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import added_columns, store, texts_of

# A word that makes up at least this part of all words has a context vector of its own. No
# corpus has more than HEAD of them, so that their table has a bound.
HEAD = 1 << 15
# Rarer words share these context vectors by hash.
SHARED = 1 << 14
ROWS = HEAD + SHARED
SHAPES = 1 << 14
DIMS = 64
# Entries of an index vector that are not zero: one is 1, one is -1.
NONZERO = 2
# Words on each side that make up the context of a word.
WINDOW = 2
# Labelled documents to learn from, at most; they are drawn by hash.
TRAIN_ROWS = 20_000
# One of so many of them goes to the calibration of the scores, not to the weights.
CALIBRATE_EVERY = 5
HIDDEN = 32
EPOCHS = 40
_HELD_WORDS = 1 << 18
_KNOWN_WORDS = 400_000
_OTHER = regex.compile(r"[^\p{L}\p{M}\p{N}]+")
_CAPITALS = regex.compile(r"[\p{Lu}\p{Lt}]+")
_LETTERS = regex.compile(r"(?:(?!A)[\p{L}\p{M}])+")
_DIGITS = regex.compile(r"\p{N}+")
_RUN = re.compile(r"(.)\1+", re.DOTALL)
# The same for words of ASCII signs only, byte by byte.
_ASCII_OTHER = bytes(c for c in range(128) if not chr(c).isalnum())
_ASCII_SIGNS = bytes(
    ord("A") if chr(c).isupper() else ord("9") if chr(c).isdigit() else ord("a") if chr(c).isalpha() else c for c in range(128)
) + bytes(range(128, 256))


def cleaned(word: bytes) -> bytes:
    """The letters, marks and digits of a word, in small letters."""
    if word.isascii():
        return word.translate(None, _ASCII_OTHER).lower()
    return _OTHER.sub("", word.decode("utf-8", "replace")).lower().encode()


def signs(word: bytes) -> bytes:
    """Capitals as A, other letters as a, digits as 9; other signs stay. Runs may be one sign."""
    if word.isascii():
        return word.translate(_ASCII_SIGNS)
    return _DIGITS.sub("9", _LETTERS.sub("a", _CAPITALS.sub("A", word.decode("utf-8", "replace")))).encode()


def shape(signs: bytes) -> int:
    """The number of a word's signs, where a run of one sign counts as one."""
    return zlib.crc32(_RUN.sub(r"\1", signs.decode()).encode()) % SHAPES


def word_hash(word: bytes) -> int:
    """63 bits of a cleaned word."""
    return xxhash.xxh64_intdigest(word) >> 1


class Words(dict):
    """Numbers of words, kept for those that come again: hashes of the cleaned words; or, if
    the frequent ones are given, row of the vector times SHAPES plus that of the shape."""

    def __init__(self, head: np.ndarray | None = None):
        self.rows = None if head is None else {h: i for i, h in enumerate(head.tolist())}
        self.shapes = {}

    def __missing__(self, word: bytes) -> int:
        found = word_hash(cleaned(word))
        if self.rows is not None:
            row = self.rows.get(found)
            if row is None:
                row = HEAD + found % SHARED
            form = signs(word)
            number = self.shapes.get(form)
            if number is None:
                number = shape(form)
                if len(self.shapes) < _KNOWN_WORDS:
                    self.shapes[form] = number
            found = row * SHAPES + number
        if len(self) < _KNOWN_WORDS:
            self[word] = found
        return found

    def numbers(self, text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def index_vectors(seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of the index vector of each row that are not zero."""
    rng = np.random.default_rng(seed)
    first = rng.integers(0, DIMS, ROWS)
    places = np.stack([first, (first + rng.integers(1, DIMS, ROWS)) % DIMS], axis=1)
    signs = np.tile([1.0, -1.0], (ROWS, 1))
    return places, signs


def _pieces(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of words, and of the document that each is in, of many texts at a time."""
    held, n = [], 0
    for batch in batches:
        for body in texts_of(batch.column(0)):
            held.append(words.numbers(body))
            n += len(held[-1])
            if n >= _HELD_WORDS:
                yield np.concatenate(held), np.repeat(np.arange(len(held)), [len(x) for x in held])
                held, n = [], 0
    if held:
        yield np.concatenate(held), np.repeat(np.arange(len(held)), [len(x) for x in held])


def frequent_words(documents: DataFrame, text: str = "text") -> np.ndarray:
    """Hashes, in order, of the words that have a vector of their own, by counts over the whole
    corpus: at most HEAD of them."""

    def counted(held: Counter, words: Words) -> Iterator[pa.RecordBatch]:
        numbers = np.fromiter(map(words.__getitem__, held), np.int64, len(held))
        found, at = np.unique(numbers, return_inverse=True)
        n = np.bincount(at, np.fromiter(held.values(), np.float64, len(held)), minlength=len(found)).astype(np.int64)
        for i in range(0, len(found), 1 << 16):
            some = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(found[some]), pa.array(n[some])], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = Counter(), Words()
        for batch in batches:
            for body in texts_of(batch.column(0)):
                held.update(body.split())
                if len(held) >= _KNOWN_WORDS:
                    yield from counted(held, words)
                    held.clear()
        yield from counted(held, words)

    parts = documents.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "word bigint, n bigint")
    counts = store(parts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    head = counts.where(F.col("n") * HEAD >= total).select("word").toArrow()
    return np.sort(head.column(0).to_numpy())


def context_vectors(documents: DataFrame, head: np.ndarray, text: str = "text") -> np.ndarray:
    """(ROWS, DIMS): for each row the sum of the index vectors of the words around its words in
    all of the corpus, to unit length.

    Each task adds up its own table, of a fixed size, and hands on the rows it has touched;
    these are summed per row, in whole numbers. What comes to the driver is the table alone.
    """
    places, signs = index_vectors()
    shared = documents.sparkSession.sparkContext.broadcast(head)  # HEAD numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(ROWS * DIMS)
        for numbers, document in _pieces(batches, Words(shared.value)):
            at, by = [], []
            ids = numbers // SHAPES
            for step in range(1, WINDOW + 1):
                same = document[step:] == document[:-step]
                a, b = ids[:-step][same], ids[step:][same]
                for target, near in ((a, b), (b, a)):
                    for k in range(NONZERO):
                        at.append(target * DIMS + places[near, k])
                        by.append(signs[near, k])
            sums += np.bincount(np.concatenate(at), np.concatenate(by), minlength=ROWS * DIMS)
        rows = sums.reshape(ROWS, DIMS)
        used = np.flatnonzero(rows.any(axis=1))
        for i in range(0, len(used), 4096):
            some = used[i : i + 4096]
            own = rows[some].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), *(pa.array(own[:, d]) for d in range(DIMS))], ["row", *(f"d{d}" for d in range(DIMS))]
            )

    columns = [f"d{d}" for d in range(DIMS)]
    parts = documents.select(F.col(text).cast("string").alias("text")).mapInArrow(
        run, "row bigint, " + ", ".join(f"{c} bigint" for c in columns)
    )
    found = parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    table = np.zeros((ROWS, DIMS))
    if found.num_rows:
        table[found.column("row").to_numpy()] = np.stack([found.column(c).to_numpy() for c in columns], axis=1)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


# Mean and spread of the word vectors, mean of the shapes' index vectors, and three figures: how
# alike neighbouring words are by their context vectors, how many are in the same row, and length.
FEATURES = 3 * DIMS + 3


def pool(numbers: np.ndarray, table: np.ndarray, places: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The vector of a document; zeros if it has no words."""
    out = np.zeros(FEATURES, np.float32)
    n = len(numbers)
    if n == 0:
        return out
    ids, shapes = numbers // SHAPES, numbers % SHAPES
    total = np.zeros(DIMS)
    square = np.zeros(DIMS)
    alike = 0.0
    for i in range(0, n, 1 << 15):
        rows = table[ids[i : i + (1 << 15) + 1]]
        own = rows[: 1 << 15]
        total += own.sum(axis=0)
        square += np.einsum("ij,ij->j", own, own)
        alike += float(np.einsum("ij,ij->", rows[1:], rows[:-1]))
    mean = total / n
    out[:DIMS] = mean
    out[DIMS : 2 * DIMS] = np.sqrt(np.maximum(square / n - mean * mean, 0))
    for k in range(NONZERO):
        out[2 * DIMS : 3 * DIMS] += np.bincount(places[shapes, k], signs[shapes, k], minlength=DIMS) / n
    out[3 * DIMS] = alike / max(n - 1, 1)
    out[3 * DIMS + 1] = (ids[1:] == ids[:-1]).sum() / max(n - 1, 1)
    out[3 * DIMS + 2] = np.log1p(n)
    return out


class Pooling:
    """From texts to vectors, in tasks. The table of ROWS vectors goes to every task."""

    def __init__(self, documents: DataFrame, text: str = "text"):
        head = frequent_words(documents, text)
        table = context_vectors(documents, head, text)
        self.shared = documents.sparkSession.sparkContext.broadcast((head, table))

    def vectors(self, batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Each batch with the vectors of the texts in its column `at`."""
        head, table = self.shared.value
        words = Words(head)
        places, signs = index_vectors()
        for batch in batches:
            found = [pool(words.numbers(b), table, places, signs) for b in texts_of(batch.column(at))]
            yield batch, np.array(found, np.float32).reshape(-1, FEATURES)

    def pooled(self, documents: DataFrame, name: str, text: str = "text") -> DataFrame:
        """All rows, with the document's vector (float32 in bytes) in the column `name` for `text`."""
        at = documents.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, found in self.vectors(batches, at):
                columns = [c for i, c in enumerate(batch.columns) if i != at]
                names = [c for i, c in enumerate(batch.schema.names) if i != at]
                column = pa.array([v.tobytes() for v in found], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, column], [*names, name])

        return documents.mapInArrow(run, added_columns(documents.drop(text), f"`{name}` binary"))


class Network:
    """Two layers, and a temperature that turns outputs into probabilities."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        held = np.arange(len(y)) % CALIBRATE_EVERY == 0
        if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
            held = np.zeros(len(y), bool)
        self.rate = float(y.mean()) if len(y) else 0.5
        self.fitted = len(set(y)) == 2
        if not self.fitted:
            return
        self.middle, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = self._scaled(x)
        n = x.shape[1]
        self.weights = [rng.standard_normal((n, HIDDEN)) / np.sqrt(n), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
        self._train(x[~held], y[~held].astype(float), rng)
        out, truth = (self._out(x[held]), y[held]) if held.any() else (self._out(x), y)
        grid = np.exp(np.linspace(np.log(0.2), np.log(20), 200))
        losses = [np.mean(np.logaddexp(0, out / t) - truth * out / t) for t in grid]
        self.temperature = float(grid[int(np.argmin(losses))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        """In units of the spread, where far out no farther than 5: odd texts may be odd in a
        few features only."""
        return np.clip((x - self.middle) / self.scale, -5, 5)

    def _out(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2[0]

    def _train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        """Adam on the cross entropy, with some decay of the weights."""
        means = [np.zeros_like(w) for w in self.weights]
        squares = [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for i in range(0, len(y), 128):
                own = order[i : i + 128]
                w1, b1, w2, b2 = self.weights
                inner = x[own] @ w1 + b1
                on = np.maximum(inner, 0)
                error = (1 / (1 + np.exp(-np.clip(on @ w2 + b2[0], -30, 30))) - y[own]) / len(own)
                back = np.outer(error, w2) * (inner > 0)
                slopes = [x[own].T @ back + 1e-4 * w1, back.sum(axis=0), on.T @ error + 1e-4 * w2, np.array([error.sum()])]
                step += 1
                for w, m, s, g in zip(self.weights, means, squares, slopes, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    w -= 2e-3 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.rate)
        out = self._out(self._scaled(x)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def score_quality(
    documents: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    label: str = "quality",
    folds: int = 5,
    threshold: float = 0.3,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `documents`.

    Words get vectors from their contexts in the whole corpus, documents the pooled vectors of
    all their words. A network of two layers learns from at most `train_rows` labelled rows,
    drawn by hash from those whose document is there, none of which is held out: crc32 of the
    doc_id as text is 0 modulo `folds`. Nothing but the text goes into a score. A null text is
    an empty one and scored like any other; a null doc_id is not held out and has no label.
    Labels that are neither 0 nor 1 are left out, repeated ones and repeated documents count
    as often as they come. With labels of one kind only, all scores are the share of label 1,
    without any 0.5.
    """
    slim = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pooling = Pooling(slim)
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    marked = labels.select(F.col(doc_id).cast("bigint").alias("labelled"), F.col(label).cast("int").alias("y"))
    learned = F.crc32(F.col("labelled").cast("string")) % folds != 0
    present = slim.select(F.col("doc_id").alias("labelled"))
    drawn = (
        marked.where(learned & F.col("y").isin(0, 1)).join(present, "labelled", "left_semi")
        .orderBy(F.xxhash64("labelled"), "labelled", "y").limit(train_rows)
    )
    # At most `train_rows` pairs of numbers go to every task.
    train = slim.join(F.broadcast(store(drawn, "drawn")), F.col("doc_id") == F.col("labelled")).drop("labelled")
    order = [F.xxhash64("doc_id"), "doc_id", "y", "vector"]
    rows = pooling.pooled(train, "vector").orderBy(*order).limit(train_rows).select("vector", "y").toArrow()
    x = np.frombuffer(b"".join(rows.column(0).to_pylist()), np.float32).reshape(-1, FEATURES)
    network = Network(x.astype(np.float64), rows.column(1).to_numpy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in pooling.vectors(batches, 2):
            scores = network.scores(found.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    ready = slim.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "text")
    return ready.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")
