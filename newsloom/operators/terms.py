"""How many texts of a corpus hold each term, and what is computed with it: summaries of scored
sentences, and text vectors.

Terms are buckets of words, so that counts have 65,536 rows at most, whatever the corpus, and
can go to every task. Counts of parts of a corpus add up.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.terms import BUCKETS, term_buckets, term_words, word_buckets
from newsloom.functions.text import bind, sentences
from newsloom.session import spread

# The line of the counts that holds the number of texts.
ALL_TEXTS = -1
COUNTS = "bucket int, n_texts bigint"
# Sentences of a summary: one of five, but at least and at most so many.
LEAST, MOST, ONE_OF = 3, 8, 5
# Words added to a sentence's length before its score is divided by it.
SHORT = 10


def document_counts(texts: DataFrame, text: str) -> DataFrame:
    """(bucket, n_texts): how many texts hold a word of the bucket; bucket -1 counts all texts.

    Null texts count as texts without words. A text's words are hashed once each. Tasks add up
    before anything is exchanged.
    """
    buckets = word_buckets(F.array_distinct(term_words(F.col(text))))
    held = F.array_union(
        F.array_distinct(F.coalesce(buckets, F.array().cast("array<int>"))), F.array(F.lit(ALL_TEXTS))
    )
    return spread(texts.select(text)).select(F.explode(held).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n_texts"))


def add_counts(*counts: DataFrame) -> DataFrame:
    """The counts of several corpora taken as one."""
    both = counts[0]
    for more in counts[1:]:
        both = both.unionByName(more)
    return both.groupBy("bucket").agg(F.sum("n_texts").alias("n_texts"))


def counts_array(counts: DataFrame) -> tuple[int, np.ndarray]:
    """(number of texts, texts by bucket); at most 65,537 rows come to the driver."""
    held = np.zeros(BUCKETS, np.int64)
    total = 0
    for bucket, n in counts.select("bucket", "n_texts").collect():
        if bucket == ALL_TEXTS:
            total = n
        else:
            held[bucket] = n
    return total, held


def rarity(counts: DataFrame) -> np.ndarray:
    """By bucket how rare its words are, in whole numbers: the power of two that fits into the
    number of texts for each text that holds one; 0 for words of more than half of the texts."""
    total, held = counts_array(counts)
    share = total // np.maximum(held, 1)
    return np.frexp(np.maximum(share, 1).astype(float))[1] - 1


def log_rarity(counts: DataFrame) -> np.ndarray:
    """By bucket the logarithm of (texts + 1) / (texts with one of its words + 1)."""
    total, held = counts_array(counts)
    return np.log((total + 1) / (held + 1))


def _once(function: Callable, kind: str) -> Callable:
    """An Arrow function that the planner does not repeat: what is said to be deterministic is
    evaluated again in each filter on it that is moved below."""
    return F.arrow_udf(function, kind).asNondeterministic()


def best_sentences(buckets: np.ndarray, ends: np.ndarray, weight: np.ndarray) -> list[int]:
    """The numbers of the sentences of a summary, in text order.

    `buckets` are the words of all sentences, sentence i those up to ends[i]. A term weighs its
    rarity times the number of sentences that hold it. A sentence scores the weights of its
    terms that no sentence taken before holds, per thousand words and ten; the best one is
    taken, of equals the first, until there are enough.
    """
    m = len(ends)
    wanted = min(m, max(LEAST, min(MOST, -(-m // ONE_OF))))
    if wanted == m:
        return list(range(m))
    words = np.diff(ends, prepend=0)
    pairs = np.unique(np.repeat(np.arange(m), words) * BUCKETS + buckets)
    sentence = pairs // BUCKETS
    terms, term = np.unique(pairs % BUCKETS, return_inverse=True)
    worth = np.bincount(term, minlength=len(terms)) * weight[terms]
    taken: list[int] = []
    for _ in range(wanted):
        score = np.bincount(sentence, weights=worth[term], minlength=m) * 1000 // (words + SHORT)
        score[taken] = -1
        best = int(score.argmax())
        taken.append(best)
        worth[term[sentence == best]] = 0
    return sorted(taken)


def scored_summary(text: Column, counts: DataFrame) -> Column:
    """The sentences that say most of what is rare in the corpus and frequent in the text, in text
    order: one of five, three at least, eight at most; all of them if there are fewer.

    Whole texts are scored. Words are split and hashed in the JVM; only their buckets go to
    Python, and numbers of sentences come back. A null text gives null, one without
    sentences an empty summary.
    """
    weight = rarity(counts)

    def choose(terms: pa.Array) -> pa.Array:
        chosen = []
        for own in terms:
            own = own.values if own.is_valid else None
            if own is None:
                chosen.append(None)
                continue
            flat = own.flatten().to_numpy()
            lengths = own.value_lengths().to_numpy()
            chosen.append(best_sentences(flat, np.cumsum(lengths), weight))
        return pa.array(chosen, pa.list_(pa.int32()))

    said = sentences(text)
    numbers = _once(choose, "array<int>")(F.transform(said, term_buckets))
    return bind(
        F.struct(said.alias("said"), numbers.alias("numbers")),
        lambda x: F.array_join(F.transform(x["numbers"], lambda i: F.trim(F.get(x["said"], i))), " "),
    )


def text_embedder(
    corpus: DataFrame | None = None, text: str | None = None, dimensions: int = 256,
    counts: DataFrame | None = None,
) -> Callable[[DataFrame, str, str], DataFrame]:
    """A function (df, text column, output column) that embeds texts as hashed word counts
    at unit length; queries and articles alike. A text without words has a vector of zeros.

    With a corpus, or the counts of one, words are weighted by their rarity there. Vectors of
    different counts do not compare: embed what is searched together with the same ones.
    """
    if corpus is not None:
        counts = document_counts(corpus, text)
    weight = np.ones(BUCKETS) if counts is None else log_rarity(counts)

    def vectors(buckets: pa.Array) -> pa.Array:
        lengths = np.nan_to_num(buckets.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        row = np.repeat(np.arange(len(lengths)), lengths)
        # Words are added up by bucket, so that their order does not matter.
        pairs, times = np.unique(row * BUCKETS + buckets.flatten().to_numpy(), return_counts=True)
        bucket = pairs % BUCKETS
        at = pairs // BUCKETS * dimensions + bucket % dimensions
        out = np.bincount(at, weights=times * weight[bucket], minlength=len(lengths) * dimensions)
        # Counts of nothing come as whole numbers.
        out = out.reshape(-1, dimensions).astype(float)
        norm = np.sqrt(np.einsum("ij,ij->i", out, out))
        out /= np.where(norm > 0, norm, 1.0)[:, None]
        ends = np.arange(0, out.size + 1, dimensions, dtype=np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel().astype(np.float32)))

    def embed(df: DataFrame, column: str, output: str) -> DataFrame:
        return df.withColumn(output, _once(vectors, "array<float>")(term_buckets(F.col(column))))

    return embed
