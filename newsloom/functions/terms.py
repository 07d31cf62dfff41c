"""Column expressions on the terms of texts: their words, hashed to a fixed number of buckets."""

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"
# Hexadecimal digits of a word's MD5, and the buckets they make.
DIGITS = 4
BUCKETS = 16**DIGITS


def term_words(text: Column) -> Column:
    """Lower-case words, in order, repeats included."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_buckets(words: Column) -> Column:
    """The bucket of each word: the first digits of its MD5. Any engine finds the same ones."""
    return F.transform(words, lambda word: F.conv(F.substring(F.md5(word), 1, DIGITS), 16, 10).cast("int"))


def term_buckets(text: Column) -> Column:
    """The buckets of a text's words, in order, repeats included."""
    return word_buckets(term_words(text))
