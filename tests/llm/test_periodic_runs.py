import hashlib
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, documents  # noqa: F401
from newsloom.llm import periodic_runs, queries


def ids(words):
    known = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


CASES = [
    "a" * 23, "a" * 24, "a" * 400, "ab" * 40 + "c" + "ba" * 30, "abcdefgh" * 3, "abcdefghi" * 3, "abcdefghi" * 2 + "abcdefgh",
    "abcabcabc" * 9 + "x" + "abcabcabc" * 9, ("a" * 20 + "b") * 5, ("aab" * 9 + "c") * 4, "aabaa" * 30 + "aab" * 30, "",
    "".join(chr(65 + i) for i in range(16)) * 3, "".join(chr(65 + i) for i in range(17)) * 3, "".join(chr(200 + i) for i in range(333)) * 4,
]


@pytest.mark.parametrize("words", CASES)
def test_runs_agree_with_brute_force(words):
    assert periodic_runs.runs_of(ids(words)) == brute.periodic_runs(list(words))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=12), st.integers(1, 9)), max_size=8))
def test_runs_of_random_repeats(parts):
    words = "".join(unit * times for unit, times in parts)
    assert periodic_runs.runs_of(ids(words)) == brute.periodic_runs(list(words))


def test_long_texts_with_frequent_words_and_phrases():
    phrase = [f"w{i}" for i in range(20)]
    words = [w for i in range(4000) for w in [*phrase, f"x{i}"]] + ["y"] * 50_000 + phrase * 1000
    found = periodic_runs.runs_of(ids(words))
    assert found == [(84_000, 50_000, 1), (134_000, 20_000, 20)]


EDGES = [
    (1, None), (2, ""), (3, " \t\n\x0b"), (4, "one two three"), (4, "one two three"), (None, "again " * 30), (5, "a b\n" * 12),
    (6, "x " + "é ü\x0c" * 40 + "z"), (7, "q\x1cr " * 24),
]


def test_rows_keep_their_columns(documents):
    table = documents(*EDGES).selectExpr("*", "7 AS runs", "8 AS Collapsed")
    found = periodic_runs.find_runs(table)
    assert found.columns == [*table.columns, "_runs", "_collapsed"]
    rows = found.collect()
    assert len(rows) == len(EDGES)
    for row in rows:
        words = brute.words(row.text)
        runs = brute.periodic_runs(words)
        assert [tuple(r) for r in row._runs] == runs
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert row._collapsed == " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert row.runs == 7


def test_empty_table(documents):
    assert periodic_runs.find_runs(documents(*EDGES).limit(0)).count() == 0


def expected(doc_id, text):
    words = brute.words(text)
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute.periodic_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-brute.Fraction(r[1], r[2]), r[0], r[2]), default=None)
    found = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *found, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_query(spark, documents, tmp_path):
    found = queries.op11_periodic_runs(spark, SF)
    texts = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r.text) < 20_000]
    rows = {r.doc_id: tuple(r) for r in found.collect()}
    assert [rows[r.doc_id] for r in texts] == [expected(r.doc_id, r.text) for r in texts]
    assert sum(r[1] > 0 for r in rows.values()) >= 10
    edges = [(i, " ".join(f"w{k % (i + 1)}" for k in range(i * 7))) for i in range(60)] + [(61, None), (62, "")]
    documents(*edges).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(expected(i, t) for i, t in edges)
