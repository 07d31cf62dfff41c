import random
from collections import Counter

import brute
import pytest
from newsloom.llm import packing
from llm_fixtures import documents, sample  # noqa: F401

EDGES = [(1, None), (2, ""), (3, " \n"), (4, "a b c"), (4, "a b c"), (None, "d e"), (5, "x " * 30_000), (6, "y" * 300_000), (7, "z " * 4096), (8, "é  ü\n\nö")]


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_agrees_with_brute_force(seed):
    draw = random.Random(seed)
    sizes = sorted((draw.choice([1, 3, draw.randrange(1, 65)]) for _ in range(150)), reverse=True)
    for lengths, overhead in [((8, 16, 32, 64), 4), ((64,), 1), ((64, 48, 20), 30)]:
        assert packing.best_fit(sizes, lengths, overhead) == brute.packed(sizes, lengths, overhead)
    assert packing.best_fit([]) == []


def test_shorter_bins_are_opened_where_the_rest_fills_them_better():
    """Plain best fit opens the longest bins and shortens them at the end; here bins differ."""
    sizes = [900, 900, *[90] * 14]
    lengths = (1000, 1500)
    found = packing.best_fit(sizes, lengths, 64)
    plain = packing.best_fit(sizes, (1500,), 64)
    assert sorted(map(sorted, (i for _, i in found))) != sorted(map(sorted, (i for _, i in plain)))
    assert found[0] == (1000, [0, 2]) and found[1] == (1000, [1, 3])
    # Halves of the longest wait for each other; a long bin is opened for them.
    assert packing.best_fit([900, 500, 500], lengths, 64) == [(1500, [0, 1]), (1000, [2])]
    draw = random.Random(7)
    drawn = sorted((min(4096, int(draw.lognormvariate(6.5, 0.8)) + 1) for _ in range(5000)), reverse=True)
    lengths_used = {length for length, _ in packing.best_fit(drawn)}
    assert len(lengths_used) > 1


def _check(table, bins, lengths):
    texts = Counter()
    for r in table.collect():
        texts[r.doc_id, " ".join(brute.words(r.text))] += 1
    pieces = {}
    ids = set()
    for b in bins:
        assert b.length in lengths and b.n_words == sum(b.words) <= b.length
        assert not any(b.n_words <= x < b.length for x in lengths)
        parts = [" ".join(brute.words(b.text))]
        assert len(parts[0].split()) == b.n_words
        ids.add(b.bin_id)
        at = 0
        body = brute.words(b.text)
        for doc, first, n in zip(b.doc_ids, b.first_words, b.words, strict=True):
            pieces.setdefault(doc, []).append((first, body[at : at + n]))
            at += n
    assert len(ids) == len(bins)
    words = Counter()
    for (doc, text), times in texts.items():
        for i, w in enumerate(text.split()):
            words[doc, i, w] += times
    found = Counter()
    for doc, parts in pieces.items():
        for first, body in parts:
            for i, w in enumerate(body):
                found[doc, first + i, w] += 1
    assert found == words


def test_every_word_is_packed_once(documents, sample):
    for table, lengths in ((documents(*EDGES).selectExpr("*", "1 AS length", "2 AS bin_id"), packing.LENGTHS), (sample, (64, 256, 300)), (sample, (4096,))):
        _check(table, packing.pack(table, lengths=lengths, task_bytes=50_000, block_words=5_000).collect(), lengths)


def test_one_task_packs_by_the_rule(documents):
    table = documents(*[(i, "w " * (1 + i * 37 % 100)) for i in range(80)])
    sizes = sorted((1 + i * 37 % 100 for i in range(80)), reverse=True)
    found = sorted((b.length, sorted(b.words)) for b in packing.pack(table, lengths=(50, 100, 200), overhead=10).collect())
    want = sorted((length, sorted(sizes[i] for i in items)) for length, items in brute.packed(sizes, (50, 100, 200), 10))
    assert found == want


def test_empty_table(documents):
    assert packing.pack(documents(*EDGES).limit(0)).count() == 0
    assert packing.pack(documents((1, None), (2, " "))).count() == 0


def test_pieces_keep_the_text():
    text = "  a b\tc\n\nd  e f g ".encode()
    assert packing.cut(text, 3) == [(0, 3, b"a b\tc"), (3, 3, b"d  e f"), (6, 1, b"g")]
    assert packing.cut(text, 7) == [(0, 7, text)]
