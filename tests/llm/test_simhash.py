import random

import brute
import pytest
from newsloom.llm import simhash as s
from newsloom.llm.components import components
from llm_fixtures import documents, sample  # noqa: F401


def test_fingerprints(sample):
    texts = [r.text for r in sample.select("text").collect()] + ["", "one", "Two WORDS", "a b c", "Ünder Éa x y"]
    for text in texts:
        assert s.fingerprint(text.encode()) % (1 << 64) == brute.simhash(text)
    long = " ".join(str(i % 977) for i in range(70_000))
    assert s.fingerprint(long.encode()) % (1 << 64) == brute.simhash(long)


def _near_prints(n, seed):
    """Distinct 64-bit numbers, many of them a few bits apart."""
    draw = random.Random(seed)
    found = {0, (1 << 64) - 1}
    centres = [draw.getrandbits(64) for _ in range(12)] + [0, 1 << 63]
    while len(found) < n:
        x = draw.choice(centres)
        for _ in range(draw.randrange(7)):
            x ^= 1 << draw.randrange(64)
        found.add(x)
    return sorted(found)


@pytest.mark.parametrize("bits, block", [(3, 8192), (3, 6), (1, 8192), (2, 5), (5, 8192), (6, 4), (0, 8192)])
def test_links_agree_with_brute_force(spark, bits, block):
    prints = _near_prints(300, bits)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    table = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    found = {r.node: r.root for r in s.link_fingerprints(table, bits, block).collect()}
    want = brute.classes(signed, lambda a, b: (a ^ b).bit_count() <= bits if a ^ b >= 0 else ((a ^ b) % (1 << 64)).bit_count() <= bits)
    groups, expected = {}, {}
    for x in signed:
        groups.setdefault(found.get(x, x), set()).add(x)
        expected.setdefault(want[x], set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_components_of_every_document(sample):
    rows = sample.collect()
    prints = {r.doc_id: brute.simhash(r.text) for r in rows}
    want = brute.classes(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    found = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in s.near_duplicates(sample).collect()}
    assert found == {i: (prints[i], want[i]) for i in prints}


def test_edges(documents):
    table = documents((3, None), (2, ""), (2, ""), (None, "a b c d"), (9, "a b c d"), (None, "only null " * 9), (5, "x " * 100_000))
    found = sorted([(r.doc_id, r.component_id) for r in s.near_duplicates(table.selectExpr("*", "1 AS fp", "2 AS component_id")).collect()], key=repr)
    assert found == sorted([(3, 2), (2, 2), (2, 2), (None, 9), (9, 9), (None, None), (5, 5)], key=repr)
    assert s.near_duplicates(table.limit(0)).count() == 0


def test_one_row_of_each_component_stays(documents):
    table = documents((3, None), (2, ""), (2, ""), (None, "a b c d"), (9, "a b c d"), (None, "only null " * 9)).selectExpr(
        "*", "'mine' AS fp", "7 AS uid", "7 AS kept_uid"
    )
    kept = s.drop_near_duplicates(table)
    assert kept.schema == table.schema
    assert sorted([(r.doc_id, r.text, r.fp) for r in kept.collect()], key=repr) == sorted(
        [(2, "", "mine"), (9, "a b c d", "mine"), (None, "only null " * 9, "mine")], key=repr
    )
    assert s.drop_near_duplicates(table.limit(0)).count() == 0


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(300, 400)] + [(5, 5), (None, 1), (-3, -9)]
    table = spark.createDataFrame(edges, "u long, v long")
    found = {r.node: r.root for r in components(table).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{i: 300 for i in [*range(300, 400), 1000]}, -3: -9, -9: -9}
    assert components(table.limit(0)).count() == 0
