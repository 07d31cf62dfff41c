import hashlib
import random

import brute
from newsloom.llm import pii
from newsloom.llm.queries import op9_personal_data
from llm_fixtures import documents, sample  # noqa: F401

EDGES = [
    "", "a@b", "a@b.c", "a..b@@c.d.e a@b.c@d.e", "..%+-@x-.y", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "0001.02.3.255",
    "4316522678525456", "4316-5226 7852 5456", "4316 5226  7852 5456", "+1 (234) 567-8901", "+12", "+1 ( ) . 2 345678901234567",
    "٣١٢@x.y +٣٣٣٣٣٣٣٣٣٣٣", "é@b.com", "a" * 50_000 + "@b.co", "9" * 50_000, "1." * 20_000, "+1 " * 20_000, "@" * 50_000, "퟿@x.yz",
]


def test_spans_agree_with_plain_patterns(sample):
    draw = random.Random(4)
    texts = EDGES + [r.text for r in sample.select("text").collect()]
    texts += ["".join(draw.choice("a1.@+- ()%é_9250\n") for _ in range(draw.randrange(60))) for _ in range(20_000)]
    for text in texts:
        if len(text) < 20_000:
            assert pii.base_spans(text) == brute.personal(text)
        else:
            pii.base_spans(text)


def _corpus():
    """Texts in which `zorblat` always stands near one address, `common` near all and alone."""
    rows = []
    for i in range(6):
        rows.append((i, f"word{i} common zorblat writes from jane.doe@mail.example.org today note{i}"))
    for i in range(6, 12):
        rows.append((i, f"text{i} common 10.0.0.{i} common +49 30 123456{i:02} end{i}"))
    for i in range(12, 60):
        rows.append((i, f"plain{i} common today writes from nobody{i}"))
    return [*rows, (60, None), (61, ""), (2, rows[2][1]), (None, "zorblat alone jane.doe@mail.example.org")]


def test_terms_agree_with_brute_force(documents, sample):
    for table in (documents(*_corpus()).selectExpr("*", "1 AS digest", "2 AS terms", "3 AS term"), sample):
        rows = table.select("doc_id", "text").collect()
        want = []
        terms = brute.disclosing([r.text for r in rows])
        for r, t in zip(rows, terms, strict=True):
            want.append((r.doc_id, sorted(brute.personal(r.text) + [(s, 4, e) for s, e, _ in t])))
        found = [(r.doc_id, [tuple(s) for s in r.spans]) for r in pii.find_personal_data(table).collect()]
        assert sorted(found, key=repr) == sorted(want, key=repr)
        clean = sorted([(r.doc_id, r.text) for r in pii.sanitise(table).collect()], key=repr)
        assert clean == sorted(
            [(r.doc_id, r.text and brute.cleaned(r.text, t)) for r, t in zip(rows, terms, strict=True)], key=repr
        )
    assert any(t for t in brute.disclosing([x[1] for x in _corpus()]))


def test_sanitise_takes_out_what_discloses(documents):
    texts = {r.doc_id: r.text for r in pii.sanitise(documents(*_corpus())).collect()}
    assert texts[3] == "word3 common  writes from [EMAIL] today note3"
    assert texts[20] == "plain20 common today writes from nobody20"
    assert texts[60] is None and texts[61] == ""
    table = documents(*_corpus()).selectExpr("*", "'x' AS digest", "'y' AS terms", "'z' AS found_digest", "'w' AS __digest")
    assert pii.sanitise(table).schema == table.schema
    assert {(r.digest, r.terms) for r in pii.sanitise(table).collect()} == {("x", "y")}


def test_terms_go_wherever_they_stand(documents):
    """Beyond the window, in texts without the entity, in copies and in capitals; not in base spans."""
    far = "zorblat writes from jane.doe@mail.example.org " + " ".join(f"far{k}" for k in range(20)) + " Zorblat again"
    rows = [*_corpus(), (70, far), (70, far), (71, "a ZORBLAT alone, zorblatt and zorblat@x.org")]
    table = documents(*rows).selectExpr("*", "1 AS digest", "2 AS terms", "3 AS term")
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find_personal_data(table).collect()}
    at = far.index("Zorblat")
    assert spans[70] == [(0, 4, 7), (20, 0, 45), (at, 4, at + 7)]
    assert spans[71] == [(2, 4, 9), (30, 0, 43)]
    clean = [(r.doc_id, r.text) for r in pii.sanitise(table).collect() if r.doc_id in (70, 71)]
    assert len(clean) == 3
    assert not any("zorblat " in text.lower() for _, text in clean)


def test_terms_of_many_other_texts_stay_however_rare_the_entity(documents):
    """At any size of the corpus a term must be near the entity in half of its texts."""
    near = [(i, f"word{i} zorblat writes from jane.doe@mail.example.org") for i in range(3)]
    far = [(10 + i, f"zorblat number{i} stands alone here") for i in range(7)]
    table = documents(*near, *far, *[(100 + i, f"other{i}") for i in range(3000)])
    # Of its ten texts three are near the entity, though it says most of the entity's bits.
    for given, tagged in ((0.5, 0), (0.0, 7)):
        found = pii.find_personal_data(table, min_given=given).collect()
        assert sum(any(s.kind == 4 for s in r.spans) for r in found if 10 <= r.doc_id < 17) == tagged


def test_empty_table(documents):
    none = documents(*_corpus()).limit(0)
    assert pii.find_personal_data(none).count() == 0
    assert pii.sanitise(none).count() == 0


def test_query_columns(spark, sample):
    texts = {r.doc_id: r.text for r in sample.collect()}
    kinds = ("email", "ip", "card", "phone")
    for row in op9_personal_data(spark, "/root/testdata/sf0.001").collect():
        base = brute.personal(texts[row.doc_id])
        assert [row[f"n_{k}"] for k in kinds] == [sum(s[1] == i for s in base) for i in range(4)]
        joined = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert ",".join(x for x in row.spans.split(",") if not x.startswith("term")) == joined
