import gzip
import re

import brute
import pytest
from newsloom.llm import warc

PAGES = "page_id long, url string, html string"
ROWS = [
    (5, "http://a/\r\nX: y", "same"), (3, "http://b/é ü", "same"), (3, None, "same"), (9, "u", None), (7, "u", ""), (None, "u", "same"),
    (1, "u", "x\r\n\r\nWARC/1.1\r\n\r\n" * 50), (2, "u", "é" * 400_000), (None, "v", "alone"), (None, "v", "alone"), (4, "w", "Content-Length: 3"),
]


def _want(rows, least=0):
    found = []
    for i, _, body in rows:
        payload = (body or "").encode()
        same = [p for p, _, b in rows if (b or "").encode() == payload and p is not None]
        first = min(same) if same and len(payload) >= least else None
        revisit = first is not None and i != first
        found.append((i, len(payload), brute.base32_sha1(payload), "revisit" if revisit else "response", first if revisit else None))
    return sorted(found, key=repr)


@pytest.mark.parametrize("least, archive, gap, reach", [(0, 1 << 28, 1 << 16, 1 << 23), (5, 600, 0, 1), (0, 1, 10, 2000)])
def test_round_trip(spark, tmp_path, least, archive, gap, reach):
    table = spark.createDataFrame(ROWS, PAGES).repartition(3).selectExpr("*", "1 AS key", "2 AS first", "3 AS file")
    index = warc.write_archives(table, str(tmp_path), min_bytes=least, archive_bytes=archive)
    records = warc.read_records(index, gap, reach).collect()
    found = sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records], key=repr)
    assert found == _want(ROWS, least)
    bodies = {(r.page_id, r.url): r.payload for r in records}
    assert bodies[2, "u"].decode() == "é" * 400_000 and bodies[5, ROWS[0][1]] is None or least > 0
    assert {r.url for r in records} == {r[1] for r in ROWS}


def test_a_selection_reads_only_its_records(spark, tmp_path):
    index = warc.write_archives(spark.createDataFrame(ROWS, PAGES), str(tmp_path))
    assert sorted(r.payload.decode()[:3] for r in warc.read_records(index.where("page_id IN (1, 4)")).collect()) == ["Con", "x\r\n"]


def test_archives_are_gzip_members_of_records(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(ROWS, PAGES), str(tmp_path))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in tmp_path.glob("*.warc.gz"))
    assert len(re.findall(rb"(?:^|\r\n\r\n)WARC/1\.1\r\nWARC-Type: (?:response|revisit)\r\n", data)) == len(ROWS)


def test_a_damaged_archive_fails(spark, tmp_path):
    index = warc.write_archives(spark.createDataFrame(ROWS[:1], PAGES), str(tmp_path))
    wrong = index.selectExpr("page_id", "url", "file", "offset", "length", "record_type", "'x' AS payload_digest", "refers_to")
    with pytest.raises(Exception, match="differs from its index"):
        warc.read_records(wrong).collect()


def test_empty_table(spark):
    assert warc.read_records(warc.write_archives(spark.createDataFrame([], PAGES))).count() == 0


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    found = warc.read_records(warc.write_archives(pages)).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], key=repr) == _want(rows)
