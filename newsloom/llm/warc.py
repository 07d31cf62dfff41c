"""WARC archives: records written with an index, and read back by sorted byte ranges."""

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import store
from newsloom.session import scratch_path

# Payloads from this size on are stored once.
MIN_BYTES = 0
# An archive is closed once it is as large.
ARCHIVE_BYTES = 256 << 20
# Records of an archive are read together while the bytes between them, and the whole range,
# are no more than this.
MAX_GAP = 64 << 10
RANGE_BYTES = 8 << 20
# Bytes of records that a task reads.
TASK_BYTES = 64 << 20
# Of all records; the pages have no time of their own.
DATE = "1970-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = (
    "page_id bigint, url string, file string, offset bigint, length bigint, record_type string, "
    "payload_digest string, refers_to bigint"
)
_RECORDS = (
    "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, "
    "refers_to bigint, payload binary"
)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _record(page_id, url, payload: bytes, digest: str, revisit: bool, refers_to) -> bytes:
    """One record, as a gzip member of its own."""
    http = _HTTP.format(len(payload)).encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        # Characters that may not stand in a header are escaped; the index has the url itself.
        f"WARC-Target-URI: {quote(url or '', safe=_URI)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
    record = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


_URI = "!#$%&'()*+,/:;=?@[]-._~"


def _parse(member: bytes) -> tuple[dict[str, str], int, bytes]:
    """(headers, full length of the payload, payload in the record)."""
    record = zlib.decompress(member, 31)
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    sizes = [line[16:] for line in http.decode().split("\r\n") if line.startswith("Content-Length: ")]
    return headers, int(sizes[0]), payload


def with_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is set on rows that revisit another.

    Of the rows with an equal payload of at least `min_bytes` bytes, those with the smallest
    page_id are responses, the others revisit it. Payloads are told apart by SHA-256. Only
    digests are counted, map-side first; pages are joined with the digests that repeat.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.withColumn("key", F.sha2(payload, 256))
    large = keyed.where(F.octet_length(payload) >= min_bytes).select("key", "page_id")
    repeated = large.groupBy("key").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    repeated = repeated.where("n > 1 AND first IS NOT NULL").select(F.col("key").alias("same"), "first")
    joined = keyed.join(store(repeated, "repeated"), F.col("key") == F.col("same"), "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = MIN_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per row to gzipped WARC files in `folder`; returns their index, stored:
    page_id, url, file, offset, length, record_type, payload_digest, refers_to.

    `folder` is one that all executors share, as a path or URI that Arrow's file systems know;
    by default it lies in the scratch folder. The payload
    is `html` in UTF-8, empty for null. Each attempt of a task writes files of its own, and
    only those of the attempts that ended well are in the index: files of lost executors
    are never read. No rows give an empty index. Rows of equal page_id and payload are
    all responses or all revisits; a null page_id is never the smallest.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.col(html).cast("string").alias("html"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, name = TaskContext.get().partitionId(), None, ""
        for batch in batches:
            found = []
            columns = [batch.column(c).to_pylist() for c in range(4)]
            for i, address, body, first in zip(*columns, strict=True):
                if out is None:
                    name, at = f"{folder}/part-{part:05}-{uuid.uuid4().hex}.warc.gz", 0
                    files, path = fs.FileSystem.from_uri(name)
                    files.create_dir(path.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(path, compression=None)
                payload = (body or "").encode()
                digest = _digest(payload)
                member = _record(i, address, payload, digest, first is not None, first)
                out.write(member)
                kind = "response" if first is None else "revisit"
                found.append((i, address, name, at, len(member), kind, digest, first))
                at += len(member)
                if at >= archive_bytes:
                    out.close()
                    out = None
            if found:
                columns = list(zip(*found, strict=True))
                text, number = pa.string(), pa.int64()
                kinds = [number, text, text, number, number, text, text, number]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    [c.split()[0] for c in _INDEX.split(", ")],
                )
        if out is not None:
            out.close()

    return store(with_revisits(rows, min_bytes).mapInArrow(write, _INDEX), "warc-index")


def read_records(
    index: DataFrame, max_gap: int = MAX_GAP, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """The records of the rows of `index`: page_id, url, record_type, payload_digest,
    payload_bytes (of the full payload), refers_to, payload (null of revisits).

    Rows are sorted by file and offset over all tasks; neighbours are read in one go of at
    most `range_bytes` bytes (or one record). Digests are checked against what is read, and
    the job fails where they differ.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, handle = None, None
        for batch in batches:
            rows = batch.to_pylist()
            while rows:
                n, start, end = 1, rows[0]["offset"], rows[0]["offset"] + rows[0]["length"]
                while n < len(rows):
                    r = rows[n]
                    if r["file"] != rows[0]["file"] or r["offset"] > end + max_gap or r["offset"] + r["length"] > start + range_bytes:
                        break
                    end = max(end, r["offset"] + r["length"])
                    n += 1
                if rows[0]["file"] != name:
                    name = rows[0]["file"]
                    files, path = fs.FileSystem.from_uri(name)
                    handle = files.open_input_file(path)
                data = handle.read_at(end - start, start)
                yield pa.RecordBatch.from_pylist([_checked(r, data, start) for r in rows[:n]], _SCHEMA)
                rows = rows[n:]

    # By the bytes of the records: the index itself is small, and adaptive execution, which joins
    # small partitions of a number that is not given, would read all of it in few tasks.
    total = index.agg(F.sum("length")).first()[0] or 0
    cores = index.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-total // TASK_BYTES), min(cores, total // RANGE_BYTES))
    placed = index.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(read, _RECORDS)


def _checked(row: dict, data: bytes, start: int) -> dict:
    at = row["offset"] - start
    headers, size, payload = _parse(data[at : at + row["length"]])
    revisit = headers["WARC-Type"] == "revisit"
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    same = digest == row["payload_digest"] and headers["WARC-Type"] == row["record_type"]
    if revisit:
        same &= headers["WARC-Refers-To"] == _record_id(row["refers_to"], digest)
    else:
        same &= digest == _digest(payload) and size == len(payload)
    if not same:
        raise ValueError(f"{row['file']} differs from its index at {row['offset']}")
    return {
        "page_id": row["page_id"], "url": row["url"], "record_type": headers["WARC-Type"],
        "payload_digest": digest, "payload_bytes": size, "refers_to": row["refers_to"],
        "payload": None if revisit else payload,
    }


_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ]
)
