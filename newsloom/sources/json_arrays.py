"""Files of one JSON array each, read in as many tasks as they have splits.

The text reader cuts a file at closing braces, inside its splits, so every record is a stretch
of such pieces. Where records begin depends on all the text before: whether a piece starts
inside a string, and how deep. What a piece does to both is known without that, for either
case of the string, and what a split does follows from its pieces. So splits are summed up
first, chained per file, and then find their records in parallel.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.session import compute_once, store

# Files whose length on disk is not that of their text.
COMPRESSED = "(?i)[.](gz|bz2|zst|zstd|lz4|snappy|deflate)$"
SPLIT = ["file", "split"]
# Files up to this size are one value each.
WHOLE_BYTES = 256 << 20


def json_records(spark: SparkSession, path: str, schema: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """(file, place, row) of the records of JSON files; `place` counts from 0 in each file.

    A file holds an array of objects, or one object; an empty file holds none. Other content
    fails the read with the file's name: an array that is cut off, an element that is no object.
    Files of up to `whole_bytes` are parsed as one value each, which takes a fraction of the
    time but does not see text behind the array; larger ones are cut into records by their
    splits. Of a large compressed file with a single object, a cut right before its last brace
    is not seen, nor is a lone brace behind a compressed array.
    """
    size = F.col("_metadata.file_size")
    text = spark.read.text(path, wholetext=True).where(size <= whole_bytes).select(
        F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "^\ufeff", "").alias("text")
    )
    rows = f"array<{T.StructType.fromDDL(schema).simpleString()}>"
    parsed = F.from_json("text", rows)
    fault = parsed.isNull() | F.exists(parsed, lambda r: r.isNull())
    checked = F.when(fault, F.raise_error(_message()).cast(rows)).otherwise(parsed)
    small = text.select("file", F.posexplode(checked).alias("place", "row"))
    # The listing is filtered by size, so that this reads no file that is smaller.
    if spark.read.text(path, lineSep="}").where(size > whole_bytes).isEmpty():
        return small
    pieces = store(_pieces(spark, path, whole_bytes), "json-pieces")
    starts = store(_split_starts(pieces), "json-splits")
    texts = _parsed(_record_texts(pieces, starts), schema)
    large = texts.where(_unless(~F.col("sound"))).select("file", "place", F.get("rows", F.lit(0)).alias("row"))
    return small.withColumn("place", F.col("place").cast("bigint")).unionByName(large)


def _parsed(texts: DataFrame, schema: str) -> DataFrame:
    """Record texts with `rows`, an array of the record, and `sound`, whether they are JSON."""
    fields = T.StructType.fromDDL(schema).simpleString()
    # An object is read as an array of it; text that is no JSON gives null.
    parsed = compute_once(texts, rows=F.from_json("text", f"array<{fields}>"))
    sound = (F.size("rows") == 1) & F.get("rows", F.lit(0)).isNotNull()
    return parsed.withColumn("sound", F.coalesce(sound, F.lit(False)))


def _pieces(spark: SparkSession, path: str, beyond: int = 0) -> DataFrame:
    """What stands before each closing brace of the files beyond a size, and behind the last one.

    `quotes` are those that open or close strings. `down0` and `down1` tell how much deeper the
    text is behind the brace, if the piece starts outside or inside a string.
    """
    meta = F.col("_metadata")
    text = spark.read.text(path, lineSep="}").where(meta["file_size"] > beyond).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("split"),
        meta["file_size"].alias("size"), F.monotonically_increasing_id().alias("line"), "value",
    )
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    bare = text.withColumn("bare", F.when(F.contains("value", F.lit("\\")), plain).otherwise(F.col("value")))
    counted = compute_once(
        bare,
        quotes=_count(F.col("bare"), '"'),
        braces0=_count(_outside(F.col("bare")), "{"),
        braces1=_count(_outside(F.concat(F.lit('"'), "bare")), "{"),
    )
    # The brace counts if it stands outside of strings.
    odd = F.col("quotes") % 2
    return counted.select(
        *SPLIT, "size", "line", "value", "quotes",
        (F.col("braces0") - (1 - odd)).alias("down0"), (F.col("braces1") - odd).alias("down1"),
    )


def _outside(text: Column) -> Column:
    return F.regexp_replace(text, '"[^"]*"?', "")


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


# Statements, so that the plan is analysed once; a table per file of a few records is common.
_STARTS = r"""
WITH flipped AS (
  SELECT *, coalesce(sum(quotes) OVER (PARTITION BY file, split ORDER BY line
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS odd
  FROM {pieces}),
deep AS (
  SELECT *, sum(if(odd, down1, down0)) OVER up_to AS deep0, sum(if(odd, down0, down1)) OVER up_to AS deep1
  FROM flipped
  WINDOW up_to AS (PARTITION BY file, split ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
lows AS (
  SELECT *, min(deep0) OVER (PARTITION BY file, split) AS low0, min(deep1) OVER (PARTITION BY file, split) AS low1
  FROM deep),
-- Records end where the depth is 0, which is the least that a split can come to.
splits AS (
  SELECT file, split, size, sum(quotes) AS quotes, count(*) AS n, sum(octet_length(value)) AS bytes,
    max_by(deep0, line) AS total0, max_by(deep1, line) AS total1, min(low0) AS low0, min(low1) AS low1,
    count_if(deep0 = low0) AS ends0, count_if(deep1 = low1) AS ends1,
    min_by(value RLIKE r'^\s*\[', line) AS opens,
    max_by(CASE WHEN value RLIKE r'^\s*\]\s*$' THEN 'closed' WHEN value RLIKE r'^\s*$' THEN 'blank'
      WHEN value RLIKE r'^\s*\[\s*\]\s*$' THEN 'empty' ELSE 'record' END, line) AS tail
  FROM lows GROUP BY file, split, size),
strings AS (SELECT *, coalesce(sum(quotes) OVER before, 0) % 2 = 1 AS inside FROM splits
  WINDOW before AS (PARTITION BY file ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
known AS (
  SELECT *, if(inside, total1, total0) AS total, if(inside, low1, low0) AS low, if(inside, ends1, ends0) AS ends
  FROM strings),
depths AS (SELECT *, coalesce(sum(total) OVER before, 0) AS depth FROM known
  WINDOW before AS (PARTITION BY file ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
placed AS (SELECT *, coalesce(sum(if(depth + low = 0, ends, 0)) OVER before, 0) AS first FROM depths
  WINDOW before AS (PARTITION BY file ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
files AS (
  SELECT file, split, inside, depth, first, min_by(opens, split) OVER whole AS opens,
    max_by(tail, split) OVER whole AS tail, max(split) OVER whole = split AS last, sum(n) OVER whole AS n,
    sum(total) OVER whole AS left, sum(quotes) OVER whole % 2 = 0 AS even,
    -- Each brace is a byte of the file beside the pieces; so may be a mark of three at its start.
    size - sum(bytes) OVER whole - sum(n) OVER whole AS spare
  FROM placed WINDOW whole AS (PARTITION BY file)),
ended AS (SELECT *, if(file RLIKE {compressed}, tail = 'record', spare IN (0, 3)) AS braced FROM files)
-- The last piece counts as if a brace followed it.
SELECT file, split, inside, depth, first, opens, last, braced, even AND CASE
    WHEN braced THEN NOT opens AND left = 0
    WHEN opens THEN left = -1 AND (tail = 'closed' OR (tail = 'empty' AND n = 1))
    ELSE left = -1 AND tail = 'blank' AND n > 1 END AS sound
FROM ended
"""

_RECORDS = r"""
WITH turned AS (
  SELECT p.*, s.depth, s.first, s.opens, s.sound,
    (coalesce(sum(quotes) OVER (PARTITION BY p.file, p.split ORDER BY line
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + int(inside)) % 2 = 1 AS odd,
    last AND NOT braced AND lead(line) OVER (PARTITION BY p.file, p.split ORDER BY line) IS NULL AS tail
  FROM {pieces} p JOIN {starts} s ON p.file = s.file AND p.split = s.split),
deep AS (
  SELECT *, if(odd, down1, down0) AS down, depth + sum(if(odd, down1, down0)) OVER (
    PARTITION BY file, split ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS behind
  FROM turned),
bounds AS (SELECT *, NOT odd AND behind = down AND NOT tail AS begins, behind = 0 AND NOT tail AS ends FROM deep),
placed AS (
  SELECT *, first + coalesce(sum(int(ends)) OVER (PARTITION BY file, split ORDER BY line
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM bounds)
SELECT file, split, line, place, begins, ends, tail,
  concat(if(begins, substr(value, instr(value, '{{')), value), '}}') AS text,
  NOT sound OR (begins AND NOT if(place > 0, opens AND value RLIKE r'^\s*,\s*[{{]',
    value RLIKE r'^\s*(\[\s*)?[{{]')) AS fault
FROM placed
"""


def _split_starts(pieces: DataFrame) -> DataFrame:
    """For each split whether it starts inside a string, how deep, and in which record; of its
    file whether it opens an array, ends behind a brace, and is sound as a whole."""
    return pieces.sparkSession.sql(_STARTS, pieces=pieces, compressed=COMPRESSED)


def _record_texts(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """(file, place, text) of each record. The pieces are exchanged once, by split; only what
    reaches over the bounds of splits is exchanged again."""
    rows = pieces.sparkSession.sql(_RECORDS, pieces=pieces, starts=starts)
    rows = rows.where(_unless(F.col("fault"), ~F.col("tail")))
    parts = rows.groupBy(*SPLIT, "place").agg(
        _joined("line").alias("text"), (F.bool_or("begins") & F.bool_or("ends")).alias("complete")
    )
    cut = parts.where(~F.col("complete")).groupBy("file", "place").agg(_joined("split").alias("text"))
    return parts.where("complete").select("file", "place", "text").unionByName(cut)


def _joined(order: str) -> Column:
    """The texts of a group as one, by `order`."""
    parts = F.sort_array(F.collect_list(F.struct(order, "text")))
    return F.array_join(F.transform(parts, lambda p: p["text"]), "")


def _unless(fault: Column, keep: Column | bool = True) -> Column:
    """`keep` as a condition that fails the read for a row with a fault."""
    return F.when(fault, F.raise_error(_message()).cast("boolean")).otherwise(keep)


def _message() -> Column:
    return F.concat(F.lit("no JSON array of records: "), F.col("file"))
