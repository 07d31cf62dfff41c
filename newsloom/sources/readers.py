"""Sources. JSON and text come in at the edges only; the jobs' own tables are Parquet."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.scores import any_relevant
from newsloom.operators.positions import global_positions
from newsloom.schemas import TASK_RESPONSE
from newsloom.session import compute_once, store
from newsloom.sources.json_arrays import json_records

CORRUPT = "_corrupt_record"


def read_table(
    spark: SparkSession,
    path: str,
    schema: str,
    run_id: str | None = None,
    required: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """A run-partitioned table: one run, or all runs if `run_id` is None.

    The run is matched by equality on the partition column, so other runs are not opened.
    A missing table fails if `required` and is empty otherwise.
    """
    # `run_id` comes from the folder name and is text whatever it looks like.
    fields = [f for f in T.StructType.fromDDL(schema).fields if f.name != "run_id"]
    full = T.StructType([*fields, T.StructField("run_id", T.StringType())])
    try:
        df = spark.read.schema(full).parquet(path)
    except AnalysisException as e:
        if required or e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], full)
    if run_id is not None:
        df = df.where(F.col("run_id") == run_id)
    return df.select(*columns) if columns else df


def read_json_array(
    spark: SparkSession, path: str, schema: str, ordinal: bool = False
) -> DataFrame:
    """Files that each hold one JSON array (or one object) of records; a byte-order mark is
    accepted. With `ordinal` a column `ord` numbers the records by file name and place.

    A file that is no such JSON, a cut-off one say, fails the read with its name. Files of any
    size are read, in as many tasks as they have splits.
    """
    records = json_records(spark, path, schema)
    if not ordinal:
        return records.select("row.*")
    placed = global_positions(records.select("file", "place", "row"), ["file", "place"], "ord")
    return placed.select("ord", "row.*")


def read_json_runs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All runs' JSON files, with the run id of the file name (`<run>--<table>.json`) as RUNID."""
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    return json_records(spark, path, schema).select(
        "row.*", F.split(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), "--")[0].alias("RUNID")
    )


# A line of an answer file: the response to a request, or the error it ended with; or what
# became of a whole batch.
ANSWER_LINE = f"{TASK_RESPONSE}, error struct<code: string, message: string>, batch_no bigint, status string"


def line_order(meta: Column) -> Column:
    """The place of each line of text files, by when its file landed, from the files' `_metadata`.
    Lines are numbered as they are read: for a frame right from the read."""
    return F.struct(
        meta["file_modification_time"].alias("landed"), meta["file_path"].alias("file"),
        meta["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line"),
    )


def parse_answer_lines(lines: DataFrame) -> DataFrame:
    """Answer lines (value, ord) with `r`, the fields of ANSWER_LINE, and `damaged`."""
    parsed = compute_once(
        lines.where(F.trim("value") != ""),
        r=F.from_json(
            "value", f"{ANSWER_LINE}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}
        ),
    )
    return parsed.withColumn("damaged", F.col(f"r.{CORRUPT}").isNotNull())


def read_responses(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(response lines with their place `ord`, lines that are no such JSON) of all JSONL files of
    a task."""
    lines = spark.read.text(path).select("value", line_order(F.col("_metadata")).alias("ord"))
    parsed = parse_answer_lines(lines)
    return (
        parsed.where(~F.col("damaged")).select("r.custom_id", "r.response", "ord"),
        parsed.where("damaged").select(F.col("value").alias("line")),
    )


def read_saved_lines(spark: SparkSession, path: str, kind: str, batch_type: str = "string") -> DataFrame:
    """(batch_id, line) of all saved batches, each with the lines of the last poll that brought it;
    `kind` is output or error."""
    lines = spark.read.schema("batch_id string, line string, poll bigint").parquet(f"{path}/{kind}")
    lines = lines.withColumn("batch_id", F.col("batch_id").cast(batch_type))
    if _single_poll(spark, f"{path}/{kind}"):
        return lines.select("batch_id", "line")
    # One row per batch and poll; stored, so that the planner knows how few they are.
    last = store(lines.groupBy(F.col("batch_id").alias("__batch")).agg(F.max("poll").alias("__last")), "polls")
    same = F.col("batch_id").eqNullSafe(F.col("__batch")) & (F.col("poll") == F.col("__last"))
    return lines.join(last, same, "left_semi").select("batch_id", "line")


def _single_poll(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sum(f.getPath().getName().startswith("poll=") for f in found) == 1


def read_saved_responses(spark: SparkSession, path: str, batch_type: str = "string") -> DataFrame:
    """Response lines of all saved batches, from the table of outputs."""
    lines = read_saved_lines(spark, path, "output", batch_type)
    return lines.select("batch_id", F.from_json("line", TASK_RESPONSE).alias("r")).select("batch_id", "r.*")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_relevant(spark: SparkSession, path: str, schema: str, run_id: str | None = None) -> DataFrame:
    """Relevant articles by either form of the score: the map, or the old single number."""
    df = read_table(spark, path, schema, run_id)
    return df.where(any_relevant(F.col("relevance")) | F.coalesce(F.col("relevance_scalar") == 2, F.lit(False)))
