"""Answers to requests that went out as files, taken in as they land."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.tasks import flatten_envelope
from newsloom.sources.readers import line_order, parse_answer_lines

TAKEN = (
    "custom_id string, model string, content string, error string, batch_no bigint, status string, "
    "ord struct<landed: timestamp, file: string, block: bigint, line: bigint>"
)


def take_in(
    spark: SparkSession, landing: str, output: str, checkpoint: str, files_per_batch: int = 1000
) -> None:
    """Read all files landed in `landing` since the last call, and stop.

    Lines are those of `readers.ANSWER_LINE`. Each batch of files writes its own folders
    under `output`: answers (TAKEN) and damaged (lines that are no such JSON), by overwrite,
    so that a batch run again after a failure changes nothing. A file is read once: what
    is to replace it must have a new name.
    """
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).text(landing)

    def step(batch: DataFrame, epoch: int) -> None:
        parsed = parse_answer_lines(batch.select("value", line_order(F.col("meta")).alias("ord")))
        good = parsed.where(~F.col("damaged")).select("r.*", "ord")
        # An error without a message still is one.
        error = F.when(
            F.col("error").isNotNull(), F.concat_ws(": ", F.lit("error"), "error.code", "error.message")
        )
        flat = flatten_envelope(good.withColumn("error", error), "batch_no", "status", "ord")
        flat.write.mode("overwrite").parquet(f"{output}/answers/epoch={epoch}")
        parsed.where("damaged").select("value", "ord").write.mode("overwrite").parquet(
            f"{output}/damaged/epoch={epoch}"
        )

    query = (
        lines.select("value", F.col("_metadata").alias("meta"))
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def taken_in(spark: SparkSession, output: str) -> DataFrame:
    """All answers taken in, with their `epoch`."""
    return spark.read.schema(f"{TAKEN}, epoch bigint").parquet(f"{output}/answers")
