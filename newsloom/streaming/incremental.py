"""Dedupe of runs as they land, against everything seen before."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import number_suffix
from newsloom.operators.history import ARTICLE_KEYS, drop_known, history_keys


def dedupe_landing(
    spark: SparkSession,
    landing: str,
    schema: str,
    output: str,
    checkpoint: str,
    keys: Sequence[str] = ARTICLE_KEYS,
    files_per_batch: int = 1000,
) -> None:
    """Process all landed files and stop; call again when more have landed.

    `landing` is a Parquet folder of rows with a `run_id` such as RUNID_7; one without a number
    ends the stream. A row is dropped
    if a batch before holds its key in another run, or its own batch in an earlier run: the
    result of deduping the runs one by one as they come. Copies inside a run stay, also if
    the run's files fall into several batches.

    A batch writes its own folders under `output` (new) and `output`/_keys (the keys it
    brought), by overwrite, so that a batch run again after a failure changes nothing. The
    history it reads is the narrow key table, not the articles.
    """
    source = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )

    def step(batch: DataFrame, epoch: int) -> None:
        # Runs order by number.
        unnumbered = F.raise_error(F.concat(F.lit("a run id without a number: "), "run_id")).cast("bigint")
        rows = batch.withColumn("__run", F.coalesce(number_suffix(F.col("run_id")), unnumbered))
        fresh = history_keys(rows, keys, "__run")
        fresh.write.mode("overwrite").parquet(f"{output}/_keys/epoch={epoch}")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema.fields)
        seen = batch.sparkSession.read.schema(f"{ddl}, epoch bigint").parquet(f"{output}/_keys")
        now, past = F.col("epoch") == epoch, F.col("epoch") < epoch
        # Of the history only the keys of this batch are aggregated; the batch's key table
        # was just written, so the planner knows whether to broadcast it.
        known = (
            seen.where(F.col("epoch") <= epoch)
            .join(seen.where(now).select("__key").distinct(), "__key", "left_semi")
            .groupBy("__key")
            .agg(
                F.min(F.when(past, F.col("__lo"))).alias("__lo"),
                F.max(F.when(past, F.col("__hi"))).alias("__hi"),
                F.min(F.when(now, F.col("__lo"))).alias("__now"),
            )
        )
        run = F.col("__run")
        clash = (F.col("__lo") != run) | (F.col("__hi") != run) | (F.col("__now") < run)
        kept = drop_known(rows, known, keys, clash).drop("__run")
        kept.write.mode("overwrite").parquet(f"{output}/new/epoch={epoch}")

    query = (
        source.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_new(spark: SparkSession, output: str, schema: str) -> DataFrame:
    """All rows kept so far."""
    return spark.read.schema(f"{schema}, epoch bigint").parquet(f"{output}/new").drop("epoch")
