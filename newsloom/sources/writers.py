"""Sinks. Writes of a run can be repeated and give the same table; the two logs (`append_ledger`,
`append_post_log`) grow with each call."""

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.scores import recode
from newsloom.operators.history import last_per_key
from newsloom.operators.joins import drop_invalid
from newsloom.operators.posts import post_text
from newsloom.session import store

# Headings of the article selection.
EXPORT_NAMES = {
    "article_title": "título",
    "article_url": "url",
    "publish_date": "fecha de publicación",
    "summary": "resumen",
    "source_name": "fuente",
    "article_language": "idioma",
}


def _file_system(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def make_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.mkdirs(folder)


def _swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put a folder that was written aside into the place of another.

    The old folder goes aside by name and is deleted last, so that a driver lost in between
    leaves the old rows or the new ones complete under the table's folder.
    """
    fs, new = _file_system(spark, staged)
    old, aside = _file_system(spark, target)[1], _file_system(spark, f"{staged}_old")[1]
    fs.mkdirs(old.getParent())
    if fs.exists(old) and not fs.rename(old, aside):
        raise OSError(f"cannot move {target}")
    if not fs.rename(new, old):
        raise OSError(f"cannot put a new folder at {target}")
    fs.delete(aside, True)


def _aside(path: str) -> str:
    # Readers of the table's folder skip names that begin like this.
    return f"{path}/_staged_{uuid.uuid4().hex}"


def replace_run(df: DataFrame, path: str, run_id: str) -> None:
    """Overwrite one run with `df`, also if that is empty, and leave the others.

    The rows are written aside first; the run has its old ones until they are there.
    """
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"run id {run_id!r} cannot name a folder")
    staged = _aside(path)
    df.drop("run_id").write.parquet(staged)
    _swap_in(df.sparkSession, staged, f"{path}/run_id={run_id}")


def write_run(df: DataFrame, path: str) -> None:
    """Overwrite the runs that `df` holds and leave the others. An empty `df` changes nothing.

    Rows are dealt out by run, a large run to several tasks, so that few files are written.
    """
    (
        df.hint("rebalance", "run_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def upsert_run(
    stored: DataFrame, fresh: DataFrame, path: str, keys: Sequence[str], ord_col: str | None = None
) -> None:
    """Replace rows of one run by key and keep its others; of equal keys the last counts.

    `stored` is read from `path`; runs that `fresh` does not hold are neither read nor written.
    The merged run is staged first, since a partition cannot be read while it is overwritten.
    """
    if ord_col:
        fresh = last_per_key(fresh, keys, ord_col).drop(ord_col)
    stored = stored.join(fresh.select("run_id").distinct(), "run_id", "left_semi").select(*stored.columns)
    kept = stored.join(fresh.select(*keys), list(keys), "left_anti")
    write_run(store(kept.unionByName(fresh.select(*kept.columns)), "upsert"), path)


def delete_invalid(stored: DataFrame, verdicts: DataFrame, path: str, run_id: str) -> None:
    """Remove the content of one run that was judged false; `stored` is read from `path`."""
    run = stored.where(F.col("run_id") == run_id)
    replace_run(store(drop_invalid(run, verdicts), "valid"), path, run_id)


def append_ledger(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_request_files(
    requests: DataFrame, path: str, line: Column, replace: bool = True, dealt: bool = False
) -> None:
    """One JSONL file per batch, under run_id=/task_name=/batch_no=.

    `requests` holds run_id, task_name, batch_no and pos. Rows are exchanged by batch, so
    that each batch is written by one task, in order, and a task writes many batches; one
    write for all of them. With `replace` the folder of a run's task is replaced as a
    whole, so that no batch of an earlier, longer write stays; else only the batches that
    `requests` holds are. `dealt`: each batch is in one partition already.
    """
    batch = ["run_id", "task_name", "batch_no"]
    rows = requests.select(*batch, "pos", line.alias("value"))
    lines = (
        (rows if dealt else rows.repartition(*batch))
        .sortWithinPartitions(*batch, "pos")
        .drop("pos")
        .write.partitionBy(*batch)
    )
    if not replace:
        lines.mode("overwrite").option("partitionOverwriteMode", "dynamic").text(path)
        return
    spark, staged = requests.sparkSession, _aside(path)
    lines.text(staged)
    fs, top = _file_system(spark, staged)
    for run in fs.globStatus(_file_system(spark, f"{staged}/run_id=*/task_name=*")[1]):
        own = run.getPath()
        _swap_in(spark, own.toString(), f"{path}/{own.getParent().getName()}/{own.getName()}")
    fs.delete(top, True)


def write_saved_bodies(outputs: DataFrame, errors: DataFrame, path: str) -> None:
    """Lines of the outputs and of the errors of batches, in tables of their own.

    Each call is a poll with a folder of its own, however many batches it brings. A batch has
    the lines of the last poll that brought it, and batches that a poll does not bring stay:
    `readers.read_saved_lines`.
    """
    for kind, bodies in (("output", outputs), ("error", errors)):
        # A batch without a body has no lines, and leaves what it had.
        lines = bodies.select(F.col("batch_id").cast("string").alias("batch_id"), F.explode(F.split("body", "\n")).alias("line"))
        fs, folder = _file_system(bodies.sparkSession, f"{path}/{kind}")
        polls = [p.getPath().getName() for p in fs.listStatus(folder)] if fs.exists(folder) else []
        last = max((int(p.removeprefix("poll=")) for p in polls if p.startswith("poll=")), default=-1)
        # Written aside, so that a poll is there as a whole or not at all.
        staged = _aside(f"{path}/{kind}")
        lines.write.parquet(staged)
        _swap_in(bodies.sparkSession, staged, f"{path}/{kind}/poll={last + 1}")


def selection(frame: DataFrame, personas: Sequence[str], names: Mapping[str, str] = EXPORT_NAMES) -> DataFrame:
    """The article selection: localised headings, R or NR per persona."""
    return frame.select(
        *[F.col(c).alias(name) for c, name in names.items()],
        *[recode(F.col(p)).alias(p) for p in personas],
    )


def write_selection(selected: DataFrame, path: str) -> None:
    selected.write.mode("overwrite").option("header", True).csv(path, quoteAll=True, escape='"')


def write_posts(posts: DataFrame, path: str, order_by: Sequence[str] = ("article_title",)) -> None:
    """Text records per persona, under perfil=; a persona's files follow on one another in
    order. `posts` should be a stored table, since ranges are sampled before it is written."""
    text = post_text(F.col("copy"), F.col("article_title"), F.col("article_url"))
    (
        posts.withColumn("value", text)
        .repartitionByRange("perfil", *order_by)
        .sortWithinPartitions("perfil", *order_by)
        .select("perfil", "value")
        .write.mode("overwrite")
        .partitionBy("perfil")
        .text(path)
    )


def append_post_log(posts: DataFrame, path: str) -> None:
    """Post and URL, then a blank line."""
    posts.select(
        F.concat("copy", F.lit("\n"), "article_url", F.lit("\n")).alias("value")
    ).write.mode("append").text(path)
