"""Session settings and the shared scratch folder."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_local_scratch: dict[str, str] = {}
# Folders of the `scratch_scope`s that are open, the innermost last.
_scopes: list[str] = []


# Bytes that one task of an exchange should hold.
TASK_BYTES = 128 << 20


def build_session(
    app_name: str = "newsloom", master: str | None = None, data_bytes: int | None = None, **conf
) -> SparkSession:
    """A session with the settings the jobs are tuned for; `conf` overrides them.

    `data_bytes` is the size of the largest table that is shuffled. Exchanges get as many
    partitions as it needs; adaptive execution joins small ones up again.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if data_bytes:
        settings["spark.sql.shuffle.partitions"] = str(max(8, -(-data_bytes // TASK_BYTES)))
    for key, value in {**settings, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's checkpoint folder.

    Where the setting is missing, a temporary folder stands in only if driver and tasks are
    one process. On a cluster, a simulated one too, the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/newsloom"
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id", "app")
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="newsloom-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that nothing has used before."""
    base = _scopes[-1] if _scopes else scratch_dir(spark)
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables stored inside are deleted at the end; their frames end with it."""
    path = scratch_path(spark, "scope")
    _scopes.append(path)
    try:
        yield
    finally:
        _scopes.remove(path)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns that rows are filtered by afterwards.

    A filter on a plain column expression is moved below it and evaluates it again, for
    each mention. It stays above a generator, here one that gives one row per row.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*fields))))


# A table with fewer bytes for each core is dealt out by `spread`.
SPREAD_BYTES = 64 << 20


def spread(df: DataFrame, bytes_per_core: int = SPREAD_BYTES) -> DataFrame:
    """Deal the rows of a small table out to all cores before costly work on each row.

    A table in one file with one row group is read by one task, however many cores there
    are. Larger tables, by the planner's size, have splits enough and stay as they are.
    """
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if size < cores * bytes_per_core else df


def store(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to a scratch table and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and
    values that depend on the physical plan (row ids, model answers) stay fixed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
