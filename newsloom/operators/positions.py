"""Row positions, without ever holding a whole group in one task."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.session import store


def global_positions(df: DataFrame, order_by: Sequence[str], pos: str = "pos") -> DataFrame:
    """Add the 0-based position of each row in the order of `order_by`.

    A range exchange sorts in parallel. The row id then counts rows inside each task, and
    the start of each task's rows comes from a table with one row per task. The sorted
    rows are stored in between, since ids would change if a task were planned anew.
    `order_by` should be unique; ties are put in some order.
    """
    return _ranged_positions(df, [], list(order_by), pos)


def group_positions(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pos: str = "pos"
) -> DataFrame:
    """Add the 0-based position of each row inside its group.

    Groups of any size are cut over range partitions and the pieces are offset against each
    other, so that no task holds a group. `order_by` should be unique inside a group.
    """
    return _ranged_positions(df, list(keys), list(order_by), pos)


def positions_joined(
    df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (), pos: str = "pos"
) -> DataFrame:
    """Add positions, over the table or per group, to rows with many or large columns.

    `order_by` (with `keys`) must identify a row. Only these columns are sorted and stored;
    the positions are joined back on them, so that wide rows are read and exchanged once.
    A row without its own key fails the job instead of getting a wrong position.
    """
    key = [*keys, *order_by]
    slim = df.select(*key)
    placed = group_positions(slim, keys, order_by, pos) if keys else global_positions(slim, order_by, pos)
    if set(df.columns) == set(key):
        return placed.select(*df.columns, pos)
    # Grouped as the join needs it, so that counting the rows of a key costs no exchange.
    one = placed.groupBy(*key).agg(F.min(pos).alias("__pos"), F.count("*").alias("__n"))
    checked = F.when(F.col("__n") == 1, F.col("__pos")).otherwise(
        F.raise_error(F.lit(f"{key} do not identify a row")).cast("bigint")
    )
    return df.join(one, key, "left").select(*df.columns, checked.alias(pos))


def _ranged_positions(
    df: DataFrame, keys: list[str], order_by: list[str], pos: str
) -> DataFrame:
    ranged = (
        df.repartitionByRange(*keys, *order_by)
        .sortWithinPartitions(*keys, *order_by)
        .withColumn("__row", F.monotonically_increasing_id())
    )
    # The upper bits of the id are the task, the lower 33 count its rows.
    rows = (
        store(ranged, "ranged")
        .withColumn("__task", F.shiftright("__row", 33))
        .withColumn("__local", F.col("__row").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    pieces = rows.groupBy(*keys, "__task").agg(
        F.count("*").alias("__n"), F.min("__local").alias("__first")
    )
    # At most one row per task in each group.
    before = Window.partitionBy(*keys).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        F.col("__task").alias("__t"),
        "__first",
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    same = F.col("__task") == F.col("__t")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    # Stored, so that the planner knows whether to broadcast one start per task and group.
    joined = rows.join(store(starts, "starts"), same)
    return joined.select(
        *df.columns, (F.col("__before") + F.col("__local") - F.col("__first")).alias(pos)
    )
