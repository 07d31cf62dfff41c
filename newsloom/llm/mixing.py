"""Mixing sources to target weights by whole epochs and an exact cut."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import one_per_key, row_keys, store, unused_names
from newsloom.operators.positions import global_positions

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]++")).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources by code point, null last, have `weights` in turn and share the size of all by
    them. No target is above `max_epochs` times its source; the excess goes to the others by
    weight until none is above. Each round sums the table of sources to three numbers; what
    is capped is a matter of whole numbers, so that reruns agree. Without words all is 0.
    """
    ordered = sizes.withColumn("none", F.col("source").isNull())
    placed = global_positions(ordered, ["none", "source"])
    turns = F.array(*[F.lit(w).cast("bigint") for w in weights])
    rated = placed.select(
        "source", "source_size",
        F.get(turns, (F.col("pos") % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"),
    )
    rated = store(rated, "sources")
    total = rated.agg(F.sum("source_size")).first()[0] or 0

    def wide(x) -> Column:
        return (F.lit(x) if isinstance(x, int) else x).cast("decimal(38,0)")

    rest, weight, n_capped = total, None, -1
    capped = F.lit(False)
    while True:
        now = rated.agg(
            F.count_if(capped), F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        if now[0] == n_capped or not now[2]:
            break
        n_capped, rest, weight = now[0], total - (now[1] or 0), now[2]
        capped = wide(rest) * F.col("weight") > wide(F.col("cap")) * wide(weight)
    share = F.lit(float(rest)) * F.col("weight") / F.lit(float(weight or 1))
    return rated.select(
        "source", "source_size", "weight",
        F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def _running_sums(rows: DataFrame) -> DataFrame:
    """Rows sorted by source, with the task and the sizes before the row in task and source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, source, before = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            names = batch.column("source").to_pylist()
            sizes = batch.column("size").to_numpy()
            cut = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
            sums = np.zeros(len(names), np.int64)
            for a, b in zip([0, *cut], [*cut, len(names)], strict=True):
                if a == b:
                    continue
                if a or names[a] != source:
                    source, before = names[a], 0
                ends = before + np.cumsum(sizes[a:b])
                sums[a:b] = ends - sizes[a:b]
                before = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(names), task)), pa.array(sums)],
                [*batch.schema.names, "task", "before"],
            )

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(run, f"{kinds}, task bigint, before bigint")


def take(
    rows: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """The rows (source, size, key, tie and others), with source_size, target and taken.

    A target is met by as many whole epochs of its source as it holds, and by the documents
    that come first by key, up to the exact word: the last one may be taken in part. Rows are
    sorted by range, so that a source may span many tasks, and sums before each task are
    added up over one row per task and source.
    """
    rows = store(rows, "sizes")
    totals = store(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    targets = store(source_targets(totals, weights, max_epochs), "targets")
    ordered = rows.withColumn("none", F.col("source").isNull()).withColumn("nth", F.monotonically_increasing_id())
    order = ["none", "source", "key", "tie", "nth"]
    ranged = ordered.repartitionByRange(*order).sortWithinPartitions(*order).drop("none", "nth")
    summed = store(_running_sums(ranged), "summed")
    pieces = summed.groupBy("source", "task").agg(F.sum("size").alias("piece"))
    earlier = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("source", "task", F.coalesce(F.sum("piece").over(earlier), F.lit(0)).alias("start"))
    starts = starts.alias("a").join(targets.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select(
        F.col("a.source").alias("s"), F.col("task").alias("t"), "start", "source_size", "target"
    )
    starts = store(starts, "starts")
    budget = F.least(F.floor(F.col("target") + 0.5).cast("bigint"), F.col("source_size") * max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    joined = summed.join(starts, (F.col("task") == F.col("t")) & F.col("source").eqNullSafe(F.col("s")))
    joined = joined.withColumn("epochs", F.expr("0L") + epochs).withColumn("budget", budget)
    left = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("start") - F.col("before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return joined.select(*rows.columns, "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"))


def _sized(documents: DataFrame, ids: dict[str, Column], text: str, source: str, doc_id: str, seed: int) -> DataFrame:
    body = F.col(text).cast("string")
    return documents.select(
        *[column.alias(name) for name, column in ids.items()],
        F.col(source).cast("string").alias("source"),
        n_words(body).alias("size"),
        F.md5(F.concat_ws(":", F.col(doc_id).cast("string"), F.lit(str(seed)))).alias("key"),
        F.xxhash64(body).alias("tie"),
    )


def mixed_words(
    documents: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 7,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row: how many of its words the mix
    takes, repeats counted.

    The key of a document is the MD5 of its doc_id and the seed; rows of equal or null
    doc_id go by their text, and repeated rows in any order. A null text has size 0, a null
    source is a source like any other. No rows give no rows.
    """
    rows = _sized(documents, {"doc_id": F.col(doc_id).cast("bigint")}, text, source, doc_id, seed)
    return take(rows, weights, max_epochs).select("doc_id", "size", "source_size", "target", "taken")


def mix(
    documents: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = 7,
) -> DataFrame:
    """The mix itself: a row of `documents`, with all its columns, for each time it is taken.

    Of a document that is taken in part, that row has the text up to the last word taken;
    other columns stay as they are. Rows of which nothing is taken, empty texts among them,
    do not come. Rows that agree in doc_id, source and text are one, taken as often as all
    of them. Amounts are found on narrow rows; texts are exchanged once, by the key that they
    are then joined on. What is taken grows with the input, so that it is never broadcast.
    """
    k1, k2, copy, taken, size = unused_names(documents, "k1", "k2", "copy", "taken", "size")
    identity = row_keys(F.col(doc_id), F.col(source), F.col(text))
    keyed = documents.withColumns({k1: identity[0], k2: identity[1]})
    rows = _sized(documents, {"k1": identity[0], "k2": identity[1]}, text, source, doc_id, seed)
    used = take(rows, weights, max_epochs).where("taken > 0").groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2))
    used = store(used.agg(F.max("size").alias(size), F.sum("taken").alias(taken)), "taken")
    joined = one_per_key(keyed, [k1, k2]).join(used.hint("merge"), [k1, k2])
    copies = joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.ceil(F.col(taken) / F.col(size)).cast("int"))))
    rest = (F.col(taken) - (F.col(copy) - 1) * F.col(size)).cast("int")
    # Each piece is a word and the white space before it.
    pieces = F.split(F.col(text), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    first = F.array_join(F.slice(pieces, F.lit(1), rest), "")
    cut = F.when(rest < F.col(size), first).otherwise(F.col(text))
    return copies.withColumn(text, cut).select(*documents.columns)
