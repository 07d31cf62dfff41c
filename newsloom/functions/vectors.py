"""Column expressions on vectors."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, summed in double precision."""
    gaps = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)


def vector_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
