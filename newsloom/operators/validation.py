"""Record validation: bad rows go to a second table with the reason."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.schemas import REQUIRED

REASON = "reject_reason"


def reject_reason(strings: Sequence[str], arrays: Sequence[str] = ()) -> Column:
    """Names of the required columns a row lacks, or null.

    An empty string is a value. An array must be there and hold no null.
    """
    missing = [F.when(F.col(c).isNull(), c) for c in strings]
    missing += [
        F.when(F.col(c).isNull() | F.exists(F.col(c), lambda x: x.isNull()), c) for c in arrays
    ]
    return F.nullif(F.concat_ws(", ", *missing), F.lit(""))


def split_valid(
    df: DataFrame, strings: Sequence[str], arrays: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with `reject_reason`).

    The valid side is a plain conjunction, so that it reaches the scan as pushed filters.
    """
    present = [F.col(c).isNotNull() for c in [*strings, *arrays]]
    present += [F.forall(F.col(c), lambda x: x.isNotNull()) for c in arrays]
    valid = df.where(reduce(Column.__and__, present))
    rejected = df.withColumn(REASON, reject_reason(strings, arrays)).where(F.col(REASON).isNotNull())
    return valid, rejected


def validate(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """`split_valid` with the required columns of one of the known tables."""
    return split_valid(df, *REQUIRED[table])


def has_payload(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")
