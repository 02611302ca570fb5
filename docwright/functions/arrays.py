"""Small helpers for array expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(c: Column, use) -> Column:
    """use(c), with c evaluated once however often use mentions it."""
    return F.transform(F.array(c), use)[0]


def repeats(values: Column) -> Column:
    """True when an array holds a value twice."""
    return let(values, lambda v: F.size(F.array_distinct(v)) < F.size(v))


def unnest(frame: DataFrame, array, *ids: str) -> DataFrame:
    """One row (ids, item) per array entry that is not null.

    A plain explode would make the optimizer test the array for emptiness below
    every projection, and so build an expensive array a second time.
    """
    return frame.select(*ids, F.explode_outer(array).alias("item")).where(F.col("item").isNotNull())
