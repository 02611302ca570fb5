"""Numeric expressions shared by the rules and the assembly operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from docwright.constants import MAX_TAUGHT_YEARS


def half_even(c: Column) -> Column:
    """Round to a whole number, halves to the even neighbour."""
    return F.bround(c, 0).cast("bigint")


def default_taught_years(low: Column, high: Column) -> Column:
    return F.greatest(F.floor(low), F.least(F.ceil(high), F.lit(MAX_TAUGHT_YEARS))).cast("int")


def salary_position(low: Column, typical: Column, high: Column) -> Column:
    """Where the typical figure sits between low and high, in percent."""
    return F.when(high != low, half_even((typical - low) / (high - low) * F.lit(100.0)))


def spread(low: Column, high: Column) -> Column:
    """high / low, unbounded when low is zero."""
    return F.when(low == 0, F.lit(float("inf"))).otherwise(high / low)


def is_sequence(values: Column) -> Column:
    """True when the array reads 1, 2, ... n; an empty array does."""
    return F.forall(
        F.transform(values, lambda v, i: v.eqNullSafe(i + 1)), lambda ok: ok
    )
