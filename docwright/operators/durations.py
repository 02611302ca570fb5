"""Duration registry: checks of its entries and resolution of course names.

The registry is a configuration table: exact names in one DataFrame, patterns in
a short ordered list that is compiled into one CASE expression.
"""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwright.constants import MAX_TAUGHT_YEARS
from docwright.functions import text as T
from docwright.functions.numbers import default_taught_years


def reject_reason(low: Column, high: Column, years: Column) -> Column:
    """Why an entry, given as raw text columns, cannot be used; null when it can."""
    lo, hi, given = low.try_cast("double"), high.try_cast("double"), years.try_cast("int")
    taught = F.when(years.isNull(), default_taught_years(lo, hi)).otherwise(
        F.when(years.rlike(r"^-?\d+\z"), given))
    return (
        F.when(lo.isNull() | hi.isNull(), "not_numeric")
        .when((lo <= 0) | (hi < lo), "impossible_span")
        .when(taught.isNull() | ~taught.between(1, MAX_TAUGHT_YEARS), "taught_years_out_of_range")
        .when(taught > F.ceil(hi), "taught_years_above_span")
    )


def repeated_names(exact: DataFrame) -> DataFrame:
    """Exact names that are the same once folded."""
    return exact.groupBy(T.name_key(F.col("name")).alias("name_key")).agg(F.count("*").alias("entries")).where(
        F.col("entries") > 1)


def pattern_fault(pattern: Column) -> Column:
    return F.when(pattern.isNull(), "missing").when(pattern.rlike(r"[\x00-\x1F]"), "control_character")


def uncompilable(patterns: list) -> list:
    """Patterns of a registry that are not valid expressions."""
    bad = []
    for pattern in patterns:
        try:
            re.compile(pattern)
        except re.error:
            bad.append(pattern)
    return bad


def taught_years(low: Column, high: Column, given: Column) -> Column:
    return F.coalesce(given.cast("int"), default_taught_years(low, high))


def resolve(names: DataFrame, exact: DataFrame, patterns: list, name: str = "course_name") -> DataFrame:
    """Add duration (struct or null): the exact name wins, else the first pattern found.

    exact has (name, min_years, max_years, academic_years); patterns is a list of
    dicts with match, min_years, max_years and maybe academic_years, in order.
    Exact names are unique after folding, so the join adds no rows.
    """
    key = T.name_key(F.col(name))

    def entry(low, high, given, source):
        return F.struct(
            low.alias("min_years"), high.alias("max_years"), taught_years(low, high, given).alias("academic_years"),
            source.alias("source"),
        )

    table = exact.select(
        T.name_key(F.col("name")).alias("_key"),
        entry(F.col("min_years").cast("double"), F.col("max_years").cast("double"), F.col("academic_years"),
              F.concat(F.lit("exact:"), T.name_key(F.col("name")))).alias("_exact"),
    )
    by_pattern = None
    for p in patterns:
        value = entry(F.lit(float(p["min_years"])), F.lit(float(p["max_years"])), F.lit(p.get("academic_years")),
                      F.lit(f"pattern:{p['match']}"))
        test = F.col("_key").rlike(f"(?U){p['match']}")
        by_pattern = F.when(test, value) if by_pattern is None else by_pattern.when(test, value)
    found = F.col("_exact") if by_pattern is None else F.coalesce(F.col("_exact"), by_pattern)
    return (
        names.withColumn("_key", key)
        .join(table, "_key", "left")
        .withColumn("duration", F.when(F.col("_key") != "", found))
        .drop("_key", "_exact")
    )


def coverage(resolved: DataFrame) -> DataFrame:
    """One row: courses, pinned, unpinned and status. The unpinned ones stay rows of `resolved`."""
    return resolved.agg(
        F.count("*").alias("courses"),
        F.count("duration").alias("pinned"),
        (F.count("*") - F.count("duration")).alias("unpinned"),
        F.when(F.count("*") > F.count("duration"), "warn").otherwise("ok").alias("status"),
    )
