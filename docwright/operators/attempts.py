"""Reduction of the attempt log: outcomes, next steps, usage and review items.

An attempt row is (course_id, section, attempt, passed, transport_error, code,
citations, usage). All reductions combine before their shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwright.constants import MAX_ATTEMPTS, MAX_REPAIR_ROUNDS, RETRYABLE_STATUS, SECTIONS
from docwright.functions.arrays import unnest
from docwright.functions.variants import nesting_depth, number_leaves

KEY = ("course_id", "section")


def section_rank(section: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), section).cast("int")


def outcomes(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """One row per course and section: status, attempts used, citations of the deciding attempt.

    A section is accepted at its first passing attempt, flagged at a transport
    failure or when the attempts are used up, and open otherwise.
    """
    usable = F.col("attempt") <= max_attempts
    passed = F.when(usable & F.col("passed") & ~F.col("transport_error"), F.col("attempt"))
    broken = F.when(usable & F.col("transport_error"), F.col("attempt"))
    grouped = attempts.groupBy(*KEY).agg(
        F.min(passed).alias("pass_at"),
        F.min(broken).alias("broken_at"),
        F.max(F.when(usable, F.col("attempt"))).alias("last_at"),
        F.min_by("citations", passed).alias("pass_citations"),
        F.max_by("citations", F.when(usable, F.col("attempt"))).alias("last_citations"),
    )
    accepted = F.col("pass_at").isNotNull() & (F.col("pass_at") < F.coalesce("broken_at", F.lit(max_attempts + 1)))
    flagged = F.col("broken_at").isNotNull() | (F.col("last_at") >= max_attempts)
    return grouped.select(
        *KEY,
        F.when(accepted, "accepted").when(flagged, "flagged").otherwise("open").alias("status"),
        F.least("pass_at", "broken_at", "last_at").alias("attempts"),
        (~accepted & F.col("broken_at").isNotNull()).alias("transport_failed"),
        F.when(accepted, F.col("pass_citations")).otherwise(F.col("last_citations")).alias("citations"),
    )


def counted(attempts: DataFrame, reduced: DataFrame) -> DataFrame:
    """The attempts that were really made: those up to the deciding one."""
    stops = reduced.select(*KEY, F.col("attempts").alias("_stop"))
    return attempts.join(stops, list(KEY)).where(F.col("attempt") <= F.col("_stop")).drop("_stop")


def next_attempts(reduced: DataFrame, expected: DataFrame) -> DataFrame:
    """What every expected (course_id, section) needs next: fresh, repair or nothing."""
    return expected.join(reduced, list(KEY), "left").select(
        *KEY,
        F.when(F.col("status").isNull(), "fresh").when(F.col("status") == "open", "repair").otherwise("none").alias("request"),
        (F.coalesce("attempts", F.lit(0)) + 1).alias("next_attempt"),
    )


def course_status(reduced: DataFrame, reports: DataFrame) -> DataFrame:
    """validated when every section is accepted and the document report (course_id, status) passes."""
    grouped = reduced.groupBy("course_id").agg(
        F.bool_and(F.col("status") == "accepted").alias("all_accepted"), F.sum("attempts").alias("attempts"))
    return grouped.join(reports.select("course_id", F.col("status").alias("report")), "course_id", "left").select(
        "course_id",
        F.when(F.col("all_accepted") & F.col("report").eqNullSafe("pass"), "validated").otherwise("flagged").alias("status"),
        "attempts")


def repairs(failing: DataFrame, round_number: int, max_rounds: int = MAX_REPAIR_ROUNDS) -> DataFrame:
    """Sections to make again after a failed document check; none once the rounds are used up."""
    rows = unnest(failing, "sections", "course_id").select(
        "course_id", F.col("item").alias("section"), F.lit(round_number + 1).alias("round"))
    return rows if round_number < max_rounds else rows.limit(0)


def merge_rounds(rounds: DataFrame) -> DataFrame:
    """Outcomes of several rounds as one: attempts add up, the last round decides."""
    return rounds.groupBy(*KEY).agg(
        F.sum("attempts").alias("attempts"), F.max_by("status", "round").alias("status"), F.max("round").alias("round"))


def unsourced(reduced: DataFrame) -> DataFrame:
    return reduced.where((F.col("status") == "accepted") & (F.coalesce(F.size("citations"), F.lit(0)) <= 0))


def flat_usage(usage: Column) -> Column:
    """Numbers of a usage object as array<struct<path, value>>; request counts are left out."""
    numbers = number_leaves(F.try_parse_json(usage), nesting_depth(usage))
    return F.filter(numbers, lambda n: ~n["path"].rlike(r"(^|\.)requests(\.|$)|\["))


def usage_rows(attempts: DataFrame, *ids: str) -> DataFrame:
    """(ids, key, value), with one request counted per attempt."""
    counted_request = F.array(F.struct(F.lit("requests").alias("path"), F.lit(1.0).alias("value")))
    flat = attempts.select(*ids, F.explode(F.concat(
        F.coalesce(flat_usage(F.col("usage")), F.array().cast("array<struct<path:string,value:double>>")), counted_request,
    )).alias("u"))
    return flat.select(*ids, F.col("u.path").alias("key"), F.col("u.value").alias("value"))


def merge_usage(rows: DataFrame, *ids: str) -> DataFrame:
    return rows.groupBy(*ids, "key").agg(F.sum("value").alias("value"))


def retry_triage(log: DataFrame, max_retries: int = 4, base: float = 2.0, max_delay: float = 60.0, seed: int = 0) -> DataFrame:
    """Per failed request (status, attempt from 0, retry_after): whether and when to retry.

    wait is without jitter; jitter is the random part to add to it.
    """
    retryable = F.col("status").isin(*RETRYABLE_STATUS)
    exhausted = F.col("attempt") >= max_retries
    wait = F.greatest(F.least(F.lit(max_delay), F.lit(base) * F.pow(F.lit(2.0), "attempt")),
                      F.coalesce(F.col("retry_after").cast("double"), F.lit(0.0)))
    go = retryable & ~exhausted
    return log.withColumns({
        "decision": F.when(~retryable, "not_retryable").when(exhausted, "exhausted").otherwise("retry"),
        "wait": F.when(go, wait),
        "jitter": F.when(go, F.rand(seed) * base),
    })


def review_items(reduced: DataFrame, attempts: DataFrame, runs: DataFrame) -> DataFrame:
    """Courses that are not validated: their open sections, attempts map and error codes.

    runs is the course status, with the flagged_sections it was stored with, if any: they count where every section was accepted
    but the document failed.

    Codes are made distinct per course before they are collected, so a list is
    never longer than the number of codes there are.
    """
    ordered = F.struct(section_rank(F.col("section")).alias("r"), F.col("section"), F.col("attempts"))
    grouped = reduced.groupBy("course_id").agg(
        F.array_sort(F.collect_list(ordered)).alias("every"),
        F.array_sort(F.collect_list(F.when(F.col("status") != "accepted", ordered))).alias("open"),
    )
    stored = F.col("flagged_sections") if "flagged_sections" in runs.columns else F.array().cast("array<string>")
    open_runs = runs.where(F.col("status") != "validated").select("course_id", stored.alias("stored"))
    grouped = grouped.join(open_runs, "course_id")
    bad = reduced.where(F.col("status") != "accepted").select(*KEY)
    codes = (
        attempts.where(~F.col("passed") & F.col("code").isNotNull()).join(bad, list(KEY), "left_semi")
        .groupBy("course_id", "code")
        .agg(F.min(F.struct(section_rank(F.col("section")), "attempt")).alias("first"))
        .groupBy("course_id").agg(F.array_sort(F.collect_list(F.struct("first", "code"))).alias("codes"))
    )
    return grouped.join(codes, "course_id", "left").select(
        "course_id",
        F.when(F.size("open") > 0, F.transform("open", lambda x: x["section"])).otherwise(F.coalesce("stored", F.array().cast("array<string>"))).alias("flagged_sections"),
        F.map_from_entries(F.transform("every", lambda x: F.struct(x["section"], x["attempts"]))).alias("attempts"),
        F.coalesce(F.transform("codes", lambda x: x["code"]), F.array().cast("array<string>")).alias("codes"),
    )


def with_discipline(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Queue items with the category of their saved document."""
    return items.join(documents.select("course_id", F.col("category").alias("discipline")), "course_id", "left")
