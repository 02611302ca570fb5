"""Catalogue operators: from raw rows to unique courses, lookups and samples."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docwright.constants import SECTIONS
from docwright.functions import text as T

HEADERS = {"category": "category", "course name": "course_name"}


def rows(sheet: DataFrame, order: str = "ord") -> DataFrame:
    """(ord, category, course_name) of a raw sheet; headers are found by their cleaned text."""
    found = {}
    for name in sheet.columns:
        key = " ".join(name.split()).lower()
        if key in HEADERS:
            found.setdefault(key, name)
    if set(found) != set(HEADERS):
        raise ValueError(f"sheet needs the columns {sorted(HEADERS)}, found {sheet.columns}")
    quoted = {key: f"`{name}`" for key, name in found.items()}
    return sheet.select(
        order, *[T.clean_cell(F.col(quoted[key])).alias(target) for key, target in HEADERS.items()]
    ).where((F.col("category") != "") & (F.col("course_name") != ""))


def courses(catalogue: DataFrame) -> DataFrame:
    """One row per course name, with its categories in first-seen order, keys and ids.

    Repeats are folded per (course, category) first, so the list collected for a
    course is as long as its number of categories, however many rows it has.
    """
    pairs = catalogue.groupBy("course_name", "category").agg(F.min("ord").alias("ord"))
    grouped = pairs.groupBy("course_name").agg(
        F.min("ord").alias("ord"),
        F.array_sort(F.collect_list(F.struct("ord", "category"))).alias("seen"),
    )
    slug = T.catalogue_slug(F.col("course_name"))
    return grouped.select(
        "ord", "course_name",
        F.transform("seen", lambda x: x["category"]).alias("categories"),
        F.col("seen")[0]["category"].alias("category"),
        slug.alias("slug"),
        T.course_id(slug).alias("course_id"),
        T.discipline_key(F.col("seen")[0]["category"]).alias("discipline"),
    )


def collisions(entries: DataFrame) -> DataFrame:
    """Keys that must be unique and are not: (kind, value, courses). Empty when the load may go on."""
    keyed = entries.select(F.explode(F.array(
        F.struct(F.lit("slug").alias("kind"), F.col("slug").alias("value")),
        F.struct(F.lit("course_id").alias("kind"), F.col("course_id").alias("value")),
    )).alias("key")).select("key.*")
    empty = (F.col("kind") == "slug") & (F.col("value") == "")
    return keyed.groupBy("kind", "value").agg(F.count("*").alias("courses")).where((F.col("courses") > 1) | empty)


def categories(entries: DataFrame) -> DataFrame:
    """Distinct categories with the place each was first seen at."""
    return (
        entries.select("ord", F.posexplode("categories").alias("pos", "category"))
        .groupBy("category").agg(F.min(F.struct("ord", "pos")).alias("first"))
        .select("category", F.col("first.ord").alias("first_ord"), F.col("first.pos").alias("first_pos"))
    )


def of_discipline(entries: DataFrame, discipline: str, limit: int | None = None) -> DataFrame:
    """Courses with the discipline among their categories, the first ones of the list."""
    key = T.discipline_key(F.lit(discipline))
    kept = entries.where(F.exists("categories", lambda c: T.discipline_key(c) == key))
    return kept.orderBy("ord").limit(limit) if limit is not None else kept


def per_category(entries: DataFrame) -> DataFrame:
    return entries.select(F.explode("categories").alias("category")).groupBy("category").agg(
        F.count("*").alias("courses"))


def summary(entries: DataFrame) -> DataFrame:
    return entries.agg(
        F.count("*").alias("courses"),
        F.count_if(F.size("categories") > 1).alias("multi_category"),
        (F.count("*") * len(SECTIONS)).alias("planned_calls"),
    )


def undeclared(entries: DataFrame, declared: DataFrame) -> DataFrame:
    """Disciplines of the catalogue that the domain registry does not know."""
    return entries.select("discipline").distinct().join(declared.select("discipline"), "discipline", "left_anti")


def _requests(requests: DataFrame) -> DataFrame:
    # Folded per key before the join, so a name asked for very often is one row.
    return requests.groupBy(T.fold(T.strip(F.col("name"))).alias("key")).agg(
        F.min("req_pos").alias("req_pos"), F.min_by("name", "req_pos").alias("name"), F.count("*").alias("times"))


def lookup(entries: DataFrame, requests: DataFrame) -> DataFrame:
    """Courses asked for by name, once each, with the place they were first asked at."""
    named = entries.select(T.fold(F.col("course_name")).alias("key"), "course_id", "course_name", "ord")
    last = named.groupBy("key").agg(F.max_by(F.struct("course_id", "course_name"), "ord").alias("course"))
    return _requests(requests).join(last, "key").select("req_pos", "course.*")


def lookup_misses(entries: DataFrame, requests: DataFrame) -> DataFrame:
    named = entries.select(T.fold(F.col("course_name")).alias("key"))
    return _requests(requests).join(named, "key", "left_anti").select("req_pos", "name", "times")


def stratified_sample(entries: DataFrame, count: int, seeds: DataFrame | None = None) -> DataFrame:
    """Seeds first, then one course per discipline and round, disciplines in order.

    Each seed (course_id, seed_pos) is taken once, though entries may share an id; whatever shares it is not taken again.
    A seed's discipline is its own where seeds have that column, else that of the first entry of its id.
    Only the first `count` courses of a discipline can be taken, so the ranking
    keeps no more than that per discipline before and after its shuffle.
    """
    if seeds is None:
        chosen, rest = None, entries
    else:
        chosen = seeds.orderBy("seed_pos").limit(count)
        rest = entries.join(chosen.select("course_id").distinct(), "course_id", "left_anti")
    by_discipline = Window.partitionBy("discipline").orderBy("ord")
    ranked = rest.withColumn("round", F.row_number().over(by_discipline)).where(F.col("round") <= count)
    picked = ranked.select(
        F.lit(1).alias("after_seed"), F.lit(0).cast("bigint").alias("seed_pos"), "round", "discipline", "course_id")
    if chosen is not None:
        if "discipline" not in chosen.columns:
            first = entries.groupBy("course_id").agg(F.min_by("discipline", "ord").alias("discipline"))
            chosen = chosen.join(first, "course_id")
        taken = chosen.select(
            F.lit(0).alias("after_seed"), F.col("seed_pos").cast("bigint"), F.lit(0).alias("round"), "discipline", "course_id")
        picked = taken.unionByName(picked)
    return picked.orderBy("after_seed", "seed_pos", "round", "discipline").limit(count)
