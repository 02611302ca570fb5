"""Assembly of documents: injected and derived fields, sections, requests."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from docwright.constants import CONTEXT_KEYS, MAX_TAUGHT_YEARS, SECTIONS
from docwright.functions import text as T
from docwright.functions.numbers import half_even
from docwright.functions.variants import as_object, over
from docwright.operators.domains import DEFAULT
from docwright.schema import DOCUMENT


def injected_fields(course_id: Column, name: Column, category: Column, currency: str, region: str) -> Column:
    """Identity fields as JSON text; a missing category stays absent."""
    return F.to_json(F.struct(
        course_id.alias("course_id"), T.slugify(name).alias("slug"), name.alias("course_name"),
        F.lit(currency).alias("currency"), F.lit(region).alias("region"), F.nullif(category, F.lit("")).alias("category"),
    ))


def section_json(document: Column, section: str) -> Column:
    """The part of a VARIANT document that a section owns, as JSON text."""
    unknown = [p for p in SECTIONS[section] if p not in DOCUMENT.members]
    if unknown:
        raise ValueError(f"section {section} names properties outside the schema: {unknown}")
    owned = F.array(*[F.lit(p) for p in SECTIONS[section]])
    return F.to_json(F.map_filter(as_object(document), lambda k, _: F.array_contains(owned, k)))


def merge_sections(base: DataFrame, sections: DataFrame) -> DataFrame:
    """Documents out of injected fields (course_id, fields) and accepted sections (course_id, section, payload).

    Sections are laid over the injected fields in pipeline order; the sections a
    course lacks are listed, those whose payload is no object too. One shuffle, on the course.
    """
    payloads = sections.groupBy("course_id").agg(*[
        F.max(F.when(F.col("section") == s, F.col("payload"))).alias(f"_{s}") for s in SECTIONS])
    joined = base.join(payloads, "course_id", "left")
    parts = joined.select("course_id", "fields", F.array(*[as_object(F.try_parse_json(F.col(f"_{s}"))) for s in SECTIONS]).alias("parts"))
    merged = F.aggregate(F.array_compact("parts"), as_object(F.parse_json("fields")), over)
    missing = F.array_compact(F.array(*[F.when(F.col("parts")[at].isNull(), F.lit(s)) for at, s in enumerate(SECTIONS)]))
    return parts.select("course_id", F.to_json(merged).alias("body"), missing.alias("missing_sections"))


def latest_sections(sections: DataFrame) -> DataFrame:
    """The newest payload of every course and section; combines before its shuffle."""
    return sections.groupBy("course_id", "section").agg(
        F.max_by("payload", "ts").alias("payload"), F.max("ts").alias("ts"))


def overlay_duration(doc: Column, duration: Column) -> Column:
    """Put a pinned duration into the quick facts of a typed document."""
    facts = doc["quick_facts"]
    span = F.struct(duration["min_years"].alias("min_years"), duration["max_years"].alias("max_years"))
    pinned = duration.isNotNull() & facts.isNotNull()
    return F.when(pinned, doc.withField("quick_facts.typical_duration", span)).otherwise(doc)


def distinct_sources(sources: Column) -> Column:
    """Sources with an address, the first of every address."""
    given = F.filter(sources, lambda s: s["url"].isNotNull())
    urls = F.transform(given, lambda s: s["url"])
    return F.filter(given, lambda s, i: F.array_position(urls, s["url"]) == i + 1)


def marker_percent(salary: Column) -> Column:
    low, typical, high = salary["lower_annual"], salary["typical_annual"], salary["higher_annual"]
    place = half_even((typical - low) / F.when(high > low, high - low) * F.lit(100.0))
    return F.coalesce(
        F.when(place.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(100), place))),
        salary["marker_percent"], F.lit(50),
    ).cast("bigint")


def derived_fields(doc: Column, reviewed: Column) -> Column:
    """Set the computed fields of a typed document: review date, sources, salary marker."""
    with_check = F.when(doc["verification"].isNotNull(), doc
                        .withField("verification.last_reviewed", F.date_format(reviewed, "yyyy-MM-dd"))
                        .withField("verification.sources", distinct_sources(doc["verification"]["sources"]))).otherwise(doc)
    salary = doc["snapshot"]["salary"]
    return F.when(salary.isNotNull(), with_check.withField("snapshot.salary.marker_percent", marker_percent(salary))).otherwise(with_check)


def strip_derived(section: Column, paths) -> Column:
    """A typed section without its computed fields."""
    for path in paths:
        section = section.dropFields(path)
    return section


def strip_pinned_duration(facts: Column, pinned: Column) -> Column:
    """Quick facts whose duration is left out where it is pinned."""
    span = F.when(~pinned, facts["typical_duration"])
    return F.when(facts.isNotNull(), facts.withField("typical_duration", span))


def map_strings(c: Column, of: S.DataType, fn) -> Column:
    """Apply fn to every string of a nested column of the given type."""
    if isinstance(of, S.StringType):
        return fn(c)
    if isinstance(of, S.ArrayType):
        return F.transform(c, lambda x: map_strings(x, of.elementType, fn))
    if isinstance(of, S.StructType):
        return F.when(c.isNotNull(), F.struct(*[
            map_strings(c[f.name], f.dataType, fn).alias(f.name) for f in of.fields]))
    return c


def carried_context(document: Column) -> Column:
    """What later sections are told, as JSON text: name, region and the carried keys that are there."""
    wanted = F.array(*[F.lit(k) for k in ("course_name", "region") + CONTEXT_KEYS])
    return F.to_json(F.map_filter(as_object(document), lambda k, _: F.array_contains(wanted, k)))


def contexts(base: DataFrame, sections: DataFrame, only: Column | None = None) -> DataFrame:
    """(course_id, section, context): what each section of a course is told, as JSON text with sorted keys.

    base has (course_id, fields), sections the accepted ones (course_id, section, payload). A section sees the injected fields under
    what the sections before it gave, later ones over earlier ones, and nothing of itself or of those behind it. `only` is an array
    of the sections that are made again: they see all stored sections that are not among them first, wherever those stand.
    One shuffle, on the course; the prefixes are folded inside the row over the few carried keys.
    """
    carried = F.array(*[F.lit(k) for k in ("course_name", "region") + CONTEXT_KEYS])
    chosen = F.array(*map(F.lit, SECTIONS)) if only is None else only
    payloads = sections.groupBy("course_id").agg(*[
        F.max(F.when(F.col("section") == s, F.col("payload"))).alias(f"_{s}") for s in SECTIONS])
    told = lambda json: F.map_filter(as_object(F.try_parse_json(json)), lambda k, _: F.array_contains(carried, k))
    # Carried keys only from here on; what is no object gives nothing.
    parts = F.array(*[F.struct(F.lit(s).alias("section"), told(F.col(f"_{s}")).alias("given"), F.array_contains(F.col("_only"), s).alias("again")) for s in SECTIONS])
    rows = base.select("course_id", told(F.col("fields")).alias("_base"), chosen.alias("_only")).join(payloads, "course_id", "left")
    rows = rows.select("course_id", "_base", parts.alias("parts"))
    stored = F.aggregate(
        F.filter("parts", lambda p: ~p["again"] & p["given"].isNotNull()), F.col("_base"), lambda known, p: over(known, p["given"]))
    empty = F.array().cast("array<struct<section:string,known:map<string,variant>>>")
    folded = F.aggregate(
        F.filter("parts", lambda p: p["again"]), F.struct(F.col("_known").alias("known"), empty.alias("seen")),
        lambda acc, p: F.struct(
            F.when(p["given"].isNull(), acc["known"]).otherwise(over(acc["known"], p["given"])).alias("known"),
            F.array_append(acc["seen"], F.struct(p["section"].alias("section"), acc["known"].alias("known"))).alias("seen")),
        lambda acc: acc["seen"])
    seen = rows.withColumn("_known", stored).select("course_id", F.explode(folded).alias("s"))
    return seen.select("course_id", "s.section", F.to_json(F.parse_json(F.to_json("s.known"))).alias("context"))


def pin_fault(years: Column) -> Column:
    """A pinned number of years that the schema cannot hold."""
    return F.when(~years.between(1, MAX_TAUGHT_YEARS), "pin_outside_schema")


def fits_pin(curriculum_years: Column, years: Column) -> Column:
    """Whether a curriculum has exactly the pinned years, numbered within them."""
    return (F.size(curriculum_years) == years) & F.forall(curriculum_years, lambda y: y["year"] <= years)


def _year_text(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"\.0\z", "")


def constraint_lines(section: Column, duration: Column) -> Column:
    """Lines that fix the length of a pinned course, for the sections they concern."""
    low, high, taught = duration["min_years"], duration["max_years"], duration["academic_years"].cast("string")
    span = F.when(low == high, _year_text(low)).otherwise(F.concat(_year_text(low), F.lit(" to "), _year_text(high)))
    return (
        F.when(duration.isNull(), F.lit(None).cast("string"))
        .when(section == "profile", "- The duration is fixed already; leave it out.")
        .when(section == "academics", F.concat(
            F.lit("- The course runs "), span, F.lit(" years with "), taught,
            F.lit(" taught years: give exactly "), taught, F.lit(" curriculum entries.")))
    )


def request_plan(courses: DataFrame, resolved_domains: DataFrame, currency: str, region: str, told: DataFrame | None = None, recency: str = "") -> DataFrame:
    """One request row per course and section, with the context of contexts() and how old a source may be ("" for any age).

    courses has course_id, course_name, discipline, duration; resolved_domains
    has (discipline, section, domains), one row per key of the registry. A course
    whose discipline has no key, or none at all, gets those of the default key.
    Domains are folded to one row per discipline first, so courses are joined
    before they are multiplied by sections.
    """
    folded = resolved_domains.groupBy("discipline").agg(
        F.map_from_entries(F.collect_list(F.struct("section", "domains"))).alias("own"))  # at most a section's cap for each section
    default = folded.where(F.col("discipline") == DEFAULT).select("own").scalar()
    keys = F.create_map(*[x for s, names in SECTIONS.items() for x in (F.lit(s), F.lit(", ".join(names)))])
    joined = courses.join(folded, "discipline", "left").withColumn("own", F.coalesce("own", default))
    rows = joined.select("*", F.explode(F.array(*[F.lit(s) for s in SECTIONS])).alias("section"))
    if told is not None:
        rows = rows.join(told, ["course_id", "section"], "left")
    return rows.withColumn("domains", F.try_element_at("own", F.col("section"))).select(
        "course_id", "course_name", "section", "discipline", F.nullif(F.lit(recency), F.lit("")).alias("recency"),
        *(["context"] if told is not None else []),
        F.lit(currency).alias("currency"), F.lit(region).alias("region"),
        keys[F.col("section")].alias("wanted_keys"),
        "domains", F.coalesce(F.size("domains") > 0, F.lit(False)).alias("search_filtered"),
        constraint_lines(F.col("section"), F.col("duration")).alias("constraint_line"),
    )


def repair_plan(plan: DataFrame, rejected: DataFrame) -> DataFrame:
    """Requests for sections whose last attempt was rejected, with its output and failure lines.

    rejected has (course_id, section, previous_output, failure_lines); the fixed
    lines of pinned courses stay part of the request.
    """
    return plan.join(rejected, ["course_id", "section"])
