"""Queries over validation results: findings, reports, feedback and attribution."""

from pyspark.sql import functions as F

from docwright.constants import FEEDBACK_LIMIT, INJECTED, SECTIONS
from docwright.functions.arrays import unnest
from docwright.functions.variants import as_object, without
from docwright.operators import assembly as A
from docwright.operators import report as P
from docwright.operators import rules as R
from docwright.operators.structure import TYPICAL_DURATION
from docwright.plans import sql as Q
from docwright.plans import views as V
from docwright.plans.document_queries import _CITE, _HARD, _PROCESS, _SOFT, RULE_QUERIES, pinned_years
from docwright.plans.feedback_sql import lines as feedback_lines_of
from docwright.plans.registry import query
from docwright.schema import DOCUMENT_TYPE
from docwright.sources import artifacts as W

_TEXT_LEAF = f"""(SELECT k, course_id, path, p AS text FROM {Q._PARA}
  UNION ALL SELECT k, course_id, 'parent_corner.intro', body FROM intro
  UNION ALL SELECT k, course_id, 'verification.sources[' || j || '].url', url FROM src
  UNION ALL SELECT k, course_id, 'extra_note', 'demo value' FROM dd WHERE k % 37 = 0)"""
_TEXT_PARTS = [
    Q._f(code, "path", _TEXT_LEAF, test, severity)
    for code, severity, test in (
        ("blank_string", "error", f"NOT regexp_matches(text, '[^{Q.WS[1:-1]}]')"),
        ("placeholder_text", "error", _HARD), ("possible_placeholder_text", "warning", f"NOT {_HARD} AND {_SOFT}"),
        ("process_commentary", "error", _PROCESS), ("citation_markers", "error", _CITE))
]
_STRUCTURE_PARTS = [f"SELECT *, 'error' AS severity FROM ({p})" for n in Q.STRUCTURE_SQL for p in Q.STRUCTURE_SQL[n][1]]
_RULE_PARTS = [p for n in Q.RULE_SQL for p in Q.RULE_SQL[n][1]]


def _union(parts, source):
    return " UNION ALL ".join(f"(SELECT *, '{source}' AS source FROM ({p}))" for p in parts)


FOUND = f"found AS ({_union(_STRUCTURE_PARTS, 'schema')} UNION ALL {_union(_TEXT_PARTS + _RULE_PARTS, 'rule')})"


def found_sql(body: str) -> str:
    return Q.with_("para intro src", "").rstrip() + ", " + FOUND + "\n" + body


def validated(spark, sf):
    docs = V.json_documents(spark, sf)
    years = pinned_years(F.get_json_object("body", "$.course_name"))
    return P.validate(docs, allowed_domains=Q.ALLOWED, academic_years=years)


@query("findings_table", found_sql("SELECT course_id, code, path, severity, source FROM found"))
def findings_table(spark, sf):
    return P.findings_table(validated(spark, sf), "course_id").select("course_id", "code", "path", "severity", "source")


@query("validation_report", found_sql("""
  SELECT course_id, CASE WHEN coalesce(e, 0) = 0 THEN 'pass' ELSE 'fail' END AS status, 'document' AS scope,
    CAST(coalesce(e, 0) AS INTEGER) AS errors, CAST(coalesce(w, 0) AS INTEGER) AS warnings,
    CASE WHEN k % 31 = 0 THEN 3 ELSE 0 END AS skipped
  FROM dd LEFT JOIN (SELECT k, count(*) FILTER (severity = 'error') AS e, count(*) FILTER (severity = 'warning') AS w
    FROM found GROUP BY k) c USING (k)"""))
def validation_report(spark, sf):
    return P.report(validated(spark, sf), "course_id").drop("findings", "skipped_rules")


@query("rule_skips", Q.with_("dd", """
  SELECT course_id, rule FROM dd CROSS JOIN (VALUES ('fee_rows'), ('fee_spread_forces_segmentation'), ('total_programme_fee_sanity')) v(rule)
  WHERE k % 31 = 0"""))
def rule_skips(spark, sf):
    docs = V.json_documents(spark, sf)
    skipped = R.skipped_rules(F.col("d"), present=F.col("keys"))
    read = docs.select("course_id", F.from_json("body", DOCUMENT_TYPE).alias("d"), F.json_object_keys("body").alias("keys"))
    return unnest(read.select("course_id", skipped.alias("skipped")), "skipped", "course_id").select(
        "course_id", F.col("item").alias("rule"))


_SUBSET = ("duration_ordering", "salary_ordering", "college_ranking")
_SUBSET_SQL = " UNION ALL ".join(
    f"({p})" for n, (code, _) in RULE_QUERIES.items() if code in _SUBSET for p in Q.RULE_SQL[n][1])


@query("rule_subset_report", Q.with_("dd", f"""
  SELECT course_id, CASE WHEN n_errors IS NULL THEN 'pass' ELSE 'fail' END AS status,
    CAST(coalesce(n_errors, 0) AS INTEGER) AS errors
  FROM dd LEFT JOIN (SELECT k, count(*) AS n_errors FROM ({_SUBSET_SQL}) GROUP BY k) c USING (k)"""))
def rule_subset_report(spark, sf):
    docs = V.json_documents(spark, sf, ("course_name", "quick_facts", "snapshot", "colleges"))
    checked = P.validate(docs, rules=R.subset(*_SUBSET), structural=False)
    return P.report(checked, "course_id").select("course_id", "status", "errors")


@query("failing_sections", found_sql(f"""
  SELECT course_id, section, min(rank) AS section_rank FROM found
  JOIN (VALUES {', '.join(f"('{p}', '{s}', {i})" for i, s in enumerate(SECTIONS) for p in SECTIONS[s])}) o(property, section, rank)
    ON property = regexp_extract(path, '^[a-z_]+')
  WHERE severity = 'error' GROUP BY course_id, section"""))
def failing_sections(spark, sf):
    rows = validated(spark, sf).select("course_id", P.failing_sections(F.col("findings")).alias("sections"))
    rank = F.array_position(F.array(*[F.lit(s) for s in SECTIONS]), F.col("item")) - 1
    return unnest(rows, "sections", "course_id").select(
        "course_id", F.col("item").alias("section"), rank.cast("int").alias("section_rank"))


@query("property_owner", found_sql(f"""
  SELECT property, section, count(*) AS findings FROM (SELECT regexp_extract(path, '^[a-z_]+') AS property FROM found)
  LEFT JOIN (VALUES {', '.join(f"('{p}', '{s}')" for s in SECTIONS for p in SECTIONS[s])}) o(property, section) USING (property)
  GROUP BY property, section"""))
def property_owner(spark, sf):
    found = P.findings_table(validated(spark, sf), "course_id").select(P.root_property(F.col("path")).alias("property"))
    return found.select("property", P.owning_section(F.col("property")).alias("section")).groupBy("property", "section").agg(
        F.count("*").alias("findings"))


# Paths in document order: members by name, indexes as numbers.
_IN_ORDER = r"list_aggregate(list_transform(string_split(path, '['), lambda x: CASE WHEN regexp_matches(x, '^[0-9]+\]') THEN lpad(regexp_extract(x, '^[0-9]+'), 9, '0') || substr(x, strpos(x, ']')) ELSE x END), 'string_agg', '[')"


@query("feedback_lines", Q.with_("para intro src", f"""
  SELECT course_id, array_to_string((list('- ' || CASE path WHEN '' THEN '<root>' ELSE path END || ': ' || message
      ORDER BY source, CASE source WHEN 0 THEN {_IN_ORDER} END, CASE source WHEN 0 THEN code END, rank, place, message))[1:{FEEDBACK_LIMIT}], '|') AS feedback
  FROM ({feedback_lines_of(_TEXT_PARTS)}) GROUP BY course_id"""))
def feedback_lines(spark, sf):
    # Stored first: the lines mention the findings several times, and the optimizer would put the whole check in for each.
    found = W.stored(validated(spark, sf).select("course_id", "findings"), W.shared_folder(spark) + "/findings")
    lines = found.select("course_id", P.feedback_lines(F.col("findings")).alias("lines"))
    return lines.where(F.size("lines") > 0).select("course_id", F.array_join("lines", "|").alias("feedback"))


_BY_SECTION = {
    "profile": (), "snapshot": ("salary_order", "overview_length", "heading_names_course"), "academics": ("timeline_steps", "year_sequence", "duplicate_subjects"),
    "outcomes": ("career_checks", "duplicate_recruiters"),
    "market": ("fee_not_annual", "fee_too_low", "fee_rows", "fee_spread", "fee_segmentation", "college_checks", "comparison_checks"),
    "guidance": ("intro_length", "source_checks"),
}
_UNPINNED = f"(SELECT k FROM {Q.PINS} WHERE pin IS NULL)"
_SCOPED = [
    *(f"SELECT k, course_id, '{s}' AS section, code, path, 'rule' AS source FROM ({p})" for s, names in _BY_SECTION.items() for n in names for p in Q.RULE_SQL[n][1]),
    # Quick facts are known to every section, but the duration of a pinned course is not.
    *(f"SELECT k, course_id, section, code, path, 'rule' FROM ({p}) CROSS JOIN (SELECT unnest({list(SECTIONS)}) AS section)"
      for n in ("quick_fee_range", "quick_fee_spread") for p in Q.RULE_SQL[n][1]),
    f"SELECT k, course_id, section, code, path, 'rule' FROM ({Q.RULE_SQL['duration_inverted'][1][0]}) CROSS JOIN (SELECT unnest({list(SECTIONS)}) AS section) WHERE k IN {_UNPINNED}",
    *(f"SELECT k, course_id, '{s}', code, path, 'rule' FROM ({Q.RULE_SQL[n][1][0]}) WHERE k IN {_UNPINNED}"
      for s, n in (("academics", "curriculum_length"), ("market", "total_below_annual"))),
    *(f"SELECT k, course_id, CASE WHEN starts_with(path, 'overview') THEN 'snapshot' ELSE 'guidance' END, code, path, 'rule' FROM ({p}) WHERE path <> 'extra_note'" for p in _TEXT_PARTS),
    # The structure, by owner; the years of subjects have their own limits where they are pinned.
    f"""SELECT k, course_id, section, code, path, 'schema' FROM ({" UNION ALL ".join(f"({p})" for n in Q.STRUCTURE_SQL for p in Q.STRUCTURE_SQL[n][1])})
      JOIN (VALUES {', '.join(f"('{p}', '{s}')" for s in SECTIONS for p in SECTIONS[s])}) o(property, section) ON property = regexp_extract(path, '^[a-z_]+')
      WHERE NOT (code IN ('minItems', 'maxItems') AND path = 'curriculum.years') AND NOT (code = 'maximum' AND starts_with(path, 'curriculum.years['))""",
    "SELECT k, course_id, 'market', 'required', '', 'schema' FROM dd WHERE k % 31 = 0",
    f"SELECT k, course_id, 'academics', 'minItems', 'curriculum.years', 'schema' FROM {Q.PINS} WHERE n < coalesce(pin, 1)",
    f"SELECT k, course_id, 'academics', 'maxItems', 'curriculum.years', 'schema' FROM {Q.PINS} WHERE n > coalesce(pin, 5)",
    f"""SELECT l.k, l.course_id, 'academics', 'maximum', 'curriculum.years[' || pos || '].year', 'schema'
      FROM {Q._LINE} l JOIN {Q.PINS} p ON p.k = l.k WHERE CASE WHEN l.k % 10 = 0 THEN slot ELSE pos + 1 END > coalesce(pin, 5)""",
]


@query("section_scope_findings", Q.with_("para intro src", "SELECT DISTINCT course_id, section, code, path, source FROM (" + " UNION ALL ".join(f"({p})" for p in _SCOPED) + ")"))
def section_scope_findings(spark, sf):
    """Every section of every document as a candidate, judged with what earlier sections have told."""
    v = F.col("v")
    told = A.carried_context(v)
    base = F.to_json(F.map_filter(as_object(v), lambda k, _: k.isin(*INJECTED)))
    parts = F.array(*[F.struct(F.lit(s).alias("section"), A.section_json(v, s).alias("candidate"), (base if i == 0 else told).alias("context")) for i, s in enumerate(SECTIONS)])
    parsed = F.try_parse_json("body")
    pinned = pinned_years(F.get_json_object("body", "$.course_name")).isNotNull()
    docs = V.json_documents(spark, sf).select("course_id", F.when(pinned, without(parsed, TYPICAL_DURATION)).otherwise(parsed).alias("v"))
    rows = unnest(docs.select("course_id", parts.alias("parts")), "parts", "course_id").select("course_id", "item.*")
    checked = P.validate_sections(rows, allowed_domains=Q.ALLOWED, academic_years=pinned_years(F.get_json_object("context", "$.course_name")))
    return P.findings_table(checked, "course_id", "section").select("course_id", "section", "code", "path", "source").distinct()
