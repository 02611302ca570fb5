"""Queries over documents: texts, structure, rules and reports."""

import re

from pyspark.sql import functions as F

from docwright.constants import CITATION_MARKER, HARD_PLACEHOLDERS, PROCESS_PHRASES, SOFT_PLACEHOLDERS
from docwright.functions import text as T
from docwright.functions.arrays import unnest
from docwright.functions.variants import nesting_depth, rewrite_strings, string_leaves
from docwright.operators import report as P
from docwright.operators import rules as R
from docwright.operators.structure import examine_columns, keyword_findings, properties_with
from docwright.plans import sql as Q
from docwright.plans import views as V
from docwright.plans.registry import query
from docwright.sources.tables import table


def text_view(spark, sf):
    """All texts with planted faults; the SQL is shared with the comparison."""
    texts = table(spark, sf, "documents", "doc_id", "text").unionByName(
        table(spark, sf, "conversations", "conv_id", "turn", "text").select(
            (F.lit(1000000000) + F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text"))
    i = F.col("doc_id")
    planted = F.concat(
        F.col("text"),
        F.when(i % 3 == 0, F.concat(F.lit(" ["), (i % 9).cast("string"), F.lit(", 12] ."))).otherwise(""),
        F.when(i % 50 == 1, " As an AI helper").otherwise(""),
        F.when(i % 20 == 1, " could not be found").otherwise(""),
        F.when(i % 40 == 3, " TBD ").otherwise(""),
    )
    return texts.select("doc_id", F.when(i % 100 == 0, "   ").otherwise(planted).alias("text"))


def _texts(body: str) -> str:
    return f"WITH t AS ({Q.TEXT_VIEW}) {body}"


# -- scalar expressions -----------------------------------------------------------

_CLEAN = Q.squeeze("translate(text, '—–’', '--' || chr(39))")


@query("clean_cell", _texts(f"SELECT doc_id, md5({_CLEAN}) AS cleaned FROM t"))
def clean_cell(spark, sf):
    return text_view(spark, sf).select("doc_id", F.md5(T.clean_cell(F.col("text"))).alias("cleaned"))


@query("slugify", _texts(f"SELECT doc_id, md5({Q.slug('text')}) AS slug FROM t"))
def slugify(spark, sf):
    return text_view(spark, sf).select("doc_id", F.md5(T.slugify(F.col("text"))).alias("slug"))


@query("discipline_key", f"SELECT p_partkey, coalesce({Q.slug('nullif(p_type, ' + chr(39) + 'PROMO' + chr(39) + ')')}, '') AS discipline FROM part")
def discipline_key(spark, sf):
    return table(spark, sf, "part", "p_partkey", "p_type").select(
        "p_partkey", T.discipline_key(F.nullif(F.col("p_type"), F.lit("PROMO"))).alias("discipline"))


@query("name_key", _texts(f"SELECT doc_id, md5({Q.fold(Q.squeeze('text'))}) AS name_key FROM t"))
def name_key(spark, sf):
    return text_view(spark, sf).select("doc_id", F.md5(T.name_key(F.col("text"))).alias("name_key"))


@query("word_count", _texts(f"SELECT doc_id, CAST({Q.words('text')} AS INTEGER) AS words FROM t"))
def word_count(spark, sf):
    return text_view(spark, sf).select("doc_id", T.word_count(F.col("text")).alias("words"))


_STRIPPED = (
    "SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, "
    r"'\s*\[[0-9]+(\s*[,;]\s*[0-9]+)*\]', '', 'g'), '[ \t]+([.,;:!?])', '\1', 'g'), '[ \t]{2,}', ' ', 'g'), "
    f"'^{Q.WS}+|{Q.WS}+$', '', 'g')) AS stripped")


@query("citation_marker_strip", _texts(_STRIPPED + " FROM t"))
def citation_marker_strip(spark, sf):
    return text_view(spark, sf).select("doc_id", F.md5(T.strip_citation_markers(F.col("text"))).alias("stripped"))


@query("citation_marker_strip_json", _texts(_STRIPPED + ", true AS rest_kept FROM t"))
def citation_marker_strip_json(spark, sf):
    """Texts deep inside documents that no schema knows; names, numbers and blanks around them stay as they are."""
    text = F.to_json(F.struct(F.col("text").alias("v")))
    rows = text_view(spark, sf).select("doc_id", F.concat(F.lit('[ {"see [1]":{"n":1.50,"deep":['), text, F.lit('],"x" : "a\\/b"} } ]')).alias("json"))
    done = rows.withColumn("json", rewrite_strings(F.col("json"), T.strip_citation_markers))
    rest = F.col("json").startswith('[ {"see [1]":{"n":1.50,"deep":[{') & F.col("json").endswith('}],"x" : "a\\/b"} } ]')
    return done.select("doc_id", F.md5(F.get_json_object("json", "$[0]['see [1]'].deep[0].v")).alias("stripped"), rest.alias("rest_kept"))


# -- text rules over every text, one pass --------------------------------------------

_B, _E = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def _re(alternatives: str) -> str:
    return f"regexp_matches(text, '(?i){alternatives}')"


def _any(patterns: tuple[str, ...]) -> str:
    """The fixed patterns in their order; only the word edge is spelled out, which the other engine knows for ASCII alone."""
    return _re("(?:" + "|".join(re.sub(r"\\b$", lambda _: _E, re.sub(r"^\\b", lambda _: _B, p)) for p in patterns) + ")")


_HARD, _SOFT, _PROCESS = _any(HARD_PLACEHOLDERS), _any(SOFT_PLACEHOLDERS), _any(PROCESS_PHRASES)
_CITE = f"regexp_matches(text, '{CITATION_MARKER}')"
_HYGIENE = {
    "blank_strings": [("blank_string", "error", f"NOT regexp_matches(text, '[^{Q.WS[1:-1]}]')")],
    "placeholder_findings": [("placeholder_text", "error", _HARD), ("possible_placeholder_text", "warning", f"NOT {_HARD} AND {_SOFT}")],
    "process_commentary": [("process_commentary", "error", _PROCESS)],
    "citation_marker_findings": [("citation_markers", "error", _CITE)],
}


def _hygiene_sql(*names):
    rows = " UNION ALL ".join(
        f"SELECT doc_id, '{code}' AS code, '{severity}' AS severity FROM t WHERE {test}"
        for n in names for code, severity, test in _HYGIENE[n])
    return _texts(rows)


def _hygiene(spark, sf, *rules):
    leaves = F.array(F.struct(F.lit("text").alias("path"), F.col("text").alias("value")))
    found = R.rule_findings(None, R.Context(leaves=leaves), R.subset(*rules))
    rows = text_view(spark, sf).select("doc_id", found.alias("findings"))
    return P.findings_table(rows, "doc_id").select("doc_id", "code", "severity")


for _name, _rule in (
    ("blank_strings", "no_blank_strings"), ("placeholder_findings", "no_placeholder_text"),
    ("process_commentary", "no_process_commentary"), ("citation_marker_findings", "no_citation_markers"),
):
    query(_name, _hygiene_sql(_name))(lambda spark, sf, rule=_rule: _hygiene(spark, sf, rule))


@query("text_hygiene_findings", f"SELECT code, severity, count(*) AS findings FROM ({_hygiene_sql(*_HYGIENE)}) GROUP BY code, severity")
def text_hygiene_findings(spark, sf):
    rules = [r.code for r in R.ALL_RULES if not r.requires]
    return _hygiene(spark, sf, *rules).groupBy("code", "severity").agg(F.count("*").alias("findings"))


# -- string leaves and paths -------------------------------------------------------------

@query("string_leaves", Q.with_("dd", """
  SELECT k, path, value FROM (
    SELECT k, 'course_name' AS path, name AS value FROM dd
    UNION ALL SELECT k, 'currency', 'INR' FROM dd
    UNION ALL SELECT k, 'colleges.ranking_source', 'Own ranking' FROM dd
    UNION ALL SELECT k, 'colleges.ranking_updated', CASE WHEN k % 12 = 7 THEN '2024-13' ELSE '2024-05' END FROM dd
    UNION ALL SELECT k, 'colleges.data_note', 'Figures describe the usual range for this course and are reviewed once in every year.' FROM dd
    UNION ALL SELECT k, 'extra_note', 'demo value' FROM dd WHERE k % 37 = 0
    UNION ALL SELECT k, 'colleges.items[' || pos || '].' || f, CASE f WHEN 'name' THEN s_name WHEN 'city' THEN 'Pune'
        WHEN 'course_name' THEN name WHEN 'institution_type' THEN CASE WHEN flag = 'R' THEN 'government' ELSE 'private' END
        WHEN 'admission_route' THEN 'Entrance test' WHEN 'highlight' THEN 'Large library' ELSE '12345' END
      FROM (SELECT nl.*, dd.name FROM nl JOIN dd ON dd.k = nl.k)
      CROSS JOIN (VALUES ('name'), ('city'), ('course_name'), ('institution_type'), ('admission_route'), ('highlight'), ('annual_fee')) v(f)
      WHERE f <> 'annual_fee' OR k % 41 = 0)"""))
def string_leaves_query(spark, sf):
    docs = V.json_documents(spark, sf, ("course_name", "currency", "colleges"))
    read = docs.select("k", string_leaves(F.try_parse_json("body"), nesting_depth(F.col("body"))).alias("leaves"))
    return unnest(read, "leaves", "k").select("k", "item.path", "item.value")


@query("path_presence", Q.with_("dd", """
  SELECT k, k % 31 <> 0 AS has_fees, true AS has_heading, k % 43 = 0 AS heading_is_null, k % 37 = 0 AS has_extra,
    CASE WHEN k % 43 = 0 THEN NULL WHEN k % 23 = 0 THEN 'What is this course?' ELSE 'What is ' || name || '?' END AS heading
  FROM dd"""))
def path_presence(spark, sf):
    docs = V.json_documents(spark, sf, ("course_name", "overview", "fees"))
    at = lambda path: F.try_variant_get(F.col("v"), path, "variant")
    return docs.select("k", F.try_parse_json("body").alias("v")).select(
        "k",
        at("$.fees").isNotNull().alias("has_fees"),
        at("$.overview.heading").isNotNull().alias("has_heading"),
        F.coalesce(F.is_variant_null(at("$.overview.heading")), F.lit(False)).alias("heading_is_null"),
        at("$.extra_note").isNotNull().alias("has_extra"),
        F.try_variant_get(F.col("v"), "$.overview.heading", "string").alias("heading"),
    )


# -- structure ------------------------------------------------------------------------------

def _structure(spark, sf, *codes):
    docs = V.json_documents(spark, sf, properties_with(*codes) if codes else V.ALL_PROPERTIES).withColumn("_variant", F.try_parse_json("body"))
    findings = keyword_findings("body", "_variant", *codes) if codes else examine_columns("body", "_variant")["findings"]
    found = docs.select("k", "course_id", findings.alias("findings"))
    return P.findings_table(found, "k", "course_id").select("k", "course_id", "code", "path")


for _name, _codes in (
    ("check_type", ("type",)), ("check_required", ("required",)), ("check_unknown_keys", ("additionalProperties",)),
    ("check_enum", ("enum",)), ("check_length", ("minLength", "maxLength")), ("check_pattern", ("pattern",)),
    ("check_bounds", ("minimum", "maximum")), ("check_item_count", ("minItems", "maxItems")),
    ("check_unique_items", ("uniqueItems",)),
):
    query(_name, Q.structure_sql(_name))(lambda spark, sf, codes=_codes: _structure(spark, sf, *codes))


@query("structural_findings", Q.structure_sql(*Q.STRUCTURE_SQL))
def structural_findings(spark, sf):
    return _structure(spark, sf)


# -- rules --------------------------------------------------------------------------------------

RULE_QUERIES = {
    "fee_not_annual": ("college_fee_looks_annual", ("college_fee_not_annual",)),
    "fee_too_low": ("college_fee_looks_annual", ("college_fee_implausibly_low",)),
    "duration_inverted": ("duration_ordering", None),
    "quick_fee_range": ("quick_fee_ordering", None),
    "salary_order": ("salary_ordering", None),
    "salary_marker_check": ("salary_marker_consistent", None),
    "overview_length": ("overview_length", None),
    "intro_length": ("parent_intro_length", None),
    "timeline_steps": ("timeline_steps", None),
    "year_sequence": ("curriculum_years", ("curriculum_years_not_sequential",)),
    "duplicate_subjects": ("curriculum_years", ("duplicate_subject",)),
    "curriculum_length": ("curriculum_length_matches_duration", None),
    "fee_rows": ("fee_rows", None),
    "fee_spread": ("fee_spread_forces_segmentation", ("fee_spread_too_wide",)),
    "fee_segmentation": ("fee_spread_forces_segmentation", ("fee_segmentation_incomplete",)),
    "quick_fee_spread": ("quick_fee_spread", None),
    "total_below_annual": ("total_programme_fee_sanity", None),
    "college_checks": ("college_ranking", None),
    "comparison_checks": ("comparison_anchor", None),
    "career_checks": ("career_route_mix", None),
    "duplicate_recruiters": ("recruiter_initials", None),
    "source_checks": ("sources_grounded", None),
    "heading_names_course": ("course_name_echo", None),
}


def pinned_years(name):
    """Taught years pinned by name, as the duration queries resolve them."""
    return F.when(name.contains("ring"), 3).when(name.startswith("small"), 4).cast("int")


def _rule(spark, sf, code, codes):
    rule = R.subset(code)
    needed = set(rule[0].requires) | ({"course_name"} if code == "curriculum_length_matches_duration" else set())
    docs = V.typed_documents(spark, sf, tuple(p for p in V.ALL_PROPERTIES if p in needed))
    years = pinned_years(F.col("doc.course_name")) if "course_name" in needed else F.lit(None).cast("int")
    context = R.Context(allowed_domains=Q.ALLOWED, academic_years=years)
    found = docs.select("k", "course_id", R.rule_findings(F.col("doc"), context, rule).alias("findings"))
    rows = P.findings_table(found, "k", "course_id").select("k", "course_id", "code", "path", "severity")
    return rows.where(F.col("code").isin(*codes)) if codes else rows


for _name, (_code, _codes) in RULE_QUERIES.items():
    query(_name, Q.rule_sql(_name))(lambda spark, sf, code=_code, codes=_codes: _rule(spark, sf, code, codes))
