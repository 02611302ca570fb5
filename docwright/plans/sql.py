"""Shared pieces of the comparison SQL: the same derived inputs, as flat rows."""

CTES = {
    # The lines of every order, folded to slots.
    "li": """li AS (
  SELECT l_orderkey AS k, CAST(l_linenumber % 16 AS BIGINT) AS slot,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber % 16) - 1 AS pos,
    min(l_suppkey) AS sk, min(l_partkey) AS pk,
    max(CAST(floor(l_extendedprice) AS BIGINT)) * CASE WHEN l_orderkey % 53 = 0 THEN 100 ELSE 1 END AS fee,
    min(CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT)) AS lo,
    max(CAST(floor(l_extendedprice * (1 + l_tax)) AS BIGINT)) AS hi,
    min(l_returnflag) AS flag, max(l_linestatus) AS st
  FROM lineitem GROUP BY l_orderkey, l_linenumber % 16)""",
    "nl": """nl AS (
  SELECT li.*, p_name, p_type, p_brand, s_name
  FROM li JOIN part ON pk = p_partkey JOIN supplier ON sk = s_suppkey)""",
    # One row per document.
    "dd": """dd AS (
  SELECT g.*, o_custkey AS cust, o_totalprice AS total, o_orderstatus AS status,
    'crs_' || CAST(k AS VARCHAR) AS course_id,
    fee_sum // n AS fee_avg, CASE WHEN k % 13 = 0 THEN 0 ELSE lowest END AS fee_min,
    CASE WHEN k % 17 = 0 THEN fee_sum // n WHEN k % 13 = 0 THEN 0 ELSE lowest END AS qmin,
    CASE WHEN k % 17 <> 0 THEN fee_sum // n WHEN k % 13 = 0 THEN 0 ELSE lowest END AS qmax,
    1 + (k % 9) / 2 AS ymin, 1 + (o_custkey % 9) / 2 AS ymax,
    CAST(floor(o_totalprice * 0.5) AS BIGINT) AS s_low, fee_sum AS s_typ,
    CASE WHEN k % 61 = 0 THEN CAST(floor(o_totalprice * 0.5) AS BIGINT)
      ELSE CAST(floor(o_totalprice * 1.5) AS BIGINT) * CASE WHEN k % 59 = 0 THEN 100 ELSE 1 END END AS s_high
  FROM (SELECT k, count(*) AS n, CAST(sum(fee) AS BIGINT) AS fee_sum, min(lo) AS lowest,
      min_by(p_name, pos) AS name, min_by(p_type, pos) AS type, min_by(p_brand, pos) AS brand
    FROM nl GROUP BY k) g
  JOIN orders ON o_orderkey = k)""",
    # The sources of every document.
    "src": """src AS (
  SELECT dd.k, dd.course_id, j, url FROM dd
  CROSS JOIN range(0, 4) r(j) CROSS JOIN (SELECT count(*) AS np FROM pages)
  JOIN pages ON page_id = (dd.k + CASE WHEN dd.k % 29 = 0 THEN 0 ELSE j END) % np)""",
    # Paragraphs of the overview and the parent introduction.
    "para": """para AS (
  SELECT dd.k, dd.course_id, doc_id, text AS body FROM dd
  CROSS JOIN (SELECT count(*) AS nd FROM documents) JOIN documents ON doc_id = dd.k % nd)""",
    "intro": """intro AS (
  SELECT dd.k, dd.course_id, text AS body FROM dd
  CROSS JOIN (SELECT count(*) AS nd FROM documents) JOIN documents ON doc_id = dd.cust % nd)""",
}
NEEDS = {"nl": ("li",), "dd": ("li", "nl"), "src": ("li", "nl", "dd"), "para": ("li", "nl", "dd"), "intro": ("li", "nl", "dd")}


def with_(names: str, body: str) -> str:
    """body behind the named CTEs and all they rest on."""
    wanted = set(names.split())
    for name in list(wanted):
        wanted |= set(NEEDS.get(name, ()))
    return "WITH " + ",\n".join(CTES[n] for n in CTES if n in wanted) + "\n" + body


WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = r"[\p{L}\p{N}_](?:[\p{L}\p{N}\p{M}_''’-]*[\p{L}\p{N}_])?"

# Text with planted faults, the same in both engines.
TEXT_VIEW = """
  SELECT doc_id, CASE WHEN doc_id % 100 = 0 THEN '   ' ELSE concat(text,
    CASE WHEN doc_id % 3 = 0 THEN concat(' [', doc_id % 9, ', 12] .') ELSE '' END,
    CASE WHEN doc_id % 50 = 1 THEN ' As an AI helper' ELSE '' END,
    CASE WHEN doc_id % 20 = 1 THEN ' could not be found' ELSE '' END,
    CASE WHEN doc_id % 40 = 3 THEN ' TBD ' ELSE '' END) END AS text
  FROM (SELECT doc_id, text FROM documents UNION ALL
        SELECT 1000000000 + conv_id * 1000 + turn AS doc_id, text FROM conversations) AS every_text"""


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def slug(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', '-', 'g'), '-')"


def fold(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '{WORD}'))"


# -- rules over documents, as rows (k, course_id, code, path, severity) ---------------

_FREQ = "CASE slot % 5 WHEN 0 THEN 'Per year' WHEN 1 THEN 'Per semester' WHEN 2 THEN 'One time' WHEN 3 THEN 'Total programme' ELSE 'As required' END"
ROW = f"""(SELECT d.k, d.course_id, d.qmax, pos, 'fees.rows[' || pos || ']' AS path,
    CASE flag WHEN 'A' THEN 'government' WHEN 'R' THEN 'private' END AS itype,
    CASE WHEN pk % 11 <> 0 THEN CASE WHEN sk % 13 = 0 THEN 0 ELSE lo END END AS rmin,
    CASE WHEN pk % 7 <> 0 THEN hi * CASE WHEN d.k % 53 = 0 THEN 100 ELSE 1 END END AS rmax,
    st = 'F' AS variable, {_FREQ} AS frequency
  FROM nl JOIN dd d ON d.k = nl.k WHERE d.k % 31 <> 0)"""
STEP = "CASE WHEN nl.k % 10 = 0 THEN slot ELSE pos + 1 END"
HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\.', '')"


def _f(code: str, path: str, source: str, where: str, severity: str = "error") -> str:
    return f"SELECT k, course_id, '{code}' AS code, {path} AS path, '{severity}' AS severity FROM {source} WHERE {where}"


_COL = """(SELECT d.*, pos, slot, s_name, flag, CASE WHEN d.k % 41 <> 0 THEN fee END AS afee,
    'colleges.items[' || pos || '].annual_fee' AS path FROM nl JOIN dd d ON d.k = nl.k)"""
_FLOOR = "CASE WHEN flag = 'R' THEN 500 ELSE 5000 END"
_SEQ = """(SELECT d.k, d.course_id, '[' || string_agg({step}, ',' ORDER BY pos) || ']' AS steps FROM nl JOIN dd d ON d.k = nl.k GROUP BY d.k, d.course_id
    HAVING bool_or({step} <> pos + 1))"""
_TYPES = "(SELECT d.k, d.course_id, bool_or(flag = 'R') AS gov, bool_or(flag <> 'R') AS priv FROM nl JOIN dd d ON d.k = nl.k GROUP BY d.k, d.course_id)"
_SUBJ = """(SELECT k, course_id, path, pos, j, subject, row_number() OVER (PARTITION BY k, lower(subject) ORDER BY pos, j) AS nth
    FROM (SELECT d.k, d.course_id, pos, j, 'curriculum.years[' || pos || '].subjects[' || j || '].name' AS path,
      CASE j WHEN 0 THEN p_name WHEN 1 THEN p_name || ' laboratory' WHEN 2 THEN p_type || ' theory ' || slot
        ELSE 'Project ' || (pk % 10) END AS subject
      FROM nl JOIN dd d ON d.k = nl.k CROSS JOIN range(0, 4) r(j)))"""
_CMP = "(SELECT nl.k, 'crs_' || nl.k AS course_id, pos, p_name, CASE WHEN pos = 0 AND nl.k % 19 = 0 THEN p_name || ' honours' ELSE p_name END AS cn FROM nl)"
_BADGE = "(flag = 'A' OR (flag = 'N' AND st <> 'O'))"
_HEAD = "(SELECT k, course_id, name, CASE WHEN k % 43 = 0 THEN NULL WHEN k % 23 = 0 THEN 'What is this course?' ELSE 'What is ' || name || '?' END AS heading FROM dd)"
_BY = "(SELECT nl.k, 'crs_' || nl.k AS course_id, {agg} FROM nl GROUP BY nl.k)"
_POS = "round_even((s_typ - s_low) / (s_high - s_low) * 100.0, 0)"
_MARK = f"CASE WHEN k % 4 = 0 THEN CASE WHEN s_high <> s_low THEN greatest(0, least(100, {_POS})) ELSE 50 END ELSE k % 101 END"
PINS = "(SELECT dd.*, CASE WHEN name LIKE '%ring%' THEN 3 WHEN name LIKE 'small%' THEN 4 END AS pin FROM dd)"
_EXPECT = "coalesce(pin, greatest(floor(ymin), least(ceil(ymax), 5)))"
ALLOWED = ("example.com", "example.org")
_OFF = " AND ".join(f"h <> '{a}' AND NOT ends_with(h, '.{a}')" for a in ALLOWED)
_SRC = f"(SELECT *, {HOST} AS h, 'verification.sources[' || j || '].url' AS path FROM src)"

RULE_SQL = {
    "fee_not_annual": ("dd", [_f("college_fee_not_annual", "path", _COL, "afee > 0 AND qmax > 0 AND afee > 2.0 * qmax")]),
    "fee_too_low": ("dd", [_f("college_fee_implausibly_low", "path", _COL, f"afee > 0 AND qmax > 0 AND afee <= 2.0 * qmax AND afee < {_FLOOR}")]),
    "duration_inverted": ("dd", [_f("duration_inverted", "'quick_facts.typical_duration'", "dd", "ymin > ymax")]),
    "quick_fee_range": ("dd", [
        _f("fee_range_inverted", "'quick_facts.indicative_annual_fees'", "dd", "qmin > qmax"),
        _f("fee_out_of_range", "'quick_facts.indicative_annual_fees.max'", "dd", "qmax > 5000000")]),
    "salary_order": ("dd", [
        _f("salary_not_ordered", "'snapshot.salary'", "dd", "NOT (s_low <= s_typ AND s_typ <= s_high)"),
        _f("salary_range_degenerate", "'snapshot.salary'", "dd", "s_low = s_high"),
        _f("salary_out_of_range", "'snapshot.salary.higher_annual'", "dd", "s_high > 20000000")]),
    "salary_marker_check": ("dd", [_f("salary_marker_mismatch", "'snapshot.salary.marker_percent'", "dd",
                                      f"s_high <> s_low AND abs({_POS} - ({_MARK})) > 2")]),
    "overview_length": ("para", [_f("overview_length", "'overview.paragraphs'", "para", f"NOT {words('body')} BETWEEN 140 AND 260")]),
    "intro_length": ("intro", [_f("parent_intro_length", "'parent_corner.intro'", "intro", f"NOT {words('body')} BETWEEN 110 AND 220")]),
    "timeline_steps": ("dd", [_f("timeline_steps_not_sequential", "'eligibility.admission_timeline'", _SEQ.format(step="slot"), "true")]),
    "year_sequence": ("dd", [_f("curriculum_years_not_sequential", "'curriculum.years'", _SEQ.format(step=STEP), "true")]),
    "duplicate_subjects": ("dd", [_f("duplicate_subject", "path", _SUBJ, "nth > 1")]),
    "curriculum_length": ("dd", [_f("curriculum_length_mismatch", "'curriculum.years'", PINS, f"n <> {_EXPECT}")]),
    "fee_rows": ("dd", [
        _f("variable_fee_half_range", "path", ROW, "variable AND (rmin IS NULL) <> (rmax IS NULL)"),
        _f("fee_range_missing", "path", ROW, "NOT variable AND (rmin IS NULL OR rmax IS NULL)"),
        _f("fee_range_inverted", "path", ROW, "rmin > rmax"),
        _f("fee_out_of_range", "path || '.max'", ROW, "rmin IS NOT NULL AND rmax > 5000000")]),
    "fee_spread": ("dd", [_f("fee_spread_too_wide", "path", ROW,
                             "NOT variable AND itype IS NULL AND rmax > 0 AND (rmin = 0 OR rmax / rmin > 20)")]),
    "fee_segmentation": ("dd", [_f("fee_segmentation_incomplete", "'fees.rows'",
                                   f"(SELECT k, course_id, max(itype) AS itype FROM {ROW} GROUP BY k, course_id HAVING count(DISTINCT itype) = 1)", "true")]),
    "quick_fee_spread": ("dd", [_f("quick_fee_spread_too_wide", "'quick_facts.indicative_annual_fees'", "dd",
                                   "qmax > 0 AND (qmin = 0 OR qmax / qmin > 25)")]),
    "total_below_annual": ("dd", [_f("total_below_annual", "path || '.max'", ROW,
                                     "frequency = 'Total programme' AND itype IS NULL AND qmax > 0 AND rmax < qmax")]),
    "college_checks": ("dd", [
        _f("college_ranks_not_sequential", "'colleges.items'", _SEQ.format(step=STEP), "true"),
        _f("college_type_missing", "'colleges.items'", _TYPES, "NOT gov"),
        _f("college_type_missing", "'colleges.items'", _TYPES, "NOT priv"),
        _f("duplicate_college", "'colleges.items'",
           "(SELECT d.k, d.course_id, lower(s_name) AS college FROM nl JOIN dd d ON d.k = nl.k GROUP BY d.k, d.course_id, s_name HAVING count(*) > 1)", "true"),
        _f("college_fee_out_of_range", "path", _COL, "afee > 5000000")]),
    "comparison_checks": ("nl", [
        _f("comparison_anchor_mismatch", "'comparison[0].course_name'", _CMP, "pos = 0 AND k % 19 = 0"),
        _f("comparison_duplicate_course", "'comparison'",
           f"(SELECT k, course_id FROM {_CMP} GROUP BY k, course_id HAVING count(DISTINCT cn) < count(*))", "true")]),
    "career_checks": ("nl", [
        _f("careers_no_direct_entry", "'careers'", _BY.format(agg=f"bool_or({_BADGE}) AS direct"), "NOT direct", "warning"),
        _f("careers_no_advanced_route", "'careers'", _BY.format(agg=f"bool_and({_BADGE}) AS direct"), "direct", "warning"),
        _f("duplicate_career", "'careers'", _BY.format(agg="count(DISTINCT p_name) < count(*) AS again"), "again")]),
    "duplicate_recruiters": ("nl", [_f("duplicate_recruiter", "'recruiters'", _BY.format(agg="count(DISTINCT s_name) < count(*) AS again"), "again")]),
    "source_checks": ("src", [
        _f("source_not_https", "path", _SRC, "NOT starts_with(lower(url), 'https:')"),
        _f("source_off_domain", "path", _SRC, _OFF),
        _f("sources_single_host", "'verification.sources'",
           f"(SELECT k, course_id FROM {_SRC} GROUP BY k, course_id HAVING count(DISTINCT h) = 1 AND count(*) > 2)", "true", "warning")]),
    "heading_names_course": ("dd", [_f("overview_heading_missing_course", "'overview.heading'", _HEAD,
                                       "NOT contains(lower(heading), lower(name))")]),
}


def rule_sql(name: str) -> str:
    needs, parts = RULE_SQL[name]
    return with_(needs, " UNION ALL ".join(f"({p})" for p in parts))


# -- structural checks, as rows (k, course_id, code, path) ------------------------------

def _g(code: str, path: str, source: str, where: str) -> str:
    return f"SELECT k, course_id, '{code}' AS code, {path} AS path FROM {source} WHERE {where}"


_PARA = """(SELECT k, course_id, 'overview.paragraphs[' || (i - 1) || ']' AS path, string_split(body, chr(10))[i] AS p
    FROM (SELECT k, course_id, body, unnest(range(1, len(string_split(body, chr(10))) + 1)) AS i FROM para))"""
_LINE = "(SELECT d.k, d.course_id, nl.* EXCLUDE (k) FROM nl JOIN dd d ON d.k = nl.k)"
_NPAR = "(SELECT k, course_id, len(string_split(body, chr(10))) AS n FROM para)"


def _sizes(path: str, low: int, high: int, source: str = "dd", size: str = "n"):
    return (
        [_g("minItems", f"'{path}'", source, f"{size} < {low}")],
        [_g("maxItems", f"'{path}'", source, f"{size} > {high}")],
    )


_LISTS = [
    _sizes("careers", 6, 6), _sizes("recruiters", 6, 6), _sizes("colleges.items", 6, 6),
    _sizes("curriculum.years", 1, 5), _sizes("eligibility.admission_timeline", 5, 5),
    _sizes("comparison", 3, 3),
    _sizes("fees.rows", 4, 8, "(SELECT * FROM dd WHERE k % 31 <> 0)"),
    _sizes("overview.paragraphs", 3, 3, _NPAR),
]
_RANK = "CASE WHEN k % 10 = 0 THEN slot ELSE pos + 1 END"

STRUCTURE_SQL = {
    "check_type": ("dd", [
        _g("type", "'colleges.items[' || pos || '].annual_fee'", _LINE, "k % 41 = 0"),
        _g("type", "'overview.heading'", "dd", "k % 43 = 0")]),
    "check_required": ("dd", [_g("required", "''", "dd", "k % 31 = 0")]),
    "check_unknown_keys": ("dd", [_g("additionalProperties", "''", "dd", "k % 37 = 0")]),
    "check_enum": ("dd", [_g("enum", "'course_level'", "dd", "k % 6 = 5")]),
    "check_length": ("para intro", [
        _g("minLength", "path", _PARA, "len(p) < 120"), _g("maxLength", "path", _PARA, "len(p) > 600"),
        _g("minLength", "'parent_corner.intro'", "intro", "len(body) < 620"),
        _g("maxLength", "'parent_corner.intro'", "intro", "len(body) > 1400")]),
    "check_pattern": ("src", [
        _g("pattern", "'colleges.ranking_updated'", "dd", "k % 12 = 7"),
        _g("pattern", "'recruiters[' || pos || '].logo_initials'", _LINE, "sk % 9 = 0"),
        _g("pattern", "'verification.sources[' || j || '].url'", "src", "NOT starts_with(url, 'https://')")]),
    "check_bounds": ("dd", [
        _g("maximum", "'hero.fit.score_percent'", "dd", "k % 120 > 100 AND k % 47 <> 0"),
        _g("maximum", "'eligibility.admission_timeline[' || pos || '].step'", _LINE, "slot > 5"),
        _g("minimum", "'eligibility.admission_timeline[' || pos || '].step'", _LINE, "slot < 1"),
        _g("maximum", "'curriculum.years[' || pos || '].year'", _LINE, f"{_RANK} > 5"),
        _g("minimum", "'curriculum.years[' || pos || '].year'", _LINE, f"{_RANK} < 1"),
        _g("maximum", "'colleges.items[' || pos || '].rank'", _LINE, f"{_RANK} > 6"),
        _g("minimum", "'colleges.items[' || pos || '].rank'", _LINE, f"{_RANK} < 1"),
        _g("maximum", "'snapshot.salary.higher_annual'", "dd", "s_high > 100000000")]),
    "check_item_count": ("para", [part for low, high in _LISTS for part in low + high]),
    "check_unique_items": ("dd", [
        _g("uniqueItems", "'quick_facts.suitable_streams'", "dd", "k % 7 = 3"),
        _g("uniqueItems", "'recruiters[' || pos || '].roles'", _LINE, "sk % 8 = 5")]),
}


def structure_sql(*names: str) -> str:
    needs = " ".join(STRUCTURE_SQL[n][0] for n in names)
    return with_(needs, " UNION ALL ".join(f"({p})" for n in names for p in STRUCTURE_SQL[n][1]))
