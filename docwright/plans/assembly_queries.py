"""Queries over assembled documents, requests, responses and saved tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwright.constants import DERIVED_PATHS, SECTIONS
from docwright.functions import text as T
from docwright.functions.arrays import unnest
from docwright.operators import assembly as A
from docwright.operators import attempts as L
from docwright.operators import domains as D
from docwright.operators import report as R
from docwright.operators import responses as S
from docwright.operators import rules
from docwright.plans import catalogue_queries as C
from docwright.plans import run_queries as X
from docwright.plans import sql as Q
from docwright.plans import views as V
from docwright.plans.document_queries import RULE_QUERIES
from docwright.plans.registry import query
from docwright.sources import artifacts as W
from docwright.sources.snapshots import Snapshots
from docwright.sources.tables import table

_Q = Q.with_


# -- fields -----------------------------------------------------------------------------

@query("injected_fields", C._sql(f"""SELECT course_id, '{{"course_id":"' || course_id || '","slug":"' || {Q.slug('course_name')} || '","course_name":"' || course_name
  || '","currency":"INR","region":"India"' || CASE WHEN category = 'PROMO' THEN '' ELSE ',"category":"' || category || '"' END || '}}' AS fields FROM e"""))
def injected_fields(spark, sf):
    category = F.nullif(F.col("category"), F.lit("PROMO"))
    return C.entries(spark, sf).select("course_id", A.injected_fields(
        F.col("course_id"), F.col("course_name"), category, "INR", "India").alias("fields"))


_OWN = ", ".join(f"('{s}', '{'|'.join(sorted(names))}')" for s, names in SECTIONS.items())


@query("section_projection", _Q("dd", f"""SELECT course_id, section, CASE WHEN section = 'market' AND k % 31 = 0 THEN 'colleges|comparison' ELSE keys END AS keys
  FROM dd CROSS JOIN (VALUES {_OWN}) v(section, keys)"""))
def section_projection(spark, sf):
    docs = V.json_documents(spark, sf).select("course_id", F.try_parse_json("body").alias("v"))
    parts = F.array(*[F.struct(F.lit(s).alias("section"), A.section_json(F.col("v"), s).alias("json")) for s in SECTIONS])
    rows = unnest(docs.select("course_id", parts.alias("parts")), "parts", "course_id").select("course_id", "item.*")
    return rows.select("course_id", "section", F.array_join(F.array_sort(F.json_object_keys("json")), "|").alias("keys"))


def sections(spark, sf):
    """Section payloads of orders, with gaps, an old version and a payload that is no object."""
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    k = F.col("o_orderkey")
    rows = o.select("o_orderkey", "o_custkey", F.posexplode(F.array(*[F.lit(s) for s in SECTIONS])).alias("rank", "section"))
    rows = rows.where((k + F.col("rank")) % 5 != 0)
    first = F.element_at(F.create_map(*[F.lit(x) for s, names in SECTIONS.items() for x in (s, names[0])]), F.col("section"))
    payload = lambda version: F.concat(F.lit('{"'), first, F.lit(f'":{{"version":"{version}","n":'), F.col("o_custkey").cast("string"), F.lit("}}"))
    versions = rows.select(
        F.concat(F.lit("crs_"), k.cast("string")).alias("course_id"), "section", "rank",
        F.explode(F.array(
            F.struct(F.lit(1).alias("ts"), payload("old").alias("payload")),
            F.struct(F.lit(2).alias("ts"), F.when(k % 50 == 9, "[3]").otherwise(payload("new")).alias("payload")),
        )).alias("version"))
    return versions.select("course_id", "section", "version.*")


_FIRST = ", ".join(f"({i}, '{s}', '{names[0]}')" for i, (s, names) in enumerate(SECTIONS.items()))
_SECT = f"""sect AS (SELECT 'crs_' || o_orderkey AS course_id, o_orderkey AS k, rank, section, (o_orderkey + rank) % 5 <> 0 AS there,
  CASE WHEN o_orderkey % 50 = 9 THEN '[3]' ELSE '{{"' || prop || '":{{"version":"new","n":' || o_custkey || '}}}}' END AS payload,
  '"' || prop || '":{{"n":' || o_custkey || ',"version":"new"}}' AS member, prop FROM orders CROSS JOIN (VALUES {_FIRST}) v(rank, section, prop))"""


@query("latest_section", f"WITH {_SECT} SELECT course_id, section, payload, 2 AS ts FROM sect WHERE there")
def latest_section(spark, sf):
    return A.latest_sections(sections(spark, sf))


@query("section_merge", f"""WITH {_SECT} SELECT course_id, '{{' || array_to_string(list_sort(list_concat(['"course_id":"' || course_id || '"'],
    coalesce(list(member) FILTER (there AND k % 50 <> 9), []))), ',') || '}}' AS body,
  coalesce(array_to_string(list(section ORDER BY rank) FILTER (NOT (there AND k % 50 <> 9)), '|'), '') AS missing_sections FROM sect GROUP BY course_id, k""")
def section_merge(spark, sf):
    base = table(spark, sf, "orders", "o_orderkey").select(F.concat(F.lit("crs_"), F.col("o_orderkey").cast("string")).alias("course_id"))
    base = base.withColumn("fields", F.to_json(F.struct("course_id")))
    merged = A.merge_sections(base, A.latest_sections(sections(spark, sf)))
    return merged.select("course_id", F.to_json(F.parse_json("body")).alias("body"), F.array_join("missing_sections", "|").alias("missing_sections"))


@query("section_readback", f"WITH {_SECT} SELECT course_id, section, payload FROM sect WHERE there AND k % 50 <> 9 AND section = 'market'")
def section_readback(spark, sf):
    path = W.write(A.latest_sections(sections(spark, sf)), W.shared_folder(spark), "sections", "2024-01-31", append=False)
    return W.sections(spark, path, section="market").select("course_id", "section", "payload")


# -- derived fields -----------------------------------------------------------------------

def _pinned(name):
    years = F.when(name.contains("ring"), 3).when(name.startswith("small"), 4)
    return F.when(years.isNotNull(), F.struct(
        years.cast("double").alias("min_years"), (years + 0.5).alias("max_years"), years.alias("academic_years")))


_PIN = "(SELECT *, CASE WHEN name LIKE '%ring%' THEN 3 WHEN name LIKE 'small%' THEN 4 END AS pin FROM dd)"


@query("duration_overlay", _Q("dd", f"SELECT course_id, coalesce(pin, ymin) AS min_years, coalesce(pin + 0.5::DOUBLE, ymax) AS max_years FROM {_PIN}"))
def duration_overlay(spark, sf):
    docs = V.typed_documents(spark, sf, ("course_name", "quick_facts"))
    return docs.select("course_id", A.overlay_duration(F.col("doc"), _pinned(F.col("doc.course_name"))).alias("d")).select(
        "course_id", "d.quick_facts.typical_duration.*")


@query("source_dedupe", _Q("src", """SELECT course_id, array_to_string(list(url ORDER BY j), '|') AS urls FROM (
  SELECT course_id, url, min(j) AS j FROM src GROUP BY course_id, url) GROUP BY course_id"""))
def source_dedupe(spark, sf):
    docs = V.typed_documents(spark, sf, ("verification",))
    unique = A.distinct_sources(F.col("doc.verification.sources"))
    return docs.select("course_id", F.array_join(F.transform(unique, lambda s: s["url"]), "|").alias("urls"))


@query("review_date", _Q("dd", "SELECT course_id, '2024-05-07' AS last_reviewed FROM dd"))
def review_date(spark, sf):
    docs = V.typed_documents(spark, sf, ("snapshot", "verification"))
    return docs.select("course_id", A.derived_fields(F.col("doc"), F.lit("2024-05-07").cast("date")).alias("d")).select(
        "course_id", "d.verification.last_reviewed")


@query("salary_marker", _Q("dd", f"""SELECT course_id, CAST(CASE WHEN s_high > s_low THEN greatest(0, least(100, {Q._POS})) WHEN k % 2 = 0 THEN 50 ELSE {Q._MARK} END AS BIGINT) AS marker_percent FROM dd"""))
def salary_marker(spark, sf):
    docs = V.typed_documents(spark, sf, ("snapshot",))
    salary = F.col("doc.snapshot.salary").withField("marker_percent", F.when(~V.every(2), F.col("doc.snapshot.salary.marker_percent")))
    return docs.select("course_id", A.marker_percent(salary).alias("marker_percent"))


@query("strip_derived", _Q("dd", "SELECT course_id, false AS marker_left, false AS review_left, s_low AS lower_annual FROM dd"))
def strip_derived(spark, sf):
    docs = V.typed_documents(spark, sf, ("snapshot", "verification"))
    doc = A.strip_derived(F.col("doc"), [p for paths in DERIVED_PATHS.values() for p in paths])
    keys = lambda c: F.json_object_keys(F.to_json(c))
    return docs.select("course_id", doc.alias("d")).select(
        "course_id", F.array_contains(keys(F.col("d.snapshot.salary")), "marker_percent").alias("marker_left"),
        F.array_contains(keys(F.col("d.verification")), "last_reviewed").alias("review_left"), "d.snapshot.salary.lower_annual")


@query("strip_pinned_duration", _Q("dd", f"SELECT course_id, CASE WHEN pin IS NULL THEN ymin END AS min_years FROM {_PIN}"))
def strip_pinned_duration(spark, sf):
    docs = V.typed_documents(spark, sf, ("course_name", "quick_facts"))
    facts = A.strip_pinned_duration(F.col("doc.quick_facts"), _pinned(F.col("doc.course_name")).isNotNull())
    return docs.select("course_id", facts["typical_duration"]["min_years"].alias("min_years"))


_MARKS = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({0} || ' [4] .', '\s*\[[0-9]+(\s*[,;]\s*[0-9]+)*\]', '', 'g'),
  '[ \t]+([.,;:!?])', '\1', 'g'), '[ \t]{{2,}}', ' ', 'g'), '^{1}+|{1}+$', '', 'g')"""


@query("document_marker_strip", f"""SELECT doc_id, md5(array_to_string(list_transform(string_split(text, chr(10)), lambda x: {_MARKS.format('x', Q.WS)}), '|')) AS paragraphs,
  md5({_MARKS.format('text', Q.WS)}) AS intro FROM documents""")
def document_marker_strip(spark, sf):
    text = F.concat(F.col("text"), F.lit(" [4] ."))
    lines = F.transform(F.split("text", "\n"), lambda x: F.concat(x, F.lit(" [4] .")))
    docs = table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.struct(
        F.struct(lines.alias("paragraphs")).alias("overview"), F.struct(text.alias("intro"), F.lit(1).alias("n")).alias("parent_corner")).alias("doc"))
    clean = docs.select("doc_id", A.map_strings(F.col("doc"), docs.schema["doc"].dataType, T.strip_citation_markers).alias("d"))
    return clean.select("doc_id", F.md5(F.array_join("d.overview.paragraphs", "|")).alias("paragraphs"), F.md5("d.parent_corner.intro").alias("intro"))


@query("carry_context", _Q("dd", """SELECT course_id, 'category|course_name|quick_facts|region' AS keys, name AS course_name FROM dd"""))
def carry_context(spark, sf):
    docs = V.json_documents(spark, sf, ("course_id", "course_name", "category", "region", "seo", "quick_facts"))
    told = docs.select("course_id", A.carried_context(F.try_parse_json("body")).alias("context"))
    return told.select("course_id", F.array_join(F.array_sort(F.json_object_keys("context")), "|").alias("keys"),
                       F.get_json_object("context", "$.course_name").alias("course_name"))


@query("curriculum_pin", _Q("dd", """SELECT d.course_id, CASE WHEN d.k % 7 NOT BETWEEN 1 AND 5 THEN 'pin_outside_schema' END AS fault,
  d.n = d.k % 7 AND m.top <= d.k % 7 AS fits FROM dd d JOIN (SELECT k, max(CASE WHEN k % 10 = 0 THEN slot ELSE pos + 1 END) AS top FROM nl GROUP BY k) m ON m.k = d.k"""))
def curriculum_pin(spark, sf):
    docs = V.typed_documents(spark, sf, ("curriculum",))
    years = F.col("k") % 7
    return docs.select("course_id", A.pin_fault(years).alias("fault"), A.fits_pin(F.col("doc.curriculum.years"), years).alias("fits"))


# -- requests -----------------------------------------------------------------------------

def given_sections(spark, sf):
    """Accepted sections of the catalogue's courses. Some are missing or no object, and some of later rank give a carried key anew."""
    e = unique_courses(spark, sf).select("course_id", "ord", F.posexplode(F.array(*map(F.lit, SECTIONS))).alias("i", "section"))
    n, i = F.col("ord"), F.col("i")
    own = F.format_string('{"course_level":"Diploma","subcategory":"S%d","quick_facts":{"n":%d},"seo":{}}', n % 7, n)
    payload = (
        F.when((i == 0) & (n % 50 == 9), "[3]").when(i == 0, own)
        .when((i == 1) & (n % 15 == 2), '{"category":"Changed","overview":{}}')
        .when((i == 4) & (n % 10 == 3), F.format_string('{"quick_facts":{"n":-%d}}', n)).otherwise('{"course_id":"other"}'))
    return e.where((n + i) % 4 != 0).select("course_id", "section", payload.alias("payload"))


def unique_courses(spark, sf):
    """The first course of each id; names of one slug share theirs."""
    names = ("course_name", "category")
    first = C.entries(spark, sf).groupBy("course_id").agg(F.min(F.struct("ord", *names)).alias("first"))
    return first.select("course_id", "first.*")


def course_fields(spark, sf):
    category = F.nullif(F.col("category"), F.lit("PROMO"))
    return unique_courses(spark, sf).select("course_id", "ord", A.injected_fields(
        F.col("course_id"), F.col("course_name"), category, "INR", "India").alias("fields"))


def plan(spark, sf):
    courses = C.entries(spark, sf).withColumn("duration", _pinned(F.col("course_name")))
    resolved = D.resolved(D.capped(C.remaining(spark, sf)))
    return A.request_plan(courses, resolved, "INR", "India", A.contexts(course_fields(spark, sf), given_sections(spark, sf)), "year")


def _told(before: str) -> str:
    """The context in SQL; `before` says which section (its rank in place of {0}) has given what it has."""
    gave = lambda i: f"((e.ord + {i}) % 4 <> 0 AND {before.format(i)})"
    profile = f"({gave(0)} AND e.ord % 50 <> 9)"
    facts = f"CASE WHEN {gave(4)} AND e.ord % 10 = 3 THEN -e.ord WHEN {profile} THEN e.ord END"
    return f"""'{{' || CASE WHEN {gave(1)} AND e.ord % 15 = 2 THEN '"category":"Changed",' WHEN e.category = 'PROMO' THEN '' ELSE '"category":"' || e.category || '",' END
      || CASE WHEN {profile} THEN '"course_level":"Diploma",' ELSE '' END || '"course_name":"' || e.course_name || '"'
      || coalesce(',"quick_facts":{{"n":' || ({facts}) || '}}', '') || ',"region":"India"' || CASE WHEN {profile} THEN ',"subcategory":"S' || (e.ord % 7) || '"' ELSE '' END || '}}'"""


_UNIQUE = "(SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY course_id ORDER BY ord) = 1) e"
_RANKED = ", ".join(f"('{s}', {i})" for i, s in enumerate(SECTIONS))


@query("section_contexts", C._sql(f"SELECT course_id, section, {_told('{0} < i')} AS context FROM {_UNIQUE} CROSS JOIN (VALUES {_RANKED}) v(section, i)"))
def section_contexts(spark, sf):
    return A.contexts(course_fields(spark, sf), given_sections(spark, sf))


@query("resume_contexts", C._sql(f"""SELECT course_id, section, {_told('({0} < i OR NOT ({0} = e.ord % 6 OR {0} = (e.ord + 2) % 6))')} AS context
  FROM {_UNIQUE} CROSS JOIN (VALUES {_RANKED}) v(section, i) WHERE i IN (e.ord % 6, (e.ord + 2) % 6)"""))
def resume_contexts(spark, sf):
    """Two sections of each course are made again: they see all the others, and the second sees the first."""
    again = F.filter(F.array(*map(F.lit, SECTIONS)), lambda s, i: (i == F.col("ord") % 6) | (i == (F.col("ord") + 2) % 6))
    return A.contexts(course_fields(spark, sf), given_sections(spark, sf), again)


_PLAN = f"""{C._ENTRIES}, {C._CASCADE[len(''):]}, dom AS (SELECT discipline, section, count(*) FILTER (kept) AS n FROM cap GROUP BY ALL),
plan AS (SELECT course_id, v.section, wanted, CAST(coalesce(n, -1) AS INTEGER) AS n_domains, coalesce(n, 0) > 0 AS search_filtered,
    CASE WHEN pin IS NULL THEN NULL WHEN v.section = 'profile' THEN '- The duration is fixed already; leave it out.'
      WHEN v.section = 'academics' THEN '- The course runs ' || pin || ' to ' || pin || '.5 years with ' || pin || ' taught years: give exactly ' || pin || ' curriculum entries.' END AS constraint_line
  FROM (SELECT *, CASE WHEN course_name LIKE '%ring%' THEN 3 WHEN course_name LIKE 'small%' THEN 4 END AS pin FROM e)
  CROSS JOIN (VALUES {", ".join(f"('{s}', '{', '.join(names)}')" for s, names in SECTIONS.items())}) v(section, wanted)
  LEFT JOIN dom ON dom.discipline = CASE WHEN e_discipline(discipline) IN (SELECT discipline FROM dom) THEN e_discipline(discipline) ELSE 'default' END AND dom.section = v.section)""".replace("e_discipline(discipline)", '"unnamed_subquery".discipline')
_PLAN = _PLAN.replace("THEN 4 END AS pin FROM e)", "THEN 4 END AS pin FROM e) en").replace('"unnamed_subquery".discipline', "en.discipline")


@query("request_plan", f"""WITH {_PLAN} SELECT course_id, section, wanted AS wanted_keys, n_domains, search_filtered, constraint_line, 'year' AS recency, context
  FROM plan JOIN (SELECT course_id, section, {_told('{0} < i')} AS context FROM {_UNIQUE} CROSS JOIN (VALUES {_RANKED}) v(section, i)) USING (course_id, section)""")
def request_plan(spark, sf):
    return plan(spark, sf).select(
        "course_id", "section", "recency", "context", "wanted_keys", F.coalesce(F.size("domains"), F.lit(-1)).alias("n_domains"), "search_filtered", "constraint_line")


_ATT_PARTS = X._ATT


@query("repair_plan", f"""WITH {_ATT_PARTS}, lastf AS (SELECT course_id, section, max(attempt) AS attempt, arg_max(code, attempt) AS code FROM used WHERE NOT passed GROUP BY ALL)
  SELECT 'crs_' || p_partkey AS course_id, section, attempt, '- <root>: ' || code AS failure_lines,
    CASE section WHEN 'profile' THEN '- The duration is fixed already; leave it out.'
      WHEN 'academics' THEN '- The course runs 3 to 3.5 years with 3 taught years: give exactly 3 curriculum entries.' END AS constraint_line
  FROM part JOIN lastf ON course_id = 'crs_' || p_partkey""")
def repair_plan(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_name")
    courses = part.select(F.concat(F.lit("crs_"), F.col("p_partkey").cast("string")).alias("course_id"), F.col("p_name").alias("course_name"),
                          F.lit("medium").alias("discipline"), _pinned(F.lit("ring")).alias("duration"))
    requests = A.request_plan(courses, D.resolved(D.capped(C.remaining(spark, sf))), "INR", "India")
    log = X.used(spark, sf).where(~F.col("passed"))
    rejected = log.groupBy("course_id", "section").agg(
        F.max("attempt").alias("attempt"), F.max_by("usage", "attempt").alias("previous_output"),
        F.concat(F.lit("- <root>: "), F.max_by("code", "attempt")).alias("failure_lines"))
    return A.repair_plan(requests, rejected).select("course_id", "section", "attempt", "failure_lines", "constraint_line")


# -- responses ------------------------------------------------------------------------------

def responses(spark, sf):
    """One raw body per conversation turn, with every way a response can be unusable."""
    t = table(spark, sf, "conversations", "conv_id", "turn", "text")
    i = F.col("conv_id") * 100 + F.col("turn")
    whole = F.when(i % 29 == 0, "[1,2]").otherwise(F.to_json(F.struct("text")))
    data = F.when(i % 11 == 0, F.substr(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    content = F.when(i % 3 == 0, F.concat(F.lit("```json\n"), data, F.lit("\n```"))).otherwise(data)
    quoted = lambda c: F.regexp_replace(F.to_json(F.struct(c.alias("v"))), r"(?s)^\{\"v\":(.*)\}\z", "$1")
    url = lambda n: F.concat(F.lit('{"url":"https://u'), n.cast("string"), F.lit('.example/"}'))
    search = F.concat(F.lit('{"type":"search_results","results":['), F.concat_ws(",", url(i % 5), url(i % 5 + 1), url(i % 5), F.lit('{"url":7}'), F.lit("3")), F.lit("]}"))
    message = F.concat(F.lit('{"type":"message","content":['), F.when(i % 23 == 0, "").otherwise(F.concat(
        F.lit('{"text":'), quoted(F.substr(content, F.lit(1), F.lit(10))), F.lit('},{"note":1},{"text":'), quoted(F.substr(content, F.lit(11))), F.lit("}"))), F.lit("]}"))
    body = F.concat(F.lit('{"output":['), F.when(i % 13 == 0, "").otherwise(F.concat_ws(",", search, message)),
                    F.lit('],"status":"'), F.when(i % 17 == 0, "incomplete").otherwise("completed"), F.lit('","usage":{"n":'), i.cast("string"), F.lit("}}"))
    return t.select(
        i.alias("id"), F.concat(F.lit("crs_"), F.col("conv_id").cast("string")).alias("course_id"),
        F.element_at(F.array(*[F.lit(s) for s in SECTIONS]), (F.col("turn") % 6 + 1).cast("int")).alias("section"),
        (F.col("turn") + 1).cast("int").alias("attempt"),
        F.when(i % 19 == 0, "[1]").when(i % 31 == 0, "{oops").otherwise(body).alias("body"))


_RESP = f"""r AS (SELECT conv_id * 100 + turn AS id, 'crs_' || conv_id AS course_id, {list(SECTIONS)}[turn % 6 + 1] AS section, CAST(turn + 1 AS INTEGER) AS attempt, text FROM conversations),
c AS (SELECT *, CASE WHEN id % 19 = 0 OR id % 31 = 0 THEN 'not_an_object' WHEN id % 13 = 0 THEN 'no_output' WHEN id % 23 = 0 THEN 'no_text'
  WHEN id % 17 = 0 THEN 'unfinished' WHEN id % 11 = 0 THEN 'invalid_json' WHEN id % 29 = 0 THEN 'not_an_object_value' END AS rejected FROM r)"""


@query("response_parse", f"WITH {_RESP} SELECT id, md5(text) AS content FROM c WHERE rejected IS NULL")
def response_parse(spark, sf):
    return S.accepted(S.parse(responses(spark, sf))).select("id", F.md5(F.get_json_object("data", "$.text")).alias("content"))


@query("response_rejects", f"WITH {_RESP} SELECT id, rejected FROM c WHERE rejected IS NOT NULL")
def response_rejects(spark, sf):
    return S.dead_letters(S.parse(responses(spark, sf))).select("id", "rejected")


@query("citation_extract", f"WITH {_RESP} SELECT id, 'https://u' || (id % 5) || '.example/|https://u' || (id % 5 + 1) || '.example/' AS citations FROM c WHERE rejected IS NULL")
def citation_extract(spark, sf):
    return S.accepted(S.parse(responses(spark, sf))).select("id", F.array_join("citations", "|").alias("citations"))


@query("billed_failures", f"""WITH {_RESP} SELECT course_id, section, attempt, 'provider_output' AS code, 0 AS citations,
  CASE WHEN rejected <> 'not_an_object' THEN '{{"n":' || id || '}}' END AS usage FROM c WHERE rejected IS NOT NULL""")
def billed_failures(spark, sf):
    return S.billed_failures(S.parse(responses(spark, sf))).withColumn("citations", F.size("citations")).drop("passed", "transport_error")


# -- sinks -----------------------------------------------------------------------------------

@query("write_artifacts", X._a("SELECT course_id, section, attempt, passed, DATE '2024-01-31' AS run_date FROM used"))
def write_artifacts(spark, sf):
    path = W.write(X.used(spark, sf).select("course_id", "section", "attempt", "passed"), W.shared_folder(spark), "attempts", "2024-01-31", append=False)
    return spark.read.parquet(path)


_SOME_RULES = {n: code for n, (code, _) in RULE_QUERIES.items() if code in ("duration_ordering", "salary_ordering", "college_ranking")}
_MADE = " UNION ALL ".join(f"SELECT '{name}' AS artifact, course_id FROM {rows}" for name, rows in {
    "attempts": "used", "sections": "oc WHERE status = 'accepted'", "documents": "dd", "runs": "(SELECT DISTINCT course_id FROM o)",
    "findings": "(" + " UNION ALL ".join(f"({p})" for n in _SOME_RULES for p in Q.RULE_SQL[n][1]) + ")"}.items())


@query("artifact_tables", Q.with_("dd", "").rstrip() + f""", {X._ATT}, made AS ({_MADE})
  SELECT artifact, course_id, CASE WHEN CAST(substr(course_id, 5) AS BIGINT) % 3 = 0 THEN 2 ELSE 1 END AS run, count(*) AS n FROM made GROUP BY ALL""")
def artifact_tables(spark, sf):
    """The five tables of a run: saved for all courses, saved again for a third of them, and read back."""
    docs = V.json_documents(spark, sf, ("course_name", "quick_facts", "snapshot", "colleges"))
    findings = R.findings_table(R.validate(docs, rules=rules.subset(*_SOME_RULES.values()), structural=False), "course_id")
    outcomes = X.reduced(spark, sf)
    tables = {
        "attempts": (X.used(spark, sf).select("course_id", "section", "attempt", "passed"), "course_id string, section string, attempt int, passed boolean"),
        "sections": (outcomes.where("status = 'accepted'").select("course_id", "section", "citations"), "course_id string, section string, citations array<string>"),
        "documents": (docs.select("course_id", "body"), "course_id string, body string"),
        "runs": (outcomes.groupBy("course_id").agg(F.sum("attempts").alias("attempts")), "course_id string, attempts long"),
        "findings": (findings.select("course_id", "code", "path", "severity"), "course_id string, code string, path string, severity string"),
    }
    root, again = W.shared_folder(spark), F.substr("course_id", F.lit(5)).cast("long") % 3 == 0
    saved = []
    for name, (frame, schema) in tables.items():
        store = Snapshots(spark, f"{root}/{name}", f"{schema}, run int")
        W.save(store, frame.withColumn("run", F.lit(1)), "course_id")
        W.save(store, frame.where(again).withColumn("run", F.lit(2)), "course_id")
        saved.append(store.read().groupBy("course_id", "run").agg(F.count(F.lit(1)).alias("n")).withColumn("artifact", F.lit(name)))
    return reduce(DataFrame.unionByName, saved)
