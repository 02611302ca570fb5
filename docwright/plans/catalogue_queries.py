"""Queries over the catalogue and the two registries."""

from pyspark.sql import functions as F

from docwright.constants import SECTIONS
from docwright.functions import text as T
from docwright.functions.numbers import default_taught_years
from docwright.operators import catalogue as C
from docwright.operators import domains as D
from docwright.operators import durations as U
from docwright.plans import sql as Q
from docwright.plans.registry import query
from docwright.sources import registries as G
from docwright.sources.tables import table


# -- catalogue --------------------------------------------------------------------

def sheet(spark, sf):
    """Raw catalogue rows of the part table, with blank cells and odd headers."""
    part = table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type")
    i = F.col("p_partkey")
    return part.select(
        i.alias("ord"),
        F.when(i % 101 != 0, F.col("p_type")).alias(" Category "),
        F.concat(F.col("p_name"), F.lit("  — "), F.col("p_brand"), F.when(i % 97 == 0, "!").otherwise("")).alias("Course  Name"),
    )


def entries(spark, sf):
    return C.courses(C.rows(sheet(spark, sf)))


_ROWS = """rows_ AS (SELECT p_partkey AS ord, p_type AS category,
  p_name || ' - ' || p_brand || CASE WHEN p_partkey % 97 = 0 THEN '!' ELSE '' END AS course_name
  FROM part WHERE p_partkey % 101 <> 0)"""
_ENTRIES = f"""{_ROWS}, seen AS (SELECT course_name, category, min(ord) AS ord FROM rows_ GROUP BY ALL),
e AS (SELECT *, regexp_replace(left('crs_' || replace(slug, '-', '_'), 64), '_+$', '') AS course_id, {Q.slug('category')} AS discipline
  FROM (SELECT course_name, min(ord) AS ord, list(category ORDER BY ord) AS categories, arg_min(category, ord) AS category,
  regexp_replace(left({Q.slug('course_name')}, 80), '-+$', '') AS slug FROM seen GROUP BY course_name))"""


def _sql(body):
    return f"WITH {_ENTRIES} {body}"


@query("catalogue_rows", f"WITH {_ROWS} SELECT * FROM rows_")
def catalogue_rows(spark, sf):
    return C.rows(sheet(spark, sf))


@query("catalogue_dedupe", _sql("SELECT course_name, ord, category, array_to_string(categories, '|') AS categories, discipline FROM e"))
def catalogue_dedupe(spark, sf):
    return entries(spark, sf).select(
        "course_name", "ord", "category", F.array_join("categories", "|").alias("categories"), "discipline")


@query("course_ids", _sql(f"SELECT course_name, slug, course_id, 'crs_' || replace({Q.slug('course_name')}, '-', '_') AS default_id FROM e"))
def course_ids(spark, sf):
    return entries(spark, sf).select("course_name", "slug", "course_id", T.default_course_id(F.col("course_name")).alias("default_id"))


@query("slug_collisions", _sql("""SELECT kind, value, count(*) AS courses FROM (
  SELECT 'slug' AS kind, slug AS value FROM e UNION ALL SELECT 'course_id', course_id FROM e)
  GROUP BY kind, value HAVING count(*) > 1 OR (kind = 'slug' AND value = '')"""))
def slug_collisions(spark, sf):
    return C.collisions(entries(spark, sf))


@query("category_order", _sql("""SELECT category, ord AS first_ord, CAST(pos AS INTEGER) AS first_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY ord, pos) AS n FROM (
    SELECT ord, unnest(categories) AS category, unnest(range(0, len(categories))) AS pos FROM e)) WHERE n = 1"""))
def category_order(spark, sf):
    return C.categories(entries(spark, sf))


@query("discipline_filter", _sql("SELECT course_id, ord FROM e WHERE list_contains(categories, 'MEDIUM') ORDER BY ord LIMIT 25"))
def discipline_filter(spark, sf):
    return C.of_discipline(entries(spark, sf), "Medium", 25).select("course_id", "ord")


@query("catalogue_summary", _sql("""SELECT 'all' AS category, count(*) AS courses, count(*) FILTER (len(categories) > 1) AS multi_category,
  count(*) * 6 AS planned_calls FROM e
  UNION ALL SELECT category, count(*), NULL, NULL FROM (SELECT unnest(categories) AS category FROM e) GROUP BY category"""))
def catalogue_summary(spark, sf):
    every = entries(spark, sf)
    total = C.summary(every).withColumn("category", F.lit("all"))
    return total.unionByName(C.per_category(every), allowMissingColumns=True)


@query("undeclared_disciplines", _sql("""SELECT DISTINCT discipline FROM e WHERE discipline NOT IN
  (SELECT DISTINCT CASE page_id % 7 WHEN 0 THEN 'economy' WHEN 1 THEN 'large' WHEN 2 THEN 'medium' WHEN 3 THEN 'promo' WHEN 4 THEN 'small' ELSE 'nautical' END FROM pages)"""))
def undeclared_disciplines(spark, sf):
    return C.undeclared(entries(spark, sf), D.declared(rules(spark, sf)))


def requests(spark, sf):
    """Names asked for, in another case, some of them unknown."""
    part = table(spark, sf, "part", "p_partkey", "p_name", "p_brand")
    name = F.concat(F.lit(" "), F.upper("p_name"), F.lit(" - "), F.col("p_brand"), F.when(F.col("p_partkey") % 5 == 0, " x").otherwise(""))
    return part.select(F.col("p_partkey").alias("req_pos"), name.alias("name"))


_REQ = """q AS (SELECT p_partkey AS req_pos, ' ' || upper(p_name) || ' - ' || p_brand || CASE WHEN p_partkey % 5 = 0 THEN ' x' ELSE '' END AS name FROM part),
k AS (SELECT lower(trim(name)) AS key, min(req_pos) AS req_pos, arg_min(name, req_pos) AS name, count(*) AS times FROM q GROUP BY 1)"""


@query("name_lookup", _sql("") .rstrip() + f""", {_REQ}
  SELECT req_pos, course_id, course_name, true AS found, k.times FROM k JOIN e ON lower(course_name) = key
  UNION ALL SELECT req_pos, NULL, name, false, times FROM k WHERE key NOT IN (SELECT lower(course_name) FROM e)""")
def name_lookup(spark, sf):
    every, asked = entries(spark, sf), requests(spark, sf)
    found = C.lookup(every, asked).withColumn("found", F.lit(True)).join(
        C._requests(asked).select("req_pos", "times"), "req_pos")
    missing = C.lookup_misses(every, asked).select("req_pos", F.col("name").alias("course_name"), F.lit(False).alias("found"), "times")
    return found.unionByName(missing, allowMissingColumns=True)


@query("stratified_sample", _sql("""SELECT course_id, discipline, CAST(r AS INTEGER) AS round FROM (
  SELECT * FROM (
    (SELECT course_id, discipline, 0 AS r, 0 AS a, ord AS sp FROM e WHERE ord % 500 = 3 ORDER BY ord LIMIT 40)
    UNION ALL
    (SELECT course_id, discipline, row_number() OVER (PARTITION BY discipline ORDER BY ord), 1, 0 FROM e
     WHERE course_id NOT IN (SELECT course_id FROM e WHERE ord % 500 = 3 ORDER BY ord LIMIT 40)))
  ORDER BY a, sp, r, discipline LIMIT 40)"""))
def stratified_sample(spark, sf):
    every = entries(spark, sf)
    seeds = every.where(F.col("ord") % 500 == 3).select("course_id", "discipline", F.col("ord").alias("seed_pos"))
    return C.stratified_sample(every, 40, seeds).select("course_id", "discipline", "round")


# -- durations -----------------------------------------------------------------------

EXACT = [("Small  Ring", 3.0, 4.0, None), ("RED widget", 5.5, 5.5, 4), ("blue bolt", 2.0, 2.5, None)]
PATTERNS = [
    {"match": r"^small\b", "min_years": 1, "max_years": 2},
    {"match": r"ring|bolt", "min_years": 3, "max_years": 3, "academic_years": 3},
    {"match": r"^(red|blue)", "min_years": 4, "max_years": 4.5},
    {"match": r"small|red|anvil", "min_years": 6, "max_years": 7},
]
_RESOLVE = """r AS (SELECT p_partkey, p_name, CASE
    WHEN p_name = 'small ring' THEN {'lo': 3.0, 'hi': 4.0, 'y': 4, 's': 'exact:small ring'}
    WHEN p_name = 'red widget' THEN {'lo': 5.5, 'hi': 5.5, 'y': 4, 's': 'exact:red widget'}
    WHEN p_name = 'blue bolt' THEN {'lo': 2.0, 'hi': 2.5, 'y': 3, 's': 'exact:blue bolt'}
    WHEN p_name LIKE 'small %' THEN {'lo': 1.0, 'hi': 2.0, 'y': 2, 's': 'pattern:^small\\b'}
    WHEN p_name LIKE '%ring%' OR p_name LIKE '%bolt%' THEN {'lo': 3.0, 'hi': 3.0, 'y': 3, 's': 'pattern:ring|bolt'}
    WHEN p_name LIKE 'red%' OR p_name LIKE 'blue%' THEN {'lo': 4.0, 'hi': 4.5, 'y': 5, 's': 'pattern:^(red|blue)'}
    WHEN p_name LIKE '%small%' OR p_name LIKE '%red%' OR p_name LIKE '%anvil%' THEN {'lo': 6.0, 'hi': 7.0, 'y': 6, 's': 'pattern:small|red|anvil'}
  END AS d FROM part)"""


def durations(spark, sf):
    exact = spark.createDataFrame(EXACT, "name string, min_years double, max_years double, academic_years int")
    names = table(spark, sf, "part", "p_partkey", "p_name")
    return U.resolve(names, exact, PATTERNS, "p_name")


@query("taught_years_default", """SELECT p_partkey, CAST(greatest(floor(lo), least(ceil(hi), 5)) AS INTEGER) AS years
  FROM (SELECT p_partkey, p_size / 10 AS lo, p_size / 10 + (p_partkey % 9) / 2 AS hi FROM part)""")
def taught_years_default(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_size")
    low = F.col("p_size") / 10
    return part.select("p_partkey", default_taught_years(low, low + F.col("p_partkey") % 9 / 2).alias("years"))


@query("duration_entry_checks", """SELECT p_partkey, CASE WHEN lo IS NULL OR hi IS NULL THEN 'not_numeric'
    WHEN lo <= 0 OR hi < lo THEN 'impossible_span'
    WHEN taught IS NULL OR NOT taught BETWEEN 1 AND 5 THEN 'taught_years_out_of_range'
    WHEN taught > ceil(hi) THEN 'taught_years_above_span' END AS fault
  FROM (SELECT *, CASE WHEN y IS NULL THEN CAST(greatest(floor(lo), least(ceil(hi), 5)) AS INTEGER)
      WHEN regexp_full_match(y, '-?[0-9]+') THEN CAST(y AS INTEGER) END AS taught
    FROM (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE (p_size - 3) / 10 END AS lo,
      CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE (p_partkey % 60) / 10 END AS hi,
      CASE p_partkey % 4 WHEN 0 THEN CAST(p_partkey % 7 AS VARCHAR) WHEN 1 THEN '2.5' END AS y FROM part))""")
def duration_entry_checks(spark, sf):
    i = F.col("p_partkey")
    raw = table(spark, sf, "part", "p_partkey", "p_size").select(
        "p_partkey",
        F.when(i % 13 == 0, "long").otherwise(((F.col("p_size") - 3) / 10).cast("string")).alias("lo"),
        F.when(i % 17 != 0, (i % 60 / 10).cast("string")).alias("hi"),
        F.when(i % 4 == 0, (i % 7).cast("string")).when(i % 4 == 1, "2.5").alias("years"),
    )
    return raw.select("p_partkey", U.reject_reason(F.col("lo"), F.col("hi"), F.col("years")).alias("fault"))


@query("duration_table_checks", """SELECT lower(p_name || ' ' || p_brand) AS subject, 'repeated' AS fault, count(*) AS entries
    FROM part GROUP BY 1 HAVING count(*) > 1
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 19 = 0 THEN 'missing' ELSE 'control_character' END, 1
    FROM part WHERE p_partkey % 19 = 0 OR p_partkey % 23 = 0""")
def duration_table_checks(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_name", "p_brand")
    i = F.col("p_partkey")
    exact = part.select(F.concat(F.upper("p_name"), F.lit("  "), F.col("p_brand")).alias("name"))
    repeated = U.repeated_names(exact).select(F.col("name_key").alias("subject"), F.lit("repeated").alias("fault"), "entries")
    pattern = F.when(i % 19 != 0, F.concat(F.col("p_name"), F.when(i % 23 == 0, "\b").otherwise("$")))
    faults = part.select(i.cast("string").alias("subject"), U.pattern_fault(pattern).alias("fault"), F.lit(1).cast("bigint").alias("entries"))
    return repeated.unionByName(faults.where(F.col("fault").isNotNull()))


@query("duration_resolve", f"WITH {_RESOLVE} SELECT p_partkey, CAST(d.lo AS DOUBLE) AS min_years, CAST(d.hi AS DOUBLE) AS max_years, d.y AS academic_years FROM r")
def duration_resolve(spark, sf):
    return durations(spark, sf).select("p_partkey", "duration.min_years", "duration.max_years", "duration.academic_years")


@query("duration_source", f"WITH {_RESOLVE} SELECT p_partkey, d.s AS source FROM r WHERE d IS NOT NULL")
def duration_source(spark, sf):
    return durations(spark, sf).where(F.col("duration").isNotNull()).select("p_partkey", "duration.source")


@query("duration_coverage", f"""WITH {_RESOLVE} SELECT count(*) AS courses, count(d) AS pinned, count(*) - count(d) AS unpinned,
  CASE WHEN count(*) > count(d) THEN 'warn' ELSE 'ok' END AS status FROM r""")
def duration_coverage(spark, sf):
    return U.coverage(durations(spark, sf))


@query("duration_table_load", """SELECT p_partkey, 'exact' AS kind, lower(p_name) AS name, CAST(NULL AS INTEGER) AS rank, p_size / 10 AS min_years FROM part
  UNION ALL SELECT p_partkey, 'pattern', '^' || p_name, CAST(j AS INTEGER), j + 1 FROM part CROSS JOIN range(0, 2) r(j)""")
def duration_table_load(spark, sf):
    part = table(spark, sf, "part", "p_partkey", "p_name", "p_size")
    text = F.format_string(
        '{"exact":{"%s ":{"min_years":%s,"max_years":9}},"patterns":[{"match":"^%s","min_years":1,"max_years":2},{"match":"^%s","min_years":2,"max_years":2}]}',
        F.upper("p_name"), (F.col("p_size") / 10).cast("string"), F.col("p_name"), F.col("p_name"))
    files = part.select("p_partkey", text.alias("value"))
    exact = G.exact_durations(files, "p_partkey").select("p_partkey", F.lit("exact").alias("kind"), "name", F.lit(None).cast("int").alias("rank"), "min_years")
    patterns = G.pattern_durations(files, "p_partkey").select(
        "p_partkey", F.lit("pattern").alias("kind"), F.col("match").alias("name"), F.col("rank").cast("int").alias("rank"), "min_years")
    return exact.unionByName(patterns)


# -- domains -------------------------------------------------------------------------------

DISCIPLINES = ("economy", "large", "medium", "promo", "small", "nautical", "default")
GROUPS = tuple(SECTIONS) + ("_all",)
_PICK = lambda values, at: "CASE " + at + "".join(f" WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"
_HOST = r"regexp_extract(lower(url), '^[a-z]+://(?:www\.)?([^/?#:]*)', 1)"
_RULES = f"""rules AS (SELECT {_PICK(DISCIPLINES, 'page_id % 7')} AS discipline, {_PICK(GROUPS, '(page_id // 7) % 7')} AS section, page_id AS pos,
  CASE WHEN page_id % 5 = 0 THEN '-' ELSE '' END || 'p' || (page_id % 3) || '.' || {_HOST} AS domain FROM pages)"""
_CASCADE = f"""{_RULES}, first AS (SELECT discipline, section, domain, min(pos) AS pos FROM rules GROUP BY ALL),
secs AS (SELECT unnest({list(SECTIONS)}) AS section), discs AS (SELECT discipline FROM rules UNION SELECT 'default'),
layers AS (SELECT d.discipline, s.section, f.domain, f.pos,
    CASE WHEN f.discipline = 'default' THEN 3 ELSE 1 END + CASE WHEN f.section = '_all' THEN 1 ELSE 0 END AS layer
  FROM discs d CROSS JOIN secs s JOIN first f ON f.discipline IN (d.discipline, 'default') AND f.section IN (s.section, '_all')
  UNION ALL SELECT discipline, section, u.domain, u.pos, 6 FROM discs CROSS JOIN secs CROSS JOIN
    (VALUES ('p0.gov.example', 0), ('edu.example', 1)) u(domain, pos)
  UNION ALL SELECT discipline, b.section, b.domain, b.pos, 5 FROM discs CROSS JOIN
    (VALUES ('market', 'fees.example', 0), ('market', '-edu.example', 1), ('academics', 'edu.example', 0), ('academics', 'p0.gov.example', 1)) b(section, domain, pos)),
best AS (SELECT discipline, section, domain, CAST(layer AS INTEGER) AS layer, pos FROM (SELECT *, row_number() OVER (PARTITION BY discipline, section, domain ORDER BY layer, pos) AS n FROM layers) WHERE n = 1),
rest AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM best x WHERE x.discipline = b.discipline AND x.section = b.section AND x.domain = '-' || b.domain)),
cap AS (SELECT *, row_number() OVER (PARTITION BY discipline, section ORDER BY layer, pos, domain) <= 20 AS kept FROM rest)"""
FALLBACK = ("https://P0.gov.example/x", "edu.example", "p0.gov.example")
BUILT_IN = {"market": ("https://fees.example/list", "-edu.example", "fees.example"), "academics": ("www.edu.example", "P0.gov.example"), "guidance": ()}


def rules(spark, sf):
    i = F.col("page_id")
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), (at % len(values) + 1).cast("int"))
    host = T.normalize_domain(F.col("url"))
    return table(spark, sf, "pages", "page_id", "url").select(
        pick(DISCIPLINES, i).alias("discipline"), pick(GROUPS, F.floor(i / 7)).alias("section"), i.alias("pos"),
        F.concat(F.when(i % 5 == 0, "-").otherwise(""), F.lit("p"), (i % 3).cast("string"), F.lit("."), host).alias("domain"))


def remaining(spark, sf):
    return D.without_excluded(D.cascade(rules(spark, sf), FALLBACK, BUILT_IN))


@query("normalize_domain", rf"""SELECT page_id, CASE WHEN page_id % 11 = 0 THEN '-' ELSE '' END || {_HOST} AS domain FROM pages""")
def normalize_domain(spark, sf):
    i = F.col("page_id")
    pasted = F.concat(F.when(i % 11 == 0, " -").otherwise("  "), F.when(i % 2 == 0, F.upper("url")).otherwise(F.col("url")), F.lit("\t"))
    return table(spark, sf, "pages", "page_id", "url").select("page_id", T.normalize_domain(pasted).alias("domain"))


@query("domain_list_dedupe", rf"""SELECT page_id, {_HOST} || '|-' || {_HOST} || '|x.example' AS domains FROM pages""")
def domain_list_dedupe(spark, sf):
    listed = F.array(F.col("url"), F.lit(" "), F.upper("url"), F.concat(F.lit("-"), F.col("url")), F.lit("user@X.example:8080"), F.lit("http://www.x.example?a=b"))
    return table(spark, sf, "pages", "page_id", "url").select(
        "page_id", F.array_join(T.normalize_domains(listed), "|").alias("domains"))


@query("domain_table_load", rf"""SELECT page_id, 'a-b' AS discipline, 'market' AS section, CAST(j AS INTEGER) AS pos,
  CASE j WHEN 0 THEN {_HOST} ELSE 'x.example' END AS domain FROM pages CROSS JOIN range(0, 2) r(j)
  UNION ALL SELECT page_id, 'default', '_all', 0, '-' || {_HOST} FROM pages""")
def domain_table_load(spark, sf):
    text = F.format_string('{"A & B":{"market":["%s","x.example","%s"]},"default":{"_all":["-%s"]}}', "url", "url", "url")
    files = table(spark, sf, "pages", "page_id", "url").select("page_id", text.alias("value"))
    return G.domain_rules(files, "page_id")


@query("domain_table_checks", """SELECT page_id, discipline, section, CASE WHEN page_id % 4 = 1 THEN 'unknown_section'
    WHEN page_id % 4 = 2 THEN 'not_a_list' ELSE 'not_text' END AS fault
  FROM (SELECT page_id, 'd' || (page_id % 10) AS discipline, CASE WHEN page_id % 4 = 1 THEN 'prices' ELSE 'market' END AS section FROM pages)
  WHERE page_id % 4 <> 0""")
def domain_table_checks(spark, sf):
    i = F.col("page_id")
    value = F.when(i % 4 == 2, F.to_json(F.struct("url"))).when(i % 4 == 3, F.concat(F.lit("["), i.cast("string"), F.lit("]"))).otherwise(F.to_json(F.array("url")))
    raw = table(spark, sf, "pages", "page_id", "url").select(
        "page_id", F.concat(F.lit("d"), (i % 10).cast("string")).alias("discipline"),
        F.when(i % 4 == 1, "prices").otherwise("market").alias("section"), F.parse_json(value).alias("value"))
    faults = D.check(raw.withColumn("discipline", F.concat_ws("#", "page_id", "discipline")))
    parts = F.split("discipline", "#")
    return faults.select(parts[0].cast("bigint").alias("page_id"), parts[1].alias("discipline"), "section", "fault")


@query("domain_cascade", f"WITH {_CASCADE} SELECT discipline, section, domain, layer, pos FROM best")
def domain_cascade(spark, sf):
    return D.cascade(rules(spark, sf), FALLBACK, BUILT_IN)


@query("domain_exclusions", f"WITH {_CASCADE} SELECT discipline, section, domain FROM best EXCEPT SELECT discipline, section, domain FROM rest")
def domain_exclusions(spark, sf):
    every = D.cascade(rules(spark, sf), FALLBACK, BUILT_IN)
    left = D.without_excluded(every)
    return every.join(left.select("discipline", "section", "domain"), ["discipline", "section", "domain"], "left_anti").select(
        "discipline", "section", "domain")


@query("domain_cap", f"WITH {_CASCADE} SELECT discipline, section, domain, kept FROM cap")
def domain_cap(spark, sf):
    return D.capped(remaining(spark, sf)).select("discipline", "section", "domain", "kept")


@query("domain_resolved", f"""WITH {_CASCADE} SELECT discipline, section, array_to_string(list(domain ORDER BY layer, pos, domain) FILTER (kept), '|') AS domains,
  count(*) FILTER (NOT kept) AS dropped FROM cap GROUP BY discipline, section""")
def domain_resolved(spark, sf):
    return D.resolved(D.capped(remaining(spark, sf))).withColumn("domains", F.array_join("domains", "|"))


@query("domain_layers", f"""WITH {_CASCADE} SELECT discipline, section, array_to_string(list(DISTINCT layer ORDER BY layer), '|') AS layers
  FROM best GROUP BY discipline, section""")
def domain_layers(spark, sf):
    return D.layers_used(D.cascade(rules(spark, sf), FALLBACK, BUILT_IN)).withColumn("layers", F.array_join(F.col("layers").cast("array<string>"), "|"))


@query("allowlist", f"WITH {_RULES} SELECT DISTINCT domain FROM rules WHERE domain NOT LIKE '-%' UNION SELECT unnest(['p0.gov.example', 'edu.example', 'fees.example'])")
def allowlist(spark, sf):
    return D.allowlist(rules(spark, sf), FALLBACK, BUILT_IN)


@query("domain_report", f"""WITH {_CASCADE} SELECT discipline, section, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS dropped,
  CASE WHEN count(*) FILTER (NOT kept) > 0 OR count(*) FILTER (kept) = 0 THEN 'warn' ELSE 'ok' END AS status
  FROM discs CROSS JOIN secs LEFT JOIN cap USING (discipline, section) WHERE discipline <> 'default' GROUP BY discipline, section""")
def domain_report(spark, sf):
    return D.report(D.capped(remaining(spark, sf)), rules(spark, sf))


@query("declared_disciplines", f"WITH {_RULES} SELECT DISTINCT discipline FROM rules WHERE discipline <> 'default'")
def declared_disciplines(spark, sf):
    return D.declared(rules(spark, sf))


@query("off_domain_sources", rf"""SELECT page_id, {_HOST} AS host FROM pages WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT regexp_replace(s_name, 'Supplier#0*([0-9]).*', 'example.org') AS a FROM supplier) WHERE {_HOST} = a OR ends_with({_HOST}, '.' || a))""")
def off_domain_sources(spark, sf):
    allowed = table(spark, sf, "supplier", "s_name").select(
        F.regexp_replace("s_name", "Supplier#0*([0-9]).*", "example.org").alias("domain")).distinct()
    pages = table(spark, sf, "pages", "page_id", "url").select("page_id", T.url_host(F.col("url")).alias("host"))
    return D.off_domain(pages, allowed).select("page_id", "host")
