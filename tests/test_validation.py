"""One good document, broken one field at a time."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docwright.operators import report as P
from docwright.operators.structure import KEYWORDS, examine_columns, keyword_findings, properties_with
from docwright.schema import DOCUMENT
from tests.documents import good, judge, put

ALLOWED = ("gov.in",)

MUTATIONS = [
    ("hero.fit.note", "", "blank_string"),
    ("hero.fit.note", "Lorem Ipsum dolor sit amet now", "placeholder_text"),
    ("hero.fit.note", "This is a demo of a note for you", "possible_placeholder_text"),
    ("hero.fit.note", "Fees could not be determined for it", "process_commentary"),
    ("hero.fit.note", "A fair match for you [3, 4] indeed", "citation_markers"),
    ("colleges.items[2].annual_fee", 270000, "college_fee_not_annual"),
    ("colleges.items[0].annual_fee", 400, "college_fee_implausibly_low"),
    ("quick_facts.typical_duration.min_years", 4, "duration_inverted"),
    ("quick_facts.indicative_annual_fees.max", 10000, "fee_range_inverted"),
    ("quick_facts.indicative_annual_fees.max", 6000000, "fee_out_of_range"),
    ("snapshot.salary.typical_annual", 900000, "salary_not_ordered"),
    ("snapshot.salary.lower_annual", 800000, "salary_range_degenerate"),
    ("snapshot.salary.higher_annual", 30000000, "salary_out_of_range"),
    ("snapshot.salary.marker_percent", 60, "salary_marker_mismatch"),
    ("overview.paragraphs[0]", "short", "overview_length"),
    ("parent_corner.intro", "short", "parent_intro_length"),
    ("eligibility.admission_timeline[1].step", 3, "timeline_steps_not_sequential"),
    ("curriculum.years[1].year", 3, "curriculum_years_not_sequential"),
    ("curriculum.years[2].subjects[0].name", " SUBJECT 10", "duplicate_subject"),
    ("quick_facts.typical_duration.max_years", 4.5, "curriculum_length_mismatch"),
    ("fees.rows[0].min", None, "fee_range_missing"),
    ("fees.rows[2].min", 0, "fee_spread_too_wide"),
    ("fees.rows[1].institution_type", "government", "fee_segmentation_incomplete"),
    ("quick_facts.indicative_annual_fees.min", 0, "quick_fee_spread_too_wide"),
    ("colleges.items[3].rank", 6, "college_ranks_not_sequential"),
    ("colleges.items[3].name", "college 1 ", "duplicate_college"),
    ("colleges.items[3].annual_fee", 5000001, "college_fee_out_of_range"),
    ("comparison[0].course_name", "Another", "comparison_anchor_mismatch"),
    ("comparison[2].course_name", "Other 1", "comparison_duplicate_course"),
    ("careers[3].title", "Career 1", "duplicate_career"),
    ("careers[0].route_badge", "Possible after bachelor's", "careers_no_advanced_route"),
    ("recruiters[3].name", "FIRM 1", "duplicate_recruiter"),
    ("verification.sources[0].url", "http://s0.gov.in/x", "source_not_https"),
    ("verification.sources[0].url", "https://notgov.in/x", "source_off_domain"),
    ("overview.heading", "What is this?", "overview_heading_missing_course"),
]

STRUCTURAL = [
    ("fees", ...), ("hero.fit.note", ...), ("careers[2].title", ...), ("fees.rows[1].institution_type", ...),
    ("careers[2]", "text"), ("careers", {"a": 1}), ("hero", "text"), ("hero", None), ("recruiters[1].roles", "x"),
    ("recruiters[1].roles", ["a", "a", "abc"]), ("recruiters[1].roles[0]", ["deep"]),
    ("curriculum.years[0].subjects[3].name", 5), ("curriculum.years[0].subjects", None),
    ("curriculum.years[0].subjects[1]", [1]), ("curriculum.years[0].subjects[1].extra", {"a": ["b"]}),
    ("extra", {"a": [{"b": "c: d"}]}), ("hero.fit.score_percent", 4.0), ("hero.fit.score_percent", 4.5),
    ("hero.fit.score_percent", True), ("snapshot.salary.higher_is_open_ended", 1), ("course_level", None),
    ("course_level", 7), ("fees.rows[0].min", -1), ("slug", "Not a slug"), ("faqs", []), ("course_name", "né"),
    ("fees.rows[0].institution_type", "club"), ("verification.sources[0].url", 'https://a"b\\c: {["'),
]


@pytest.fixture(scope="module")
def checked(spark):
    bodies = {"good": good()}
    for i, (path, value, _) in enumerate(MUTATIONS):
        bodies[f"rule{i}"] = put(good(), path, value)
    for i, (path, value) in enumerate(STRUCTURAL):
        bodies[f"structure{i}"] = put(good(), path, value)
    rows = [(k, json.dumps(v, ensure_ascii=bool(n % 2))) for n, (k, v) in enumerate(bodies.items())]
    rows += [("list", "[1]"), ("broken", "{oops")]
    frame = spark.createDataFrame(rows, "id string, body string")
    result = P.report(P.validate(frame, allowed_domains=ALLOWED), "id").collect()
    return bodies, {r["id"]: r for r in result}


def _codes(row, source=None):
    return [f["code"] for f in row["findings"] if source in (None, f["source"])]


def test_good_document_passes(checked):
    row = checked[1]["good"]
    assert (row["status"], _codes(row), row["skipped"]) == ("pass", [], 0)


@pytest.mark.parametrize("i", range(len(MUTATIONS)), ids=lambda i: MUTATIONS[i][2])
def test_mutation_gives_its_code(checked, i):
    assert MUTATIONS[i][2] in _codes(checked[1][f"rule{i}"], "rule")


def test_structure_agrees_with_plain_recursion(checked):
    bodies, rows = checked
    for name, body in bodies.items():
        got = Counter((f["code"], f["path"]) for f in rows[name]["findings"] if f["source"] == "schema")
        assert got == Counter(judge(DOCUMENT, body)), name


def test_strings_in_unknown_places_are_checked(spark):
    body = put(good(), "extra", {"a": [{"b": "see TODO"}], "c": {"d": {"e": {"f": {"g": {"h": ["tbd"]}}}}}})
    rows = P.findings_table(P.validate(spark.createDataFrame([(json.dumps(body),)], "body string"), allowed_domains=ALLOWED), "body")
    paths = {r["path"] for r in rows.where(F.col("code") == "placeholder_text").collect()}
    assert paths == {"extra.a[0].b", "extra.c.d.e.f.g.h[0]"}


def test_documents_that_are_no_objects_fail(checked):
    for name in ("list", "broken"):
        row = checked[1][name]
        assert row["status"] == "fail" and _codes(row) == ["type"] and row["skipped"] == 20


def test_missing_section_skips_its_rules(checked):
    assert checked[1]["structure0"]["skipped_rules"] == [
        "fee_rows", "fee_spread_forces_segmentation", "total_programme_fee_sanity"]


def test_feedback_and_sections(spark, checked):
    row = checked[1]["rule24"]
    frame = spark.createDataFrame([(row["findings"],)], f"findings array<{P.FINDING}>")
    out = frame.select(P.feedback_lines(F.col("findings")).alias("lines"), P.failing_sections(F.col("findings")).alias("s")).first()
    assert out["lines"][0].startswith("- colleges.items: ") and out["s"] == ["market"]


def test_gates_walk_dotted_paths(spark):
    import dataclasses

    from docwright.operators import rules as R
    from docwright.operators.report import validate

    rule = dataclasses.replace(R.subset("salary_ordering")[0], requires=("quick_facts.typical_duration",))
    whole, bare = good(), good()
    del bare["quick_facts"]["typical_duration"]
    frame = spark.createDataFrame([(1, json.dumps(whole)), (2, json.dumps(bare))], "n int, body string")
    got = {r["n"]: r["skipped_rules"] for r in validate(frame, rules=(rule,), structural=False).select("n", "skipped_rules").collect()}
    assert got == {1: [], 2: ["salary_ordering"]}


def test_findings_of_some_keywords_are_those_of_the_whole_check(spark):
    bodies = [json.dumps(put(good(), path, value)) for path, value, _ in MUTATIONS + [
        ("hero.badge", 2, ""), ("colleges.items[1].rank", "many words", ""), ("careers[0].title", "x", ""), ("suitability.tags[1]", "Other", ""), ("skills", {}, ""),
        ("fees", ..., ""), ("faqs[0].answer", ..., ""), ("curriculum.years[0].subjects", 7, ""), ("seo", None, ""), ("verification.sources[0].url", "http://a", ""),
        ("recruiters[2].roles[0]", 5, ""), ("course_level", "None", ""), ("colleges.items[3]", "no object", ""), ("snapshot.specialisations", [], "")]] + ["[]", "{}", "x"]
    rows = spark.createDataFrame(list(enumerate(bodies)), "id int, body string").withColumn("v", F.try_parse_json("body"))
    whole = rows.select("id", examine_columns("body", "v")["findings"].alias("f")).collect()
    # A number where a text belongs has the wrong type and nothing else; bounds are for numbers, lengths for texts.
    at = lambda i: {f["code"] for f in whole[len(MUTATIONS) + i]["f"]}
    assert at(0) == at(1) == {"type"} and all(properties_with(c) for c in KEYWORDS)
    groups = [("required",), ("enum",), ("minLength", "maxLength"), ("pattern",), ("minimum", "maximum"), ("minItems", "maxItems"), ("uniqueItems",), ("type",), ("additionalProperties",)]
    got = rows.select("id", *[keyword_findings("body", "v", *g).alias(g[0]) for g in groups]).collect()
    for all_found, some in zip(whole, got):
        for group in groups:
            assert [f for f in all_found["f"] if f["code"] in group] == some[group[0]]
    # Bodies that hold only the properties asked for give the same, but for the root itself.
    for group in groups[1:7]:
        kept = spark.createDataFrame([(i, json.dumps({p: v for p, v in json.loads(b).items() if p in properties_with(*group)})) for i, b in enumerate(bodies[:-3])], "id int, body string")
        found = kept.withColumn("v", F.try_parse_json("body")).select("id", keyword_findings("body", "v", *group).alias("f")).collect()
        assert [r["f"] for r in found] == [r[group[0]] for r in got[:-3]]


def test_text_rules_look_at_suspect_properties_alone_and_miss_none(spark):
    from docwright.functions.variants import nesting_depth, string_leaves
    from docwright.operators import rules as R

    said = ["", " ", "\n\t", " ", "xKſ", "Lorem IPSUM", "to do TODO", "tbd", "a {{b", "placeholder", "xxxx", "www.EXAMPLE.com", "[Insert", "your text here", "Demo", "sample data",
            "fıctİonal", "as an Aİ", "search reſult", "the snıppets", "K \"as an ai\\", "where sources showed", "where the source gave", "not consistently listed", "could not be found",
            "based on the search", "according to the results", "data were not found", "from the sources", "in the reſults", "[1, 2]", "[٣]", "fine", "your own", "\\n todo", "provided ſource"]
    bodies = [json.dumps(put(good(), where, text), ensure_ascii=bool(n % 2)) for n, text in enumerate(said) for where in ("faqs[1].answer", "extra")]
    bodies += [json.dumps(good()), '["todo"]', '"tbd"', "{}", "x", '{"region": "Plain", "faqs": [{"answer": "see TODO"}]}']
    rows = spark.createDataFrame(list(enumerate(bodies)), "id int, body string").withColumn("v", F.try_parse_json("body"))
    found = lambda leaves: F.array_sort(R.rule_findings(None, R.Context(leaves=leaves), tuple(r for r in R.ALL_RULES if not r.requires)))
    got = rows.select(found(P.suspect_leaves(F.col("v"))).alias("some"), found(string_leaves(F.col("v"), nesting_depth(F.col("body")))).alias("whole"), P.suspect_leaves(F.col("v")).alias("seen")).collect()
    assert [r["some"] for r in got] == [r["whole"] for r in got] and sum(bool(r["some"]) for r in got) > 55
    assert [leaf["path"] for leaf in got[-1]["seen"]] == ["faqs[0].answer"]


def test_patterns_of_values_without_findings_match_no_others():
    import re

    from docwright.operators.structure import fine

    text = lambda value: json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    for name, spec in DOCUMENT.members.items():
        pattern = re.compile(re.sub(r"\\Q(.*?)\\E", lambda m: re.escape(m[1]), fine(spec, at=name)).replace("(?<u", "(?P<u").replace(r"\k<u0>", "(?P=u0)"))
        assert pattern.fullmatch(text(good()[name])), name
        broken = [put(good(), path, value) for path, value in STRUCTURAL if path.split(".")[0].split("[")[0] == name]
        for body in broken:
            assert name not in body or not pattern.fullmatch(text(body[name])) or not [f for f in judge(DOCUMENT, body) if f[1].startswith(name)], (name, body[name])


def test_lists_of_a_wrong_length_alone_are_not_read(spark):
    """A property that only has too few or too many entries, or is written in another order, gives what it gives when it is read; texts that hold JSON are no objects."""
    g, by_name = good(), lambda body: json.dumps(body, sort_keys=True)
    more = lambda path, n: put(g, path, [*(e for e in _at(g, path)), *([_at(g, path)[0]] * n)])
    bodies = [more("careers", 2), more("careers", 40), put(g, "careers", g["careers"][:2]), put(g, "careers", []), more("colleges.items", 1), more("suitability.good_fit.points", 3),
              more("comparison", 1), put(more("fees.rows", 6), "fees.rows[7].min", -1), put(g, "suitability.tags", ["one"] * 3), put(g, "recruiters[0].roles", ["abc"] * 2),
              put(g, "seo", json.dumps(g["seo"])), put(g, "careers", json.dumps(g["careers"])), put(g, "careers", ["text"] * 7), put(g, "careers[1]", json.dumps(g["careers"][1])),
              put(g, "region", {"a": 1}), put(g, "region", 1234), put(g, "region", "x\"y"), put(g, "hero.fit.indicators", [1, 2, 3, 4])]
    rows = [(n, text(body)) for n, (body, text) in enumerate((b, t) for b in bodies for t in (json.dumps, by_name, lambda b: json.dumps(b, indent=1)))]
    frame = spark.createDataFrame(rows, "id int, body string").withColumn("v", F.try_parse_json("body"))
    got = frame.select("id", examine_columns("body", "v")["findings"].alias("f")).collect()
    for row in got:
        assert Counter((f["code"], f["path"]) for f in row["f"]) == Counter(judge(DOCUMENT, bodies[row["id"] // 3])), row["id"]
    assert {f["message"] for f in got[0]["f"]} == {"list has 8 entries, at most 6 allowed"}


def test_wrong_lengths_and_texts_are_judged_by_their_json_text_alone():
    from docwright.operators.structure import _Compiler

    compiler = _Compiler("body", "v", None, None, frozenset(), KEYWORDS)
    compiler.compile_root(DOCUMENT)
    assert len(compiler.levels) == len(DOCUMENT.members) and sum("1, 2" in level for level in compiler.levels) == 15
    assert all("fine." not in part and "level." in part for part in compiler.odd)


def _at(body, path):
    for step in path.split("."):
        body = body[step]
    return body
