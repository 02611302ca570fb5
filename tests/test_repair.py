"""Document repair, contexts of sections and small helpers, on hand-made rows."""

import json

from pyspark.sql import functions as F
from tests.documents import good, put

from docwright.constants import SECTIONS
from docwright.functions.variants import without
from docwright.operators import assembly, repair, report

LOG = "course_id string, section string, round int, attempt int, passed boolean, transport_error boolean, citations array<string>, payload string"


def section(document, name):
    return json.dumps({p: document[p] for p in SECTIONS[name]})


def test_rounds_of_repair(spark):
    fine = good()
    bad_market = put(fine, "colleges.ranking_updated", "2024-13")
    bad_both = put(bad_market, "careers[1].title", fine["careers"][0]["title"])
    documents = [("sound", fine), ("mended", bad_market), ("refused", bad_both), ("silent", bad_market), ("twice", bad_market), ("root", put(fine, "extra", 1))]
    tried = [
        ("mended", "market", 1, 1, False, False, [], "{}"), ("mended", "market", 1, 2, True, False, [], section(fine, "market")),
        ("mended", "market", 1, 3, True, False, [], "{}"), ("mended", "outcomes", 1, 1, True, False, [], "{}"),
        # The first failing section breaks off, so the second is not run though it would have been accepted.
        ("refused", "outcomes", 1, 1, False, True, [], None), ("refused", "market", 1, 1, True, False, [], section(fine, "market")),
        ("twice", "market", 1, 1, True, False, [], "[1]"), ("twice", "market", 2, 1, True, False, [], section(fine, "market")),
    ]
    frame = spark.createDataFrame([(c, json.dumps(d)) for c, d in documents], "course_id string, body string")
    done = repair.repair(frame, spark.createDataFrame(tried, LOG), lambda d: report.validate(d, allowed_domains=("gov.in",)))
    got = {r["course_id"]: (r["status"], r["round"], sorted(r["failing"])) for r in done.courses.collect()}
    assert got == {
        "sound": ("validated", 0, []), "mended": ("validated", 1, []), "twice": ("validated", 2, []), "root": ("flagged", 0, []),
        "refused": ("flagged", 0, ["market", "outcomes"]), "silent": ("flagged", 0, ["market"]),
    }
    ran = {(r["course_id"], r["section"], r["round"]): (r["status"], r["attempts"]) for r in done.outcomes.collect()}
    assert ran == {
        ("mended", "market", 1): ("accepted", 2), ("refused", "outcomes", 1): ("flagged", 1), ("silent", "market", 1): ("open", 0),
        ("twice", "market", 1): ("accepted", 1), ("twice", "market", 2): ("accepted", 1),
    }
    assert done.made.count() == 5
    assert json.loads(done.courses.where("course_id = 'mended'").first()["body"])["colleges"] == fine["colleges"]


def test_outcomes_need_no_last_report(spark):
    calls = []

    def validate(frame):
        calls.append(1)
        found = F.array(F.struct(*[F.lit(x).alias(n) for n, x in (("code", "c"), ("path", "colleges"), ("message", "m"), ("severity", "error"), ("source", "rule"))]))
        return frame.withColumn("findings", F.when(F.length("body") > 0, F.raise_error(F.lit("read"))).otherwise(found) if len(calls) == 3 else found)

    log = spark.createDataFrame([("a", "market", r, 1, True, False, [], "{}") for r in (1, 2)], LOG)
    done = repair.repair(spark.createDataFrame([("a", "{}")], "course_id string, body string"), log, validate)
    assert len(calls) == 3 and done.outcomes.count() == 2 and done.made.count() == 2


def test_a_section_sees_only_what_came_before(spark):
    base = spark.createDataFrame([("a", '{"course_name":"A","region":"India","currency":"INR","category":"x"}'), ("b", '{"course_name":"B"}')], "course_id string, fields string")
    given = spark.createDataFrame([
        ("a", "profile", '{"course_level":"Diploma","seo":{}}'), ("a", "snapshot", "[2]"), ("a", "academics", '{"category":"y","course_level":"Doctoral"}'),
    ], "course_id string, section string, payload string")
    told = lambda only=None: {(r["course_id"], r["section"]): json.loads(r["context"]) for r in assembly.contexts(base, given, only).collect()}
    first = {"course_name": "A", "region": "India", "category": "x"}
    every = told()
    assert len(every) == 12 and all(every["b", s] == {"course_name": "B"} for s in SECTIONS)
    assert every["a", "profile"] == first
    assert every["a", "snapshot"] == every["a", "academics"] == first | {"course_level": "Diploma"}
    assert every["a", "outcomes"] == every["a", "guidance"] == first | {"course_level": "Doctoral", "category": "y"}
    again = told(F.array(F.lit("profile"), F.lit("market")))
    assert set(again) == {(c, s) for c in "ab" for s in ("profile", "market")}
    assert again["a", "profile"] == first | {"course_level": "Doctoral", "category": "y"}
    assert again["a", "market"] == first | {"course_level": "Diploma", "category": "y"}


def test_a_member_is_taken_out_by_its_path(spark):
    rows = [('{"a":{"b":1,"c":2},"d":3}',), ('{"a":5}',), ("[1]",), ('{"a":{"c":[{"b":1}]}}',)]
    frame = spark.createDataFrame(rows, "t string").select(F.to_json(without(F.parse_json("t"), "a.b")).alias("t"))
    assert [r["t"] for r in frame.collect()] == ['{"a":{"c":2},"d":3}', '{"a":5}', "[1]", '{"a":{"c":[{"b":1}]}}']
