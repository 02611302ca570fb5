import re

from pyspark.sql import functions as F

from docwright.functions import text as T
from docwright.functions.variants import rewrite_strings
from docwright.sources import artifacts as W
from docwright.sources import json_files as J
from docwright.sources.snapshots import Snapshots


def _one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("o")).first()["o"]


def test_vectors(spark):
    cases = [
        (T.slugify, "B.Sc (Hons) Psychology", "b-sc-hons-psychology"), (T.slugify, "--Été 2 °C--", "été-2-c"), (T.slugify, "!!!", ""),
        (T.clean_cell, " B.A — Fine\u00a0 Arts’ ", "B.A - Fine Arts'"), (T.clean_cell, None, ""),
        (T.normalize_domain, " HTTPS://user@www.Example.org:80/a?b ", "example.org"), (T.normalize_domain, "-https://x.in/a", "-x.in"),
        (T.normalize_domain, "-", ""), (T.normalize_domain, "a.in?x=/y", "a.in"), (T.normalize_domain, "", ""),
        (T.strip_citation_markers, "Fees rise [1][2, 3] .  Then fall [4;5]", "Fees rise. Then fall"),
        (T.name_key, "  STRAẞE \t x ", "strasse x"), (T.course_id, "a-" * 40, "crs_" + "a_" * 29 + "a"),
        (T.url_host, "https://WWW.a.in:8/x", "a.in:8"), (T.url_host, "a.in/x", ""),
        (T.is_blank, " \u3000\t", True), (T.is_blank, " x ", False),
    ]
    for fn, value, wanted in cases:
        assert _one(spark, value, fn) == wanted, (fn.__name__, value)


def test_word_count_and_blank_strip_agree_with_python(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", T.word_count(F.col("text")).alias("n")).collect()
    for r in rows:
        assert r["n"] == len(re.findall(r"\b[\w'’-]+\b", r["text"]))


def test_host_suffixes(spark):
    assert _one(spark, "a.b.c", T.host_suffixes) == ["a.b.c", "b.c", "c"]


def test_strings_of_any_json_are_rewritten(spark):
    """Only values change: names, numbers, blanks and escapes of what stays are kept byte for byte."""
    rows = [
        ('{"a [1]" : "b [2].", "n":1e5,"k":[ "x\\u0041", "c [1, 2]" , null,{"q\\"[3]":"\\\\ [4]"}]}', '{"a [1]" : "b.", "n":1e5,"k":[ "x\\u0041", "c" , null,{"q\\"[3]":"\\\\"}]}'),
        ('"lone [7]"', '"lone"'), ("[]", "[]"), ("12.50", "12.50"), ('{"a":""}', '{"a":""}'), (None, None), ("", ""),
    ]
    frame = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, json string")
    got = frame.select("i", rewrite_strings(F.col("json"), T.strip_citation_markers).alias("out")).orderBy("i").collect()
    assert [r["out"] for r in got] == [b for _, b in rows]


def test_saved_files_one_by_one_and_packed(spark, tmp_path):
    rows = [("crs_1", "run", '{"course_id":"crs_1","status":"validated"}'), ("crs_1", "document", '{"course_id":"crs_1"}'),
            ("crs_2", "run", "{broken"), ("crs_2", "document", "{}"), ("crs_3", "run", '{"course_id":"crs_3"}'), ("crs_4", "run", "")]
    J.write(spark.createDataFrame(rows, "course string, file string, value string"), f"file://{tmp_path}/store")
    found = J.run_documents(*(J.read(spark, f"file://{tmp_path}/store/*/file={k}") for k in ("run", "document"))).collect()
    assert [(r["course_id"], r["status"], r["body"].strip()) for r in found] == [("crs_1", "validated", rows[1][2])]
    named = [(f"/store/{c}/{k}.json", v) for c, k, v in rows]
    J.pack(spark.createDataFrame(named, "path string, value string"), f"file://{tmp_path}/packed")
    with open(tmp_path / "packed" / "part-damaged.json", "w") as f:
        f.write('{"path":"/store/x\n')
    assert sorted(map(tuple, J.unpack(spark, f"file://{tmp_path}/packed").collect())) == sorted(named)


def test_saved_rows_replace_those_of_the_same_key(spark, tmp_path):
    schema = "course_id string, n int"
    store = Snapshots(spark, f"file://{tmp_path}/sections", schema)
    made = lambda *rows: spark.createDataFrame(rows, schema)
    assert W.save(store, made(("a", 1), ("a", 2), (None, 3), ("b", 4)), "course_id") == 1
    assert W.save(store, made(("a", 5), (None, 6)), "course_id") == 2
    assert sorted(map(tuple, store.read().collect()), key=str) == sorted([("a", 5), (None, 6), ("b", 4)], key=str)
    assert store.read(1).count() == 4 and W.save(store, made(), "course_id") == 3 and store.read().count() == 3
