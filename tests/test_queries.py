"""Registered queries against their SQL. DOCWRIGHT_ALL=1 runs every one of them."""

import os

import duckdb
import pytest

from docwright.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SOME = (
    "clean_cell", "text_hygiene_findings", "string_leaves", "curriculum_length", "fee_rows", "source_checks", "validation_report",
    "catalogue_dedupe", "stratified_sample", "duration_resolve", "domain_resolved", "request_plan", "section_merge",
    "response_rejects", "section_outcomes", "usage_merge", "review_items", "review_queue", "ledger_upsert", "publish_summary",
    "citation_marker_strip_json", "run_document_scan", "review_scan", "course_status", "top_failures", "artifact_tables",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    try:
        return f"{float(value):.6f}"
    except (TypeError, ValueError):
        return str(value)


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("DOCWRIGHT_ALL") else SOME)
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    names = sorted(frame.columns)
    got = sorted(tuple(_plain(r[n]) for n in names) for r in frame.collect())
    result = duck.execute(ORACLES[name])
    titles = [d[0] for d in result.description]
    assert sorted(titles) == names
    want = sorted(tuple(_plain(r[titles.index(n)]) for n in names) for r in result.fetchall())
    assert got == want


def test_skipped_rules_match_sql(spark, duck):
    got = sorted(tuple(r) for r in QUERIES["rule_skips"](spark, FOLDER).select("course_id", "rule").collect())
    assert got and got == sorted(duck.execute(f"SELECT course_id, rule FROM ({ORACLES['rule_skips']})").fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
