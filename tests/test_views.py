import contextlib
import io

from pyspark.sql import functions as F

from docwright.plans import views as V

FOLDER = "/root/testdata/sf0.001"


def test_texts_and_names_move_no_document(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            V.document_base(spark, FOLDER).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    moved = [line for line in plan.getvalue().splitlines() if "Exchange hashpartitioning" in line]
    # Lines by order, orders, and the pages of a window.
    assert len(moved) == 3 and sum("(k#" in line for line in moved) == 1


def test_large_tables_are_joined_by_exchange_with_equal_rows(spark, monkeypatch):
    names = ("course_name", "overview", "parent_corner", "recruiters", "verification")
    rows = lambda: sorted(tuple(r) for r in V.json_documents(spark, FOLDER, names).collect())
    sent = rows()
    monkeypatch.setattr(V, "SENT_BYTES", 0)
    assert V.sent(spark.range(3)) is None and rows() == sent and len(sent) > 1000


def test_partitions_follow_the_lines(spark, monkeypatch):
    rows = lambda: V.document_base(spark, FOLDER, ("course_name",))
    few = rows().count()
    monkeypatch.setattr(V, "LINES_A_TASK", 50)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        rows().explain()
    n = -(-V.text_count(spark, FOLDER, "lineitem") // 50)
    assert n > 100 and f", {n})" in plan.getvalue() and rows().count() == few > 1000


def test_some_properties_are_those_of_the_whole_document(spark):
    taken = ("overview", "category", "quick_facts", "careers"), ("curriculum", "subcategory", "snapshot"), ("recruiters", "colleges"), ("fees", "comparison", "slug")
    hashed = lambda names: [F.xxhash64(F.to_json(F.struct(f"doc.{p}"))).alias(p) for p in names]
    want = V.typed_documents(spark, FOLDER).select("k", *hashed(V.FIELDS_OF.keys() - {"course_name", "seo"})).collect()
    for names in taken:
        got = V.typed_documents(spark, FOLDER, names).select("k", *hashed(names)).collect()
        assert sorted(map(tuple, got)) == sorted((r["k"], *[r[p] for p in names]) for r in want)


def test_packed_lines_come_back_as_they_were(spark):
    names = "k long, slot long, sk long, pk long, fee long, lo long, hi long, flag string, st string"
    rows = [
        (1, 3, 7, 9, 100, 90, 110, "R", "F"), (2 ** 40, 15, 2 ** 31 - 1, 2 ** 32 - 1, 2 ** 29 - 1, 2 ** 29 - 2 ** 17, 2 ** 29 + 5, "\x00", "~"),
        (2, 0, 0, 0, 0, 0, 0, " ", "A"), (3, 1, -1, 5, 5, 4, 6, "R", "F"), (4, 1, 2, 2 ** 32, 5, 4, 6, "R", "F"), (5, 1, 2, 3, 5, 6, 4, "R", "F"),
        (6, 1, 2, 3, None, None, None, None, "F"), (7, 1, 2, 3, 5, 4, 6, "RR", ""), (8, 1, 2, 3, 5, 4, 6, "é", "F"), (None, None, None, None, None, None, None, None, None)]
    lines = spark.createDataFrame(rows, names)
    travelling = V.packed(lines)
    assert V.unpacked(travelling).select(lines.columns).collect() == lines.collect()
    assert [r["wide"] is None for r in travelling.collect()] == [True] * 3 + [False] * 7
    for some in (("k", "slot", "sk", "pk"), ("k", "slot", "sk", "pk", "lo", "hi"), ("k", "slot", "sk", "pk", "flag", "st", "fee")):
        assert V.unpacked(V.packed(lines.select(*some))).select(*some).collect() == lines.select(*some).collect()
