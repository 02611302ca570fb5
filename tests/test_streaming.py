import json

from docwright.operators import rules
from docwright.streaming.validation import validated_stream, write
from tests.documents import good


def test_stream_judges_each_content_once(spark, tmp_path):
    body = json.dumps(good())
    rows = [("a", body, "2024-01-01 00:00:00"), ("a", body, "2024-01-01 01:00:00"), ("b", "{oops", "2024-01-01 01:00:00")]
    frame = spark.createDataFrame(rows, "course_id string, body string, at string").selectExpr("course_id", "body", "cast(at as timestamp) arrived")
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    reports = validated_stream(stream, rules=rules.subset("salary_ordering"))
    write(reports, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["course_id"], r["status"]) for r in out) == [("a", "pass"), ("b", "fail")]
