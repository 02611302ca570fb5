"""Validation of documents as they arrive.

Validation is row-local, so a stream is judged by the same expressions as a
table; what was already judged is left out by id and checksum.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docwright.operators.publish import checksum
from docwright.operators.report import report, validate


def validated_stream(documents: DataFrame, delay: str = "1 day", **options) -> DataFrame:
    """Reports of a stream (course_id, body, arrived), one per course and content within the delay.

    A document that is no JSON is reported as in a batch, with its finding at the root.
    """
    summed = documents.withColumn("checksum", checksum(F.col("body")))
    fresh = summed.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["course_id", "checksum"])
    return report(validate(fresh, **options), "course_id", "checksum", "arrived")


def write(reports: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append reports to a Parquet table; exactly once, from the checkpoint in a shared folder."""
    return reports.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
