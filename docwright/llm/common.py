"""What the operators of this folder share: the shared folder, stored tables and batches of bounded size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
_own: dict[str, str] = {}  # the folder of a local session that names none; a running session cannot take the setting


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session may do without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="docwright-"))
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/docwright/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there, and a lost executor costs nothing that is done."""
    spark, path = frame.sparkSession, new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of the value as text, modulo; a null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the text column of each has about `limit` bytes, one row at least."""
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for at, n in enumerate(lengths):
            if at > start and total + n > limit:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += int(n)
        yield batch.slice(start)


BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each Spark context, and keeps batches small, as texts may be long."""
    import shutil
    from pathlib import Path

    import docwright

    context = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if getattr(context, "_docwright_shipped", False):
        return
    package = Path(docwright.__file__).parent
    archive = shutil.make_archive(tempfile.mkdtemp(prefix="docwright-") + "/docwright", "zip", package.parent, package.name)
    context.addPyFile(archive)
    context._docwright_shipped = True
