"""Publishing documents as they arrive: what the ledger holds unchanged is left out, and a replayed batch is sent no second time."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docwright.operators import publish as P
from docwright.sources.snapshots import Snapshots

LEDGER = "course_id string, course_name string, http_status int, remote_id string, checksum string"
ANSWERS = f"{LEDGER}, ord long, outcome string"


def ledger_in(spark: SparkSession, folder: str) -> Snapshots:
    return Snapshots(spark, f"{folder}/ledger", LEDGER)


def answers_in(spark: SparkSession, folder: str) -> Snapshots:
    """What the remote end said, one version for each batch that sent anything."""
    return Snapshots(spark, f"{folder}/answers", ANSWERS)


def latest(candidates: DataFrame) -> DataFrame:
    """One row for each course: the one that arrived last, of equally late ones that of the greatest text."""
    at = F.struct(*[F.col(c) for c in ("arrived", "body", "course_name")])
    return candidates.groupBy("course_id").agg(F.max(at).alias("r")).select("course_id", "r.course_name", "r.body")


def publish_batch(candidates: DataFrame, folder: str, send: Callable[[DataFrame], DataFrame], writer: str, batch_id: int) -> None:
    """Sends what a batch (course_id, course_name, body, arrived) changes and stores the ledger.

    `send` turns the queue (course_id, course_name, body, checksum) into answers (ord, http_status, outcome, remote_id beside the id, the
    name and the checksum). Answers are stored before the ledger is; a batch that is replayed after that reads them again and does not send,
    and one whose ledger is stored does nothing. Only a batch lost while it sends is sent again, as no sender can tell.
    """
    spark = candidates.sparkSession
    ledger, answers = ledger_in(spark, folder), answers_in(spark, folder)
    if ledger.of_batch(writer, batch_id):
        return
    if answered := answers.of_batch(writer, batch_id):
        version = answered["version"]
    else:
        version = answers.replace(send(P.changed(latest(candidates), ledger.read())), writer, batch_id)
    new = P.before_abort(answers.read(version)).where(F.col("outcome") == "published")
    ledger.replace(P.upsert_ledger(ledger.read(), new), writer, batch_id)


def publish_stream(candidates: DataFrame, folder: str, send: Callable[[DataFrame], DataFrame], writer: str, checkpoint: str) -> StreamingQuery:
    """Publishes a stream of candidates batch by batch; a checkpoint belongs to one writer, whose batches it numbers."""
    return candidates.writeStream.foreachBatch(lambda frame, batch_id: publish_batch(frame, folder, send, writer, batch_id)).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
