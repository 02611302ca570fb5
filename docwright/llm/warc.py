"""WARC archives written and read by Spark, and the assembly of transactions.

Each page becomes three records: a request, a response or, for a payload that another page has, a revisit, and metadata. The
request and the metadata name the response in WARC-Concurrent-To. Records are text, since payloads are UTF-8, so Spark's own text
sink writes the archives: its commit protocol leaves whole files only, and a lost task is run again. Archives are read by the
lengths that their headers state, so a payload may hold anything, record separators too.

Assembly joins records by identifier: those of a capture by WARC-Concurrent-To, given in either direction or through another
record, and revisits to the response they refer to by its identifier.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwright.llm.common import new_folder, slices, stored, text_or_empty

VERSION, DATE = "WARC/1.1", "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_RECORDS = 30_000
BATCH_BYTES = 1 << 20
RECORD = ("record_id string, type string, target string, concurrent_to array<string>, refers_to string, page_id long, payload_digest string, "
          "stated_digest string, payload_bytes long, stated_bytes long, payload string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "html"):
        digests = [base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() for h in part.column("html").to_pylist()]
        yield part.append_column("digest", pa.array(digests, pa.string()))


def captures(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with their payload's digest, a record id of their own, and, where another page is the response, that page and its record.

    Of equal payloads of at least `least_bytes` the smallest page_id is the response (of several rows with that id, the one of the
    smallest record id; a null id only if there is no other); all others revisit it. A response repeated in all columns is one
    record written again, and each row of it counts as response.
    """
    frame = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), text_or_empty("html").alias("html"))
    digested = frame.mapInArrow(_digested, "page_id long, url string, html string, digest string")
    keys = stored(digested.select("page_id", "url", "digest", F.octet_length("html").cast("long").alias("n")), "warc-keys")
    rows = keys.groupBy("page_id", "url", "digest", "n").agg(F.count(F.lit(1)).alias("copies"))  # rows alike in all columns are one key
    rows = rows.withColumn("record", _urn(F.concat_ws("|", "page_id", F.coalesce("url", F.lit("")), "digest")))
    first = rows.where(F.col("n") >= least_bytes).groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "record")).alias("f"), F.sum("copies").alias("all")).where("all > 1")
    first = first.select("digest", F.col("f.page_id").alias("first_page"), F.col("f.record").alias("first_record"))
    return digested.join(first, "digest", "left")


def _urn(value: Column) -> Column:
    h = F.md5(value)
    return F.concat(F.lit("urn:uuid:"), *[x for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.substring(h, a, n), F.lit("-"))][:-1])


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record up to its block's end; a header whose value is null is left out. The sink adds the two line ends."""
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")) for name, value in headers]
    return F.concat(F.lit(f"{VERSION}\r\n"), *lines, F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n")), block)


def _records(captured: DataFrame) -> DataFrame:
    """One column `value`: three records for each page. `number` tells repeated rows apart within the file that is being written."""
    own = _urn(F.concat_ws("|", "page_id", F.coalesce("url", F.lit("")), "digest"))
    frame = captured.withColumn("own", own).withColumn("number", F.monotonically_increasing_id().cast("string"))
    revisits = F.col("first_record").isNotNull() & ~(F.col("own").eqNullSafe(F.col("first_record")) & F.col("page_id").eqNullSafe(F.col("first_page")))
    frame = frame.withColumn("revisit", revisits)
    page, url = F.col("page_id").cast("string"), F.regexp_replace(F.col("url"), r"[\r\n]+", " ")
    capture = F.when(F.col("revisit"), _urn(F.concat_ws("|", "own", F.lit("revisit"), "number"))).otherwise(F.col("own"))
    named = lambda kind: _urn(F.concat_ws("|", "own", F.lit(kind), "number"))
    common = lambda kind, id_: [("WARC-Type", kind), ("WARC-Record-ID", F.concat(F.lit("<"), id_, F.lit(">"))), ("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", url)]
    beside = ("WARC-Concurrent-To", F.concat(F.lit("<"), capture, F.lit(">")))
    request = _record([*common(F.lit("request"), named("request")), beside, ("Content-Type", F.lit("text/plain"))], F.concat(F.lit("GET "), F.coalesce(url, F.lit("")), F.lit("\r\n\r\n")))
    answer = _record([
        *common(F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), capture),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), ("X-Payload-Length", F.octet_length("html").cast("string")),
        ("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))), ("WARC-Refers-To", F.when(F.col("revisit"), F.concat(F.lit("<"), F.col("first_record"), F.lit(">")))),
        ("Content-Type", F.lit("text/html; charset=utf-8"))], F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")))
    metadata = _record([*common(F.lit("metadata"), named("metadata")), beside, ("Content-Type", F.lit("application/warc-fields"))], F.concat(F.lit("page-id: "), F.coalesce(page, F.lit("")), F.lit("\r\n")))
    return frame.select(F.explode(F.array(request, answer, metadata)).alias("value"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> None:
    """Writes the archives, compressed, each of a bounded number of records."""
    _records(captures(pages, least_bytes)).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def parsed(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Header fields and block of each record, by the stated lengths."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        fields: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            fields.setdefault(name.strip().lower(), []).append(value.strip())
        yield fields, stream.read(int(fields["content-length"][0]))


def _bare(values: list[str]) -> list[str]:
    return [v.strip("<>") for v in values]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, {"long": pa.int64(), "string": pa.string()}.get(t, pa.list_(pa.string()))) for n, t in (c.split() for c in RECORD.split(", "))])
    for batch in batches:
        for content in batch.column("content"):
            raw = io.BytesIO(content.as_py())
            stream = gzip.GzipFile(fileobj=raw) if raw.getbuffer()[:2] == b"\x1f\x8b" else raw
            rows, size = [], 0
            for fields, block in parsed(io.BufferedReader(stream)):
                get = lambda name: fields.get(name, [None])[0]  # noqa: B023, E731
                kind, payload = get("warc-type"), None
                page = int(block[8:].strip()) if kind == "metadata" and block.startswith(b"page-id:") and block[8:].strip() else None
                full = kind == "response"
                if full:
                    payload = block.decode("utf-8")
                stated = get("warc-payload-digest")
                rows.append((
                    _bare([get("warc-record-id")])[0], kind, get("warc-target-uri"), _bare(fields.get("warc-concurrent-to", [])), (_bare(fields.get("warc-refers-to", [])) or [None])[0], page,
                    base64.b32encode(hashlib.sha1(block).digest()).decode() if full else None, stated and stated.removeprefix("sha1:"),
                    len(block) if full else None, int(get("x-payload-length")) if get("x-payload-length") else None, payload))
                size += len(block)
                if size > BATCH_BYTES or len(rows) >= 2000:
                    yield pa.record_batch(list(map(pa.array, zip(*rows, strict=True), schema.types)), schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.record_batch(list(map(pa.array, zip(*rows, strict=True), schema.types)), schema=schema)


def read(spark, folder: str) -> DataFrame:
    """The records of all archives of a folder."""
    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(_read, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: record_id, type, target, refers_to (a record id), request, response and metadata, nested.

    A capture is a response, revisit or resource. Requests and metadata join it by WARC-Concurrent-To in either direction, or
    through one other record; of several requests the smallest id is taken, metadata are all kept, which is bounded by what one
    capture was given. A record that names no capture makes a row of its own, with null response. `records` is read several times:
    pass a stored table, and leave the column `payload` out where it isn't wanted.
    """
    is_capture = F.col("type").isin("response", "revisit", "resource")
    heads, rest = records.where(is_capture), records.where(~is_capture)
    links = records.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    links = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    ids = heads.select(F.col("record_id").alias("capture"))
    direct = links.join(ids, links["b"] == ids["capture"]).groupBy("a").agg(F.min("capture").alias("capture"))
    lost = rest.select("record_id").join(direct, F.col("record_id") == F.col("a"), "left_anti").join(links, F.col("record_id") == F.col("a"))
    far = lost.select("record_id", "b").join(direct.withColumnRenamed("a", "b"), "b").groupBy("record_id").agg(F.min("capture").alias("capture"))
    found = direct.select(F.col("a").alias("_id"), "capture").unionByName(far.select(F.col("record_id").alias("_id"), "capture"))
    small = rest.select("record_id", "type", "target", "page_id", "concurrent_to")
    placed = small.join(found, F.col("record_id") == F.col("_id"), "left").withColumn("_capture", F.coalesce("capture", "record_id"))
    record = F.struct("record_id", "type", "target", "page_id")
    beside = placed.groupBy("_capture").agg(
        F.min(F.when(F.col("type") == "request", record)).alias("request"), F.array_sort(F.collect_list(F.when(F.col("type") != "request", record))).alias("metadata"))
    response = F.struct(*[c for c in ("payload", "payload_digest", "payload_bytes", "stated_digest", "stated_bytes") if c in records.columns])
    own = heads.select(F.col("record_id").alias("_head"), "type", "target", "refers_to", response.alias("response"))
    both = own.join(beside, F.col("_head") == F.col("_capture"), "full_outer")
    return both.select(
        F.coalesce("_head", "_capture").alias("record_id"), "type", F.coalesce("target", F.col("request.target"), F.element_at("metadata", 1)["target"]).alias("target"),
        "refers_to", "request", "response", F.coalesce("metadata", F.array().cast("array<struct<record_id:string,type:string,target:string,page_id:bigint>>")).alias("metadata"))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, from archives written and read back.

    A null html is an empty payload. Of a response, bytes and digest are taken from the payload that was read; of a revisit, from
    its headers. Extra columns are not read.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write(pages, folder, least_bytes)
    records = stored(read(spark, folder).drop("payload"), "warc-records")
    made = assemble(records).where(F.col("type").isNotNull()).select(
        "record_id", F.col("metadata")[0]["page_id"].alias("page_id"), "type", F.col("refers_to").alias("_refers"),
        F.coalesce("response.payload_bytes", "response.stated_bytes").alias("payload_bytes"), F.coalesce("response.payload_digest", "response.stated_digest").alias("payload_digest"))
    made = stored(made, "warc-captures")
    target = made.where("type = 'response'").select(F.col("record_id").alias("_id"), F.col("page_id").alias("refers_to")).dropDuplicates(["_id"])
    return made.join(target, made["_refers"] == target["_id"], "left").select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")
