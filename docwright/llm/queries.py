"""The queries of this folder: each applies its operator, with production parameters, to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docwright.llm import alignment, decontamination, html_content, infilling, language_model
from docwright.llm import near_duplicates as near
from docwright.llm import neighbours, packing, pii, quality, sharding, simhash, warc
from docwright.llm.common import ship, text_or_empty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """The vocabulary file, which is installed beside the libraries on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op5_decontamination"] = r"""
WITH items AS (
    SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM benchmark
), asked AS (
    SELECT item_id, w, least(5, len(w)) AS k FROM items WHERE len(w) > 0
), item_shingles AS (
    SELECT DISTINCT item_id, k, list_slice(w, i, i + k - 1) AS s FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM asked)
), sizes AS (
    SELECT item_id, k, count(*) AS item_shingles FROM item_shingles GROUP BY ALL
), docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), doc_shingles AS (
    SELECT DISTINCT doc_id, k, list_slice(w, i, i + k - 1) AS s
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM asked))
)
SELECT doc_id, item_id, item_shingles, count(*) AS found, count(*) / item_shingles AS containment
FROM item_shingles JOIN doc_shingles USING (k, s) JOIN sizes USING (item_id, k)
GROUP BY doc_id, item_id, item_shingles HAVING 100 * count(*) >= 80 * item_shingles
"""


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.KINDS], F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"))


@query
def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(table(spark, sf_dir, "documents"))


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(table(spark, sf_dir, "documents"))
    text = text_or_empty("text")  # both digests from the texts as they stand in the shards
    return sharded.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + sharding.ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        "law", "shard", "slot", "grown_shard")


@query
def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages"))


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLES["op1_warc"] = r"""
WITH d AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT h, min(page_id) AS first FROM d GROUP BY h),
bits AS (SELECT page_id, h, list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(('0x' || sha1(h)[i])::INT), 4, '0')), 'string_agg', '') AS b FROM d)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST(1 + list_sum(list_transform(range(1, 6), lambda j: CASE WHEN b[5 * i + j] = '1' THEN 1 << (5 - j) ELSE 0 END)) AS INT)]), 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM bits JOIN m USING (h)
"""


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_pairs(table(spark, sf_dir, "documents"))


@query
def op13_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infilling.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infilling.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLES["op13_infilling"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
    SELECT doc_id, t, regexp_extract_all(t, '[^\x0A]*\x0A|[^\x0A]+') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d
), c AS (
    SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
    SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM p
"""


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
