"""From raw documents to packed sequences: quality, near-duplicates, benchmark passages, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docwright.llm import decontamination, packing, pii, quality
from docwright.llm import near_duplicates as near
from docwright.llm.common import new_folder, ship
from docwright.llm.queries import tokenizer_path

NEAR_PERCENT = 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; all others stay, unlabelled ones and empty texts too if their score allows it."""
    ship(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-copies the document with the smallest doc_id stays. Rows that share a doc_id stay or go together."""
    ship(spark)
    kept = near.near_duplicates(docs, NEAR_PERCENT).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["_kept"]), "left_semi")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    ship(spark)
    return decontamination.without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind in brackets; n_chars follows the text. No document goes."""
    ship(spark)
    found = pii.find(docs, keep_rows=True)
    text = F.when(F.size("spans") > 0, pii.redacted(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    clean = found.select("row", F.size("spans").alias("n"), text.alias("text"))
    length = F.when(F.col("n") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))
    new = {"text": F.col("text"), "n_chars": length}
    return clean.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    ship(spark)
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL expresses the classifier. The stages' operators have tests of their own; the whole has none yet.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
