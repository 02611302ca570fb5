"""Saved JSON files: finding them, reading them, and pairing runs with documents."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docwright.functions.arrays import let


def read(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, value): every file of a glob with its whole text."""
    return spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def write(files: DataFrame, root: str) -> None:
    """Saves rows (course, file, value) as one small text file each: root/course=.../file=.../part-*; Spark commits them as a whole."""
    files.select("course", "file", "value").write.partitionBy("course", "file").text(root)


def pack(files: DataFrame, root: str) -> None:
    """Saves rows (path, value) of many small files in a few large ones, a line each, as millions of files are slow to write and to list."""
    files.select("path", "value").write.json(root)


def unpack(spark: SparkSession, root: str) -> DataFrame:
    """(path, value) of packed files. A line that is damaged gives no path and is passed over."""
    return spark.read.schema("path string, value string").json(root).where(F.col("path").isNotNull())


def folder(path: Column) -> Column:
    """The folder of a course's files, without the level that names the file."""
    return F.regexp_extract(path, r"^(.*?)(?:/file=[^/]*)?/[^/]*$", 1)


def opened(files: DataFrame, of) -> DataFrame:
    """The rows whose value is a JSON object, with the named columns `of` makes from its VARIANT; others are passed over.

    Each text is parsed once. What comes of explode_outer is not put back into later filters, which would parse the text anew for
    each column they name.
    """
    def read(v: Column) -> Column:
        return F.when(F.try_variant_get(v, "$", "map<string,variant>").isNotNull(), F.struct(*of(v)))

    rows = files.select("*", F.explode_outer(F.array(let(F.try_parse_json("value"), read))).alias("_of"))
    return rows.where(F.col("_of").isNotNull()).select(*files.columns, "_of.*")


def runs(files: DataFrame) -> DataFrame:
    """(course_id, course_name, status, path, payload, folder) of readable run or review files."""
    def names(v: Column) -> list[Column]:
        text = lambda name: F.try_variant_get(v, f"$.{name}", "string")
        return [F.nullif(text("course_id"), F.lit("")).alias("course_id"), text("course_name").alias("course_name"), text("status").alias("status")]

    return opened(files, names).select(
        "course_id", "course_name", "status", "path", F.col("value").alias("payload"), folder(F.col("path")).alias("folder"))


def run_documents(run_files: DataFrame, document_files: DataFrame) -> DataFrame:
    """Runs with the document of the same folder."""
    documents = opened(document_files, lambda v: [F.lit(True).alias("is_object")]).select(
        folder(F.col("path")).alias("folder"), F.col("value").alias("body"))
    return runs(run_files).join(documents, "folder")
