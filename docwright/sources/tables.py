"""Reading the input tables."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table, with only the columns asked for."""
    frame = spark.read.parquet(f"{folder}/{name}.parquet")
    return frame.select(*columns) if columns else frame
