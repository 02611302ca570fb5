"""Reading the registry files: JSON objects of durations and of domains."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docwright.functions import text as T

_DURATION = "struct<min_years:double,max_years:double,academic_years:int>"
_PATTERN = "struct<match:string,min_years:double,max_years:double,academic_years:int>"
DURATION_FILE = f"struct<exact:map<string,{_DURATION}>,patterns:array<{_PATTERN}>>"
DOMAIN_FILE = "map<string,map<string,array<string>>>"


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its whole text as `value`."""
    return spark.read.text(path, wholetext=True)


def exact_durations(files: DataFrame, *ids: str) -> DataFrame:
    parsed = files.select(*ids, F.from_json("value", DURATION_FILE).alias("r"))
    return parsed.select(*ids, F.explode("r.exact").alias("name", "d")).select(
        *ids, T.name_key(F.col("name")).alias("name"), "d.*")


def pattern_durations(files: DataFrame, *ids: str) -> DataFrame:
    parsed = files.select(*ids, F.from_json("value", DURATION_FILE).alias("r"))
    return parsed.select(*ids, F.posexplode("r.patterns").alias("rank", "p")).select(*ids, "rank", "p.*")


def domain_rules(files: DataFrame, *ids: str) -> DataFrame:
    """(discipline, section, pos, domain), with keys and domains normalised."""
    parsed = files.select(*ids, F.from_json("value", DOMAIN_FILE).alias("r"))
    groups = parsed.select(*ids, F.explode("r").alias("name", "groups")).select(
        *ids, F.when(F.col("name") == "default", F.col("name")).otherwise(T.discipline_key(F.col("name"))).alias("discipline"),
        F.explode("groups").alias("section", "listed"))
    return groups.select(
        *ids, "discipline", "section", F.posexplode(T.normalize_domains(F.col("listed"))).alias("pos", "domain"))
