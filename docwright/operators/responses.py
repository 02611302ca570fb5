"""Raw response bodies: accepted content, rejections and citations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwright.functions import text as T
from docwright.functions.variants import as_array, as_object

_FENCE = r"(?s)\A```(?:json)?\s*(.*?)\s*```\z"


def _text(v: Column, path: str) -> Column:
    """Text at a path; values of other types do not count."""
    found = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))


def _items(v: Column, kind: str, list_path: str) -> Column:
    """Entries of a list below every output item of a kind."""
    output = as_array(F.try_variant_get(v, "$.output", "variant"))
    of_kind = F.filter(output, lambda x: _text(x, "$.type") == kind)
    none = F.array().cast("array<variant>")
    return F.flatten(F.transform(of_kind, lambda x: F.coalesce(as_array(F.try_variant_get(x, list_path, "variant")), none)))


def message_text(v: Column) -> Column:
    parts = F.transform(_items(v, "message", "$.content"), lambda p: _text(p, "$.text"))
    return T.strip(F.array_join(parts, ""))


def citations(v: Column) -> Column:
    """Addresses of all search results, the first of each."""
    urls = F.transform(_items(v, "search_results", "$.results"), lambda r: _text(r, "$.url"))
    return F.array_distinct(F.filter(urls, lambda u: u.isNotNull()))


def strip_fence(content: Column) -> Column:
    return F.when(content.rlike(_FENCE), F.regexp_extract(content, _FENCE, 1)).otherwise(content)


def parse(responses: DataFrame, body: str = "body") -> DataFrame:
    """Add rejected (class or null), data (JSON text of the content), citations and usage."""
    read = responses.withColumn("_v", F.try_parse_json(body)).withColumn("_content", message_text(F.col("_v")))
    read = read.withColumn("_data", F.try_parse_json(strip_fence(F.col("_content"))))
    v, content, data = F.col("_v"), F.col("_content"), F.col("_data")
    output = as_array(F.try_variant_get(v, "$.output", "variant"))
    rejected = (
        F.when(as_object(v).isNull(), "not_an_object")
        .when(F.coalesce(F.size(output), F.lit(0)) <= 0, "no_output")
        .when(F.coalesce(content, F.lit("")) == "", "no_text")
        .when(_text(v, "$.status").isin("incomplete", "failed"), "unfinished")
        .when(data.isNull(), "invalid_json")
        .when(as_object(data).isNull(), "not_an_object_value")
    )
    return read.withColumns({
        "rejected": rejected,
        "data": F.when(rejected.isNull(), F.to_json(data)),
        "citations": F.when(rejected.isNull(), citations(v)),
        "usage": F.to_json(F.try_variant_get(v, "$.usage", "variant")),
    }).drop("_v", "_content", "_data")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("rejected").isNull())


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("rejected").isNotNull()).drop("data", "citations")


def billed_failures(parsed: DataFrame) -> DataFrame:
    """Rejected responses as failed attempts: they were billed and bring no citations."""
    none = F.array().cast("array<string>")
    return dead_letters(parsed).select(
        "course_id", "section", "attempt", F.lit(False).alias("passed"), F.lit(False).alias("transport_error"),
        F.lit("provider_output").alias("code"), none.alias("citations"), "usage")
