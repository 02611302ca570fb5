"""Walking and testing VARIANT values, one row at a time and inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A JSON string. Possessive, so that texts of any length are passed over in a loop.
_STRINGS = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def key_count(json: Column) -> Column:
    """Number of object members in a JSON text, at all depths."""
    outside = F.regexp_replace(json, _STRINGS, "")
    return F.char_length(outside) - F.char_length(F.replace(outside, F.lit(":"), F.lit("")))


def nesting_depth(json: Column) -> Column:
    """Deepest nesting of objects and arrays in a JSON text."""
    marks = F.split(F.regexp_replace(F.regexp_replace(json, _STRINGS, ""), r"[^\[\]{}]", ""), "")
    walked = F.aggregate(
        marks,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("top")),
        lambda acc, mark: F.struct(
            (acc["now"] + F.when(mark.isin("[", "{"), 1).when(mark.isin("]", "}"), -1).otherwise(0)).alias("now"),
            F.greatest(acc["top"], acc["now"] + F.when(mark.isin("[", "{"), 1).otherwise(0)).alias("top"),
        ),
    )
    return walked["top"]


def rewrite_strings(json: Column, change) -> Column:
    """A JSON text with `change` applied to every string value at any depth, whatever its shape.

    Names of members and values that `change` leaves alone stay byte for byte, as does all between them. A null stays null; what is
    no JSON text comes back with its quoted parts changed, so callers parse it first where that matters.
    """
    literals = F.regexp_extract_all(json, F.lit(_STRINGS), F.lit(0))
    gaps = F.split(json, _STRINGS, -1)

    def piece(literal: Column, gap: Column) -> Column:
        value = F.get_json_object(F.concat(F.lit('{"v":'), literal, F.lit("}")), "$.v")
        changed = change(value)
        written = F.regexp_replace(F.to_json(F.struct(changed.alias("v"))), r'(?s)^\{"v":(.*)\}\z', "$1")
        kept = gap.rlike(r"^[ \t\r\n]*:") | value.isNull() | changed.eqNullSafe(value)
        return F.concat(F.when(kept, literal).otherwise(written), gap)

    pieces = F.zip_with(literals, F.slice(gaps, F.lit(2), F.size(gaps)), piece)
    return F.concat(F.element_at(gaps, 1), F.array_join(pieces, ""))


def as_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>")


def as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def over(left: Column, right: Column) -> Column:
    """Union of two maps in which the right one wins."""
    kept = F.map_filter(left, lambda k, _: ~F.array_contains(F.map_keys(right), k))
    return F.map_concat(kept, right)


def without(v: Column, path: str) -> Column:
    """A VARIANT object without the member at a dotted path; what has no such path stays as it is."""
    first, _, rest = path.partition(".")
    members = as_object(v)
    left = (F.transform_values(members, lambda k, x: F.when(k == first, without(x, rest)).otherwise(x)) if rest
            else F.map_filter(members, lambda k, _: k != first))
    return F.coalesce(F.to_variant_object(left), v)


def leaves(v: Column, depth: Column, path: Column | None = None) -> Column:
    """Every scalar below v as array<struct<path, v>>, outermost first.

    depth is the nesting depth of the value (nesting_depth); each pass opens
    one level of containers. path is where v stands itself.
    """
    start = F.array(F.struct((F.lit("") if path is None else path).alias("path"), v.alias("v")))

    def child_of_object(node):
        dot = F.when(node["path"] == "", F.lit("")).otherwise(F.lit("."))
        return F.transform(
            F.map_entries(as_object(node["v"])),
            lambda e: F.struct(F.concat(node["path"], dot, e["key"]).alias("path"), e["value"].alias("v")),
        )

    def child_of_array(node):
        return F.transform(
            as_array(node["v"]),
            lambda x, i: F.struct(
                F.concat(node["path"], F.lit("["), i.cast("string"), F.lit("]")).alias("path"), x.alias("v")
            ),
        )

    def open_up(nodes):
        return F.flatten(
            F.transform(
                nodes,
                lambda node: F.coalesce(
                    child_of_object(node),
                    child_of_array(node),
                    F.array(F.struct(node["path"].alias("path"), node["v"].alias("v"))),
                ),
            )
        )

    passes = F.when(depth > 0, F.sequence(F.lit(1), depth)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(passes, start, lambda nodes, _: open_up(nodes))


def type_of(v: Column) -> Column:
    """Type name of a scalar VARIANT; VOID for JSON null."""
    return F.schema_of_variant(v)


def string_leaves(v: Column, depth: Column, path: Column | None = None) -> Column:
    """Every string below v as array<struct<path, value>>."""
    return F.transform(
        F.filter(leaves(v, depth, path), lambda n: type_of(n["v"]) == "STRING"),
        lambda n: F.struct(
            n["path"].alias("path"), F.try_variant_get(n["v"], "$", "string").alias("value")
        ),
    )


def number_leaves(v: Column, depth: Column) -> Column:
    """Every number below v as array<struct<path, value>>; booleans are not numbers."""
    return F.transform(
        F.filter(
            leaves(v, depth),
            lambda n: type_of(n["v"]).isin("BIGINT", "DOUBLE", "FLOAT") | type_of(n["v"]).startswith("DECIMAL"),
        ),
        lambda n: F.struct(
            n["path"].alias("path"), F.try_variant_get(n["v"], "$", "double").alias("value")
        ),
    )
