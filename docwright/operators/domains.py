"""Domain registry: the layered lists of search domains and what they resolve to.

Rules are rows (discipline, section, pos, domain); discipline may be 'default'
and section '_all'. A domain that begins with - excludes the domain after it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docwright.constants import MAX_DOMAINS, SECTIONS
from docwright.functions import text as T

DEFAULT, ALL = "default", "_all"
KEY = ("discipline", "section")


def _sections() -> Column:
    return F.array(*[F.lit(s) for s in SECTIONS])


def check(entries: DataFrame) -> DataFrame:
    """Faults of raw entries (discipline, section, value VARIANT): (discipline, section, fault)."""
    known = F.array_append(_sections(), F.lit(ALL))
    items = F.try_variant_get("value", "$", "array<variant>")
    fault = (
        F.when(~F.array_contains(known, F.col("section")), "unknown_section")
        .when(items.isNull(), "not_a_list")
        .when(F.exists(items, lambda x: F.schema_of_variant(x) != "STRING"), "not_text")
    )
    return entries.select(*KEY, fault.alias("fault")).where(F.col("fault").isNotNull())


def declared(rules: DataFrame) -> DataFrame:
    return rules.select("discipline").where(F.col("discipline") != DEFAULT).distinct()


def _listed(domains) -> Column:
    return T.normalize_domains(F.array(*[F.lit(d) for d in domains]).cast("array<string>"))


def cascade(rules: DataFrame, fallback=(), built_in=None) -> DataFrame:
    """Every declared discipline and section with its domains, first place each.

    The key `default` holds what a discipline without entries of its own gets.
    Layers: 1 own section, 2 own _all, 3 default section, 4 default _all, 5 the
    section's built-in domains (a mapping by section), 6 fallback. A domain keeps
    the most specific place it is listed at.
    """
    own = F.col("discipline") != DEFAULT
    every_section = F.when(F.col("section") == ALL, _sections()).otherwise(F.array("section"))
    first = rules.groupBy(*KEY, "domain").agg(F.min("pos").alias("pos"))
    spread = first.select(
        "discipline", F.explode(every_section).alias("to_section"), "pos", "domain",
        (F.when(own, 1).otherwise(3) + F.when(F.col("section") == ALL, 1).otherwise(0)).alias("layer"),
    ).withColumnRenamed("to_section", "section")
    named = declared(rules).unionByName(rules.sparkSession.range(1).select(F.lit(DEFAULT).alias("discipline")))
    disciplines = named.select("discipline", F.explode(_sections()).alias("section"))
    inherited = disciplines.join(spread.where(~own).drop("discipline"), "section").select(
        *KEY, "pos", "domain", "layer")
    layers = spread.where(own).unionByName(inherited)
    # Lists of the configuration: constants of the plan, one lookup for each discipline and section.
    constant = F.array(*[
        F.struct(F.lit(section).alias("of"), F.lit(layer).alias("layer"), _listed(domains).alias("domains"))
        for section, layer, domains in [*((s, 5, d) for s, d in (built_in or {}).items()), (ALL, 6, fallback)] if domains])
    if fallback or any((built_in or {}).values()):
        own_lists = F.filter(constant, lambda c: c["of"].isin(ALL) | (c["of"] == F.col("section")))
        listed = disciplines.select(*KEY, F.explode(own_lists).alias("c")).select(*KEY, "c.layer", F.posexplode("c.domains").alias("pos", "domain"))
        layers = layers.unionByName(listed.select(*KEY, F.col("pos").cast("bigint").alias("pos"), "domain", "layer"))
    return layers.groupBy(*KEY, "domain").agg(F.min(F.struct("layer", "pos")).alias("place")).select(
        *KEY, "domain", "place.layer", "place.pos")


def layers_used(cascaded: DataFrame) -> DataFrame:
    """Layers that gave at least one domain of their own, before exclusions."""
    return cascaded.groupBy(*KEY).agg(F.array_sort(F.collect_set("layer")).alias("layers"))


def without_excluded(cascaded: DataFrame) -> DataFrame:
    """Exclusions take their domain out; the exclusion entry itself stays."""
    negatives = cascaded.where(F.col("domain").startswith("-")).select(*KEY, F.expr("substr(domain, 2)").alias("domain"))
    return cascaded.join(negatives, [*KEY, "domain"], "left_anti")


def capped(remaining: DataFrame, cap: int = MAX_DOMAINS) -> DataFrame:
    """Add kept: whether the domain is among the first `cap` of its key.

    The ranking keeps at most `cap` rows per key on both sides of its shuffle;
    all other rows are compared with the last kept place of their key.
    """
    place = F.struct("layer", "pos", "domain")
    order = Window.partitionBy(*KEY).orderBy("layer", "pos", "domain")
    last = (
        remaining.withColumn("n", F.row_number().over(order)).where(F.col("n") <= cap)
        .groupBy(*KEY).agg(F.max(place).alias("last"))
    )
    return remaining.join(last, list(KEY)).withColumn("kept", place <= F.col("last")).drop("last")


def resolved(capped_domains: DataFrame) -> DataFrame:
    """One row per key: the kept domains in order (at most the cap) and the number dropped."""
    kept = F.when(F.col("kept"), F.struct("layer", "pos", "domain"))
    return capped_domains.groupBy(*KEY).agg(
        F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["domain"]).alias("domains"),
        F.count_if(~F.col("kept")).alias("dropped"),
    )


def report(capped_domains: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per declared discipline and section, those that got no domain too."""
    keys = declared(rules).select("discipline", F.explode(_sections()).alias("section"))
    return keys.join(capped_domains, list(KEY), "left").groupBy(*KEY).agg(
        F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("dropped")
    ).withColumn("status", F.when((F.col("dropped") > 0) | (F.col("kept") == 0), "warn").otherwise("ok"))


def allowlist(rules: DataFrame, fallback=(), built_in=None) -> DataFrame:
    """Every domain named anywhere, in the sections' built-in lists too; exclusions neither appear nor take anything out."""
    named = rules.select("domain")
    constant = [*fallback, *(d for domains in (built_in or {}).values() for d in domains)]
    if constant:
        named = named.unionByName(rules.sparkSession.range(1).select(F.explode(_listed(constant)).alias("domain")))
    return named.where(~F.col("domain").startswith("-")).distinct()


def off_domain(sources: DataFrame, allowed: DataFrame, host: str = "host") -> DataFrame:
    """Sources whose host is neither allowed nor below an allowed domain, for lists of any size.

    Hosts are made distinct first, so a host that fills a third of the sources
    meets the list once; the verdict comes back by a join that adaptive execution
    may broadcast or split.
    """
    hosts = sources.select(host).distinct()
    suffixes = hosts.select(host, F.explode(T.host_suffixes(F.col(host))).alias("domain"))
    fine = suffixes.join(allowed.select("domain"), "domain", "left_semi").select(host).distinct()
    return sources.join(fine, host, "left_anti")
