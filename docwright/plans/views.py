"""Inputs of the registered queries, derived from the given tables.

The given tables hold orders, events and texts, not course documents. Each view
here turns them into one of the engine's inputs: the nested documents, the
catalogue, the registries, the attempt log, the responses and the publish log.

A document is one order that has lines. Its lines are first folded to at most
16 slots, so an order of any number of lines becomes an array of bounded size
and no line is left out.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docwright.functions import text as T
from docwright.functions.numbers import salary_position
from docwright.sources.tables import table

SLOTS = 16

#: What is joined to every document is sent to all executors up to this size, counted first; what is larger is joined by exchange.
SENT_BYTES = 64 << 20

#: Order lines that a task folds and gathers at most on average, so that it does so in memory and nothing is spilled.
LINES_A_TASK = 200_000

LINE_FIELDS = ("sk", "pk", "fee", "lo", "hi", "flag", "st")
NAME_FIELDS = ("p_name", "p_type", "p_brand", "s_name")

#: What each property takes of its order's lines besides their slots; what is not here takes nothing more.
FIELDS_OF = {
    "slug": ("p_name",), "course_name": ("p_name",), "seo": ("p_name",), "overview": ("p_name",), "category": ("p_type",), "subcategory": ("p_brand",),
    "quick_facts": ("fee", "lo"), "snapshot": ("fee",), "curriculum": ("pk", "p_name", "p_type"), "careers": ("flag", "st", "p_name"),
    "recruiters": ("sk", "s_name"), "fees": ("sk", "pk", "lo", "hi", "flag", "st"), "colleges": ("fee", "flag", "p_name", "s_name"),
    "comparison": ("p_name",),
}

LEVELS = ("Undergraduate", "Postgraduate", "Diploma", "Certificate", "Doctoral", "Foundation")
FREQUENCIES = ("Per year", "Per semester", "One time", "Total programme", "As required")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _texts(*values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def every(n: int, rest: int = 0, key: str = "k") -> Column:
    return F.col(key) % n == rest


# -- documents ---------------------------------------------------------------

def lines(spark: SparkSession, sf: str, parts: int, fields=LINE_FIELDS) -> DataFrame:
    """One row per order and slot: k, slot, sk, pk and those of fee, lo, hi, flag, st that are asked for. The rows of an order stand in
    one of the partitions.

    Lines are exchanged once, by order, and folded to slots where they arrive, by an aggregate that holds one row a slot. They travel
    packed (`packed`), since their exchange is most of what documents put on local disk."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
               "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    price = F.col("l_extendedprice")
    whole = lambda c: F.floor(c).cast("bigint")
    rows = li.select(
        F.col("l_orderkey").alias("k"), (F.col("l_linenumber") % SLOTS).cast("bigint").alias("slot"),
        F.col("l_suppkey").alias("sk"), F.col("l_partkey").alias("pk"), whole(price).alias("fee"),
        whole(price * (1 - F.col("l_discount"))).alias("lo"), whole(price * (1 + F.col("l_tax"))).alias("hi"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("st"))
    wanted = lambda names: [c for c in names if c in ("sk", "pk", *fields)]
    least, most = wanted(("sk", "pk", "lo", "flag")), wanted(("fee", "hi", "st"))
    moved = unpacked(packed(rows.select("k", "slot", *least, *most)).repartition(parts, "k"))
    folded = moved.groupBy("k", "slot").agg(*[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in most])
    return folded.withColumn("fee", F.col("fee") * F.when(F.col("k") % 53 == 0, 100).otherwise(1)) if "fee" in most else folded


#: How a line travels: names, and how many bits of a long each takes. Texts of one ASCII letter take seven.
PACKS = (("keys", (("pk", 32), ("sk", 31))), ("sums", (("fee", 29), ("lo", 17), ("hi", 17))), ("marks", (("slot", 4), ("flag", 7), ("st", 7))))


def packed(rows: DataFrame) -> DataFrame:
    """k with the other columns of a line in up to three longs. A line that does not fit travels in the struct `wide` as it is.

    lo and hi are written as their distance from fee where fee is there."""
    names = [c for c in rows.columns if c != "k"]
    value = {c: F.col(c) for c in names} | {c: F.when(F.length(c) == 1, F.ascii(c)).cast("bigint") for c in names if c in ("flag", "st")}
    if "fee" in names:
        value |= {c: (F.col("fee") - F.col(c) if c == "lo" else F.col(c) - F.col("fee")) for c in names if c in ("lo", "hi")}
    fits, longs = F.lit(True), []
    for pack, parts in PACKS:
        total = None
        for name, bits in parts:
            if name in names:
                fits &= F.coalesce(value[name].between(0, 2 ** bits - 1), F.lit(False))
                total = value[name] if total is None else F.shiftleft(total, bits).bitwiseOR(value[name])
        if total is not None:
            longs.append((pack, total))
    wide = F.struct(*names)
    return rows.select("k", *[F.when(fits, total).alias(pack) for pack, total in longs], F.when(~fits, wide).alias("wide"))


def unpacked(rows: DataFrame) -> DataFrame:
    names, value = rows.schema["wide"].dataType.names, {}
    for pack, parts in PACKS:
        below = 0
        for name, bits in reversed(parts):
            if name in names:
                value[name] = F.shiftright(pack, below).bitwiseAND(F.lit(2 ** bits - 1).cast("bigint"))
                below += bits
    if "fee" in names:
        value |= {c: (value["fee"] - value[c] if c == "lo" else value["fee"] + value[c]) for c in names if c in ("lo", "hi")}
    value |= {c: F.char(value[c]) for c in names if c in ("flag", "st")}
    return rows.select("k", *[F.when(F.col("wide").isNull(), value[c]).otherwise(F.col(f"wide.{c}")).alias(c) for c in names])


def sent(frame: DataFrame) -> DataFrame | None:
    """The frame marked for sending to all executors; None if its values are too many for that."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in frame.columns), F.lit(8))
    total = frame.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return F.broadcast(frame) if total <= SENT_BYTES else None


def small_first(base: DataFrame, joins) -> DataFrame:
    """base with each frame of joins (frame, condition, how): first those that are sent and move no row of base, then the others."""
    marked = [(sent(frame), frame, condition, how) for frame, condition, how in joins]
    for small, _, condition, how in marked:
        base = base if small is None else base.join(small, condition, how)
    for small, frame, condition, how in marked:
        base = base.join(frame, condition, how) if small is None else base
    return base


def named_lines(spark: SparkSession, sf: str, parts: int, fields=LINE_FIELDS + NAME_FIELDS) -> DataFrame:
    """lines with those part and supplier names that are asked for, in a number of partitions by k that is kept."""
    names = [c for c in NAME_FIELDS if c in fields]
    part = table(spark, sf, "part", "p_partkey", *[c for c in names if c.startswith("p_")])
    supplier = table(spark, sf, "supplier", "s_suppkey", *[c for c in names if c.startswith("s_")])
    frames, rows = [sent(part), sent(supplier)], lines(spark, sf, parts, fields)
    rows = rows.join(part if frames[0] is None else frames[0], F.col("pk") == F.col("p_partkey")).join(supplier if frames[1] is None else frames[1], F.col("sk") == F.col("s_suppkey"))
    rows = rows.drop("p_partkey", "s_suppkey")
    return rows.repartition(parts, "k") if None in frames else rows  # names that are sent move no line


def text_count(spark: SparkSession, sf: str, name: str) -> int:
    """Number of rows, from the Parquet footers."""
    return table(spark, sf, name).count()


def page_windows(spark: SparkSession, sf: str, n_pages: int) -> DataFrame:
    """Per page, the addresses of this page and the three after it."""
    pages = table(spark, sf, "pages", "page_id", "url")
    return (
        pages.select(F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j"), "page_id", "url")
        .groupBy(F.pmod(F.col("page_id") - F.col("j"), F.lit(n_pages)).alias("start_page"))
        .agg(F.array_sort(F.collect_list(F.struct("j", "url"))).alias("window"))
    )


TEXT_SECTIONS = frozenset({"overview", "parent_corner"})

ALL_PROPERTIES = (
    "course_id", "slug", "course_name", "course_level", "category", "subcategory", "currency",
    "region", "seo", "hero", "quick_facts", "snapshot", "overview", "suitability", "eligibility",
    "curriculum", "skills", "careers", "recruiters", "further_study_pathway", "fees", "colleges",
    "comparison", "action_roadmap", "parent_corner", "faqs", "verification",
)

_LINE_60 = "Figures describe the usual range for this course and are reviewed once in every year."


def document_base(spark: SparkSession, sf: str, properties=ALL_PROPERTIES) -> DataFrame:
    """One row per order with lines; joins only what the properties need."""
    wanted = set(properties)
    fields = [c for c in LINE_FIELDS + NAME_FIELDS if any(c in FIELDS_OF.get(p, ()) for p in wanted)]
    item = F.struct("slot", *fields)
    # The exchange the grouping needs anyway, with a number of partitions that is kept:
    # building a document costs far more than its bytes tell adaptive coalescing.
    # There are as many as the lines need, however few are configured.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-text_count(spark, sf, "lineitem") // LINES_A_TASK))
    grouped = (
        named_lines(spark, sf, parts, fields)
        .groupBy("k")
        .agg(F.array_sort(F.collect_list(item)).alias("it"))
    )
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    base = grouped.join(orders, F.col("k") == F.col("o_orderkey")).drop("o_orderkey")
    # Texts are many times larger than the order they are laid beside, so they come last and are not exchanged with it.
    joins = []
    if "verification" in wanted:
        n_pages = text_count(spark, sf, "pages")
        joins.append((page_windows(spark, sf, n_pages), F.col("k") % n_pages == F.col("start_page"), "left"))
    if wanted & TEXT_SECTIONS:
        n_docs = text_count(spark, sf, "documents")
        docs = table(spark, sf, "documents", "doc_id", "text")
        if "overview" in wanted:
            joins.append((docs.select(F.col("doc_id").alias("d1"), F.col("text").alias("body")), F.col("k") % n_docs == F.col("d1"), "left"))
        if "parent_corner" in wanted:
            joins.append((docs.select(F.col("doc_id").alias("d2"), F.col("text").alias("intro")), F.col("o_custkey") % n_docs == F.col("d2"), "left"))
    return small_first(base, joins).drop("start_page", "d1", "d2")


def _point(kind: str, n: int) -> Column:
    return _texts(*[f"{kind} number {i} of the list for this course" for i in range(1, n + 1)])


def property_columns() -> dict[str, Column]:
    """Expression of every root property over document_base rows."""
    k, it = F.col("k"), F.col("it")
    n = F.size(it)
    total = F.col("o_totalprice")
    name = it[0]["p_name"]
    lowest = F.array_min(F.transform(it, lambda x: x["lo"]))
    fee_sum = F.aggregate(it, F.lit(0).cast("bigint"), lambda a, x: a + x["fee"])
    fee_avg = F.floor(fee_sum / n)
    fee_min = F.when(every(13), F.lit(0).cast("bigint")).otherwise(lowest)
    lower = F.floor(total * 0.5)
    higher = F.when(every(61), lower).otherwise(F.floor(total * 1.5) * F.when(every(59), 100).otherwise(1))
    exact_marker = F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce(salary_position(lower, fee_sum, higher), F.lit(50))))
    marker = F.when(every(4), exact_marker).otherwise(k % 101)
    step = lambda x, i: F.when(every(10), x["slot"]).otherwise((i + 1).cast("bigint"))
    badge = lambda x: (
        F.when(x["flag"] == "R", "Postgraduate route")
        .when((x["flag"] == "N") & (x["st"] == "O"), "Higher study required")
        .otherwise("Possible after bachelor's")
    )
    institution = lambda x: F.when(x["flag"] == "A", "government").when(x["flag"] == "R", "private")
    subject = lambda label: F.struct(
        label.alias("name"), F.lit("What students do in this subject over a year").alias("description")
    )
    return {
        "course_id": F.concat(F.lit("crs_"), k.cast("string")),
        "slug": T.catalogue_slug(name),
        "course_name": name,
        "course_level": _pick(LEVELS, k),
        "category": it[0]["p_type"],
        "subcategory": it[0]["p_brand"],
        "currency": F.lit("INR"),
        "region": F.lit("India"),
        "seo": F.struct(
            F.concat(name, F.lit(" course guide")).alias("page_title"),
            F.lit("What the course covers, what it costs and where it can lead afterwards.").alias("meta_description"),
        ),
        "hero": F.struct(
            F.lit("Course guide").alias("badge"),
            F.lit(" ".join(["A plain account of the course for students and their families."] * 3)).alias("summary"),
            F.struct(
                (k % 120).alias("score_percent"),
                F.lit("A fair match for many students").alias("note"),
                _point("Sign", 3).alias("indicators"),
            ).alias("fit"),
        ),
        "quick_facts": F.struct(
            F.struct(
                (F.lit(1) + (k % 9) / 2).alias("min_years"),
                (F.lit(1) + (F.col("o_custkey") % 9) / 2).alias("max_years"),
            ).alias("typical_duration"),
            F.lit("After school").alias("entry_level"),
            F.when(every(7, 3), _texts("Science", "Science")).otherwise(_texts("Science", "Commerce")).alias("suitable_streams"),
            F.lit("Lectures and practice").alias("learning_style"),
            F.struct(
                F.when(every(17), fee_avg).otherwise(fee_min).alias("min"),
                F.when(every(17), fee_min).otherwise(fee_avg).alias("max"),
            ).alias("indicative_annual_fees"),
            F.lit("Work in the field or further study").alias("career_direction"),
        ),
        "snapshot": F.struct(
            F.struct(
                lower.alias("lower_annual"),
                fee_sum.alias("typical_annual"),
                higher.alias("higher_annual"),
                every(2).alias("higher_is_open_ended"),
                marker.alias("marker_percent"),
                F.lit(_LINE_60).alias("note"),
            ).alias("salary"),
            _texts(*[f"Branch {i}" for i in range(1, 9)]).alias("specialisations"),
            F.lit(_LINE_60).alias("data_note"),
        ),
        "overview": F.struct(
            F.when(every(43), F.lit(None).cast("string"))
            .when(every(23), F.lit("What is this course?"))
            .otherwise(F.concat(F.lit("What is "), name, F.lit("?"))).alias("heading"),
            (F.split(F.col("body"), "\n")).alias("paragraphs"),
        ),
        "suitability": F.struct(
            F.struct(F.lit("It may suit you if").alias("heading"), _point("Reason", 4).alias("points")).alias("good_fit"),
            F.struct(F.lit("Think again when").alias("heading"), _point("Warning", 4).alias("points")).alias("caution"),
            _texts(*[f"Tag {i}" for i in range(1, 8)]).alias("tags"),
        ),
        "eligibility": F.struct(
            _point("Requirement", 4).alias("typical_requirements"),
            _point("Method", 4).alias("admission_methods"),
            F.transform(it, lambda x: F.struct(
                x["slot"].alias("step"),
                F.lit("Apply to the college").alias("title"),
                F.lit("Send the form before the last date").alias("description"),
            )).alias("admission_timeline"),
        ),
        "curriculum": F.struct(
            F.transform(it, lambda x, i: F.struct(
                step(x, i).alias("year"),
                F.concat(F.lit("Year "), (i + 1).cast("string")).alias("label"),
                F.array(
                    subject(x["p_name"]),
                    subject(F.concat(x["p_name"], F.lit(" laboratory"))),
                    subject(F.concat(x["p_type"], F.lit(" theory "), x["slot"].cast("string"))),
                    subject(F.concat(F.lit("Project "), (x["pk"] % 10).cast("string"))),
                ).alias("subjects"),
            )).alias("years"),
            F.lit(_LINE_60).alias("learning_activities"),
            F.lit(_LINE_60).alias("assessment_methods"),
        ),
        "skills": F.array(*[
            F.struct(F.lit(f"Skill {i}").alias("name"), F.lit("What this skill is used for").alias("description"))
            for i in range(1, 7)
        ]),
        "careers": F.transform(it, lambda x: F.struct(
            x["p_name"].alias("title"),
            F.lit("What people in this role do on a usual working day").alias("description"),
            badge(x).alias("route_badge"),
            F.lit("Degree, then a first position").alias("typical_route"),
        )),
        "recruiters": F.transform(it, lambda x: F.struct(
            F.when(x["sk"] % 9 == 0, "Su").otherwise("SU").alias("logo_initials"),
            x["s_name"].alias("name"),
            F.lit("Manufacturing").alias("sector"),
            F.lit("A firm that takes on graduates of this course each year").alias("description"),
            F.when(x["sk"] % 8 == 5, _texts("Analyst", "Analyst")).otherwise(_texts("Analyst", "Planner")).alias("roles"),
        )),
        "further_study_pathway": _texts(*[f"Step {i}" for i in range(1, 6)]),
        "fees": F.when(~every(31), F.struct(
            F.transform(it, lambda x: F.struct(
                F.concat(F.lit("Tuition fee "), x["slot"].cast("string")).alias("category"),
                institution(x).alias("institution_type"),
                F.when(x["pk"] % 11 != 0, F.when(x["sk"] % 13 == 0, F.lit(0).cast("bigint")).otherwise(x["lo"])).alias("min"),
                F.when(x["pk"] % 7 != 0, x["hi"] * F.when(every(53), 100).otherwise(1)).alias("max"),
                (x["st"] == "F").alias("is_variable"),
                _pick(FREQUENCIES, x["slot"]).alias("frequency"),
                F.lit("Ask the office for the full list").alias("parent_check"),
            )).alias("rows"),
            F.lit("Charges differ between colleges and between years.").alias("footnote"),
        )),
        "colleges": F.struct(
            F.lit("Own ranking").alias("ranking_source"),
            F.when(every(12, 7), "2024-13").otherwise("2024-05").alias("ranking_updated"),
            F.transform(it, lambda x, i: F.struct(
                step(x, i).alias("rank"),
                x["s_name"].alias("name"),
                F.lit("Pune").alias("city"),
                name.alias("course_name"),
                F.lit(3.0).alias("duration_years"),
                F.when(x["flag"] == "R", "government").otherwise("private").alias("institution_type"),
                F.lit("Entrance test").alias("admission_route"),
                F.lit("Large library").alias("highlight"),
                F.when(~every(41), x["fee"]).alias("annual_fee"),
            )).alias("items"),
            F.lit(_LINE_60).alias("data_note"),
        ),
        "comparison": F.transform(it, lambda x, i: F.struct(
            F.when((i == 0) & every(19), F.concat(x["p_name"], F.lit(" honours"))).otherwise(x["p_name"]).alias("course_name"),
            F.lit("Making and design").alias("main_focus"),
            F.lit("Moderate").alias("statistics_level"),
            F.lit("Weekly").alias("laboratory_exposure"),
            F.lit("Work or a second degree").alias("common_next_steps"),
        )),
        "action_roadmap": F.array(*[
            F.struct(F.lit(stage).alias("stage"), F.lit("Plan ahead").alias("title"),
                     F.lit("Talk with teachers and read about the course at home.").alias("description"))
            for stage in ("Grades 8-10", "Grade 11", "Grade 12")
        ]),
        "parent_corner": F.struct(F.col("intro").alias("intro"), _point("Question", 6).alias("questions")),
        "faqs": F.array(*[
            F.struct(F.lit(f"Common question number {i}?").alias("question"),
                     F.lit(_LINE_60).alias("answer"))
            for i in range(1, 6)
        ]),
        "verification": F.struct(
            F.lit("2024-01-31").alias("last_reviewed"),
            F.transform(F.col("window"), lambda w: F.struct(
                F.concat(F.lit("Source "), w["j"].cast("string")).alias("title"),
                F.when(every(29), F.col("window")[0]["url"]).otherwise(w["url"]).alias("url"),
                F.lit("Publisher").alias("publisher"),
            )).alias("sources"),
        ),
    }


def typed_documents(spark: SparkSession, sf: str, properties=ALL_PROPERTIES) -> DataFrame:
    """k, course_id and doc, a struct of the properties asked for."""
    columns = property_columns()
    base = document_base(spark, sf, properties)
    return base.select(
        "k",
        columns["course_id"].alias("course_id"),
        F.struct(*[columns[p].alias(p) for p in properties]).alias("doc"),
    )


def json_documents(spark: SparkSession, sf: str, properties=ALL_PROPERTIES) -> DataFrame:
    """k, course_id and body, the JSON text, with the planted structural faults.

    fees is absent when k % 31 = 0, a root key is unknown when k % 37 = 0, the
    college fees are text when k % 41 = 0, the heading is a JSON null when
    k % 43 = 0 and the fit score is written 4.0 when k % 47 = 0.
    """
    columns = property_columns()
    full = {"ignoreNullFields": "false"}
    members = []
    for name in properties:
        value = columns[name]
        if isinstance(value, Column):
            scalar = name in ("course_id", "slug", "course_name", "course_level", "category", "subcategory", "currency", "region")
            json = F.to_json(F.struct(value.alias("v")), full) if scalar else F.to_json(value, full)
            text = F.regexp_replace(json, r"(?s)^\{\"v\":(.*)\}\z", "$1") if scalar else json
            if name == "colleges":
                text = F.when(every(41), F.replace(text, F.lit('"annual_fee":null'), F.lit('"annual_fee":"12345"'))).otherwise(text)
            if name == "hero":
                text = F.when(every(47), F.regexp_replace(text, r'"score_percent":\d+', '"score_percent":4.0')).otherwise(text)
            members.append(F.concat(F.lit(f'"{name}":'), text))
    members.append(F.when(every(37), F.lit('"extra_note":"demo value"')))
    return document_base(spark, sf, properties).select(
        "k",
        columns["course_id"].alias("course_id"),
        F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}")).alias("body"),
    )
