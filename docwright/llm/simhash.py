"""SimHash fingerprints of 128 bits and all fingerprints within a Hamming radius, in DataFrame functions alone.

1. A text's terms are its words in lower case (runs of letters and digits); a text without any is one term. Each occurrence
   weighs as much as its term is rare: the rounded log2 of all texts over those that hold it, from 1 to MOST. Terms below the
   cut weigh MOST, so only terms that are in at least one of 2**(MOST - 0.5) texts are looked up: 91 times the mean number of
   distinct terms of a text bounds their number, however many texts there are.
2. A term's two 64-bit hashes vote: each bit gets the weight where it is 1 and loses it where it is 0, and the sign is the
   fingerprint's bit. Two bits are summed in one long (32 bits each), which holds any text of up to 600 million words.
3. Eight blocks of 16 bits. Two fingerprints within radius r agree in at least 8 - r blocks, so a table for each choice of 8 - r
   blocks, permuted to the front as its key, brings each such pair together at least once. A pair counts in the first such
   table only. Equal fingerprints are one row; a hot bucket is cut into parts, and each two parts are one row of two arrays, so
   rows stay few and bounded and no link is lost.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docwright.llm.common import stored, text_or_empty

MOST = 7
BROADCAST_TERMS = 500_000
BLOCKS, BLOCK_BITS, RADIUS = 8, 16, 6
PART = 512
COPIES = 1024  # repeated rows written from one slice of a row
_LANES = 0x0000000100000001


def terms(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]++"), "")
    return F.when(text.rlike(r"[\p{L}\p{N}]"), words).otherwise(F.when(text == "", F.array().cast("array<string>")).otherwise(F.array(text)))


def common_terms(texts: DataFrame) -> DataFrame:
    """(first, weight) of the terms that weigh less than MOST, by the first hash of a term; counted over all rows of `text`."""
    n = texts.count()
    held = texts.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term")).groupBy(F.xxhash64("term").alias("first")).agg(F.count(F.lit(1)).alias("n"))
    weight = F.greatest(F.lit(1), F.round(F.log2(F.lit(float(max(n, 1))) / F.col("n"))).cast("int"))
    return stored(held.select("first", weight.alias("weight")).where(F.col("weight") < MOST), "simhash-terms")


def fingerprints(texts: DataFrame, common: DataFrame, *keys: str) -> DataFrame:
    """(keys, high, low): the fingerprint of the `text` of each row; the keys must tell the rows apart. Rows without a term are left out."""
    words = texts.select(*keys, F.explode(terms(F.col("text"))).alias("term"))
    words = words.select(*keys, F.xxhash64("term").alias("first"), F.xxhash64("term", F.lit(1)).alias("second"))
    small = common.count() <= BROADCAST_TERMS
    weighed = words.join(F.broadcast(common) if small else common, "first", "left").withColumn("weight", F.coalesce("weight", F.lit(MOST)).cast("long"))
    sums = [F.sum(F.shiftrightunsigned(F.col(h), i).bitwiseAND(F.lit(_LANES)) * F.col("weight")).alias(f"{h}{i}") for h in ("first", "second") for i in range(32)]
    voted = weighed.groupBy(*keys).agg(F.sum("weight").alias("total"), *sums)

    def bits(h: str) -> Column:
        votes = {i: F.col(f"{h}{i}").bitwiseAND(F.lit(0xFFFFFFFF)) for i in range(32)} | {i + 32: F.shiftrightunsigned(f"{h}{i}", 32) for i in range(32)}
        return reduce(Column.bitwiseOR, [F.when(2 * v > F.col("total"), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")) for i, v in votes.items()])

    return voted.select(*keys, bits("first").alias("high"), bits("second").alias("low"))


def written(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def distance(a: Column, b: Column) -> Column:
    """Bits in which two structs (high, low) differ."""
    return F.bit_count(a["high"].bitwiseXOR(b["high"])) + F.bit_count(a["low"].bitwiseXOR(b["low"]))


def likeness(a: Column, b: Column) -> Column:
    return 1 - distance(a, b) / F.lit(128.0)


def _block(high: Column, low: Column, at: int) -> Column:
    half = BLOCKS // 2
    return F.shiftrightunsigned(high if at < half else low, BLOCK_BITS * (at % half)).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _parts(distinct: DataFrame, radius: int) -> DataFrame:
    """(table, chosen, below, xs, ys): each two parts of each bucket of two fingerprints and more; ys is null for a part with itself."""
    tables = list(combinations(range(BLOCKS), BLOCKS - radius))
    high, low = F.col("high"), F.col("low")
    rows = [F.struct(
        F.lit(t).alias("table"), F.xxhash64(*[_block(high, low, b) for b in kept]).alias("key"), F.lit(sum(1 << b for b in kept)).alias("chosen"),
        F.lit((1 << max(kept) + 1) - 1).alias("below")) for t, kept in enumerate(tables)]
    posted = distinct.select("high", "low", F.explode(F.array(*rows)).alias("p")).select("high", "low", "p.*")
    sizes = posted.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("table", "key", F.ceil(F.col("n") / PART).alias("parts"))
    # Spark sizes both sides without their tables and would send what is far larger: they are merged.
    dealt = posted.hint("merge").join(sizes.hint("merge"), ["table", "key"]).withColumn("own", F.pmod(F.xxhash64("low", "high"), F.col("parts")))
    held = stored(dealt.groupBy("table", "key", "own").agg(
        F.first("chosen").alias("chosen"), F.first("below").alias("below"), F.first("parts").alias("parts"), F.collect_list(F.struct("high", "low")).alias("xs")), "simhash-buckets")
    alone = held.select("table", "chosen", "below", "xs", F.lit(None).cast("array<struct<high:bigint,low:bigint>>").alias("ys"))
    each = held.where("parts > 1").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).where("own <> other")
    both = each.groupBy("table", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(
        F.first("chosen").alias("chosen"), F.first("below").alias("below"), F.min_by("xs", "own").alias("xs"), F.max_by("xs", "own").alias("ys"), F.count(F.lit(1)).alias("sides"))
    return alone.where(F.size("xs") > 1).unionByName(both.where("sides > 1").select("table", "chosen", "below", "xs", "ys"))


def _linked(radius: int):
    """Whether two fingerprints are within the radius and this table is the first in which they meet."""
    def linked(x: Column, y: Column) -> Column:
        high, low = x["high"].bitwiseXOR(y["high"]), x["low"].bitwiseXOR(y["low"])
        agree = reduce(lambda a, b: a + b, [F.when(_block(high, low, b) == 0, 1 << b).otherwise(0) for b in range(BLOCKS)])
        return distance(x, y).between(1, radius) & (agree.bitwiseAND(F.col("below")) == F.col("chosen"))
    return linked


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(high, low, other_high, other_low): every pair of different fingerprints within the radius, in both directions, once each."""
    linked, parts = _linked(radius), _parts(distinct, radius)
    pairs = lambda xs, ys: F.flatten(F.transform(xs, lambda x: F.transform(F.filter(ys, lambda y: linked(x, y)), lambda y: F.struct(
        x["high"].alias("high"), x["low"].alias("low"), y["high"].alias("other_high"), y["low"].alias("other_low")))))
    found = F.when(F.col("ys").isNull(), pairs(F.col("xs"), F.col("xs"))).otherwise(F.concat(pairs(F.col("xs"), F.col("ys")), pairs(F.col("ys"), F.col("xs"))))
    return parts.select(F.explode(found).alias("p")).select("p.*")


def link_counts(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(high, low, n_links): how many different fingerprints are within the radius, where any is; no pair becomes a row."""
    linked, parts = _linked(radius), _parts(distinct, radius)
    counts = lambda xs, ys: F.transform(xs, lambda x: F.struct(x["high"].alias("high"), x["low"].alias("low"), F.size(F.filter(ys, lambda y: linked(x, y))).alias("n")))
    found = F.when(F.col("ys").isNull(), counts(F.col("xs"), F.col("xs"))).otherwise(F.concat(counts(F.col("xs"), F.col("ys")), counts(F.col("ys"), F.col("xs"))))
    each = parts.select(F.explode(F.filter(found, lambda c: c["n"] > 0)).alias("c")).select("c.*")
    return each.groupBy("high", "low").agg(F.sum("n").alias("n_links"))


def in_turn(groups: DataFrame) -> DataFrame:
    """Rows of (doc_id, key) with the key of the row that follows by descending doc_id (nulls last) and key; the first follows the last.

    The rows are dealt to parts by ranges of this order. Each part is a window of its own, and its last row takes the first row of the
    next part from a table that has one row a part.
    """
    order = [F.col("doc_id").isNull(), F.bitwise_not("doc_id"), F.col("key")]
    ranged = stored(groups.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "simhash-order")
    firsts = ranged.groupBy("_part").agg(F.min_by("key", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("first"))
    turn = Window.orderBy("_part")  # one row for each part
    after = firsts.select("_part", F.coalesce(F.lead("first").over(turn), F.first("first").over(turn.rowsBetween(Window.unboundedPreceding, 0))).alias("after"))
    follows = F.lead("key").over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_follows", follows).join(F.broadcast(after), "_part").select(*groups.columns, F.coalesce("_follows", "after").alias("next_key"))


def edited_pairs(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, class_id, n_links.

    The edited text has its last half (rounded down) replaced by the first code points of the next document, as many or all it has; next is
    by descending doc_id, nulls last, equal ids in order of the MD5 of id and text, and after the last comes the first. class_id is
    the smallest doc_id of equal fingerprints, n_links the number of different fingerprints within the radius. A null text is empty, and an
    empty text is fingerprinted as one blank. Repeated rows are followed by each other and keep a row each. Extra columns are not read.
    """
    text = text_or_empty("text")
    named = F.concat(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")), F.lit(":"), text)
    rows = documents.select(F.unhex(F.md5(named)).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    groups = rows.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("copies"), F.max(F.length("text")).alias("n_chars"))
    turns = stored(in_turn(groups), "simhash-turns")
    texts = rows.select("key", "text").dropDuplicates(["key"])  # dealt by key once; both joins below read that exchange
    heads = texts.join(turns.withColumnRenamed("key", "_key"), F.col("key") == F.col("next_key")).select(
        F.col("_key").alias("key"), "copies", "n_chars", F.expr("left(text, n_chars div 2)").alias("head"))
    kept = F.expr("left(text, n_chars - n_chars div 2)")
    versions = F.array(F.col("text"), F.concat(kept, "head"), F.when(F.col("copies") > 1, F.concat(kept, F.expr("left(text, n_chars div 2)"))))
    joined = texts.join(heads, "key").select("key", F.posexplode(versions).alias("version", "text")).where("text IS NOT NULL")
    joined = joined.select("key", "version", F.unhex(F.sha2("text", 256)).alias("digest"), F.when(F.col("text") == "", " ").otherwise(F.col("text")).alias("text"))
    made = stored(fingerprints(joined, common_terms(rows.select("text")), "key", "version", "digest"), "simhash-fingerprints")
    print_ = F.struct("high", "low")
    per = stored(made.groupBy("key").agg(
        F.max(F.when(F.col("version") == 0, print_)).alias("own"),
        *[F.max(F.when(F.col("version") == v, F.struct(F.lower(F.hex("digest")).alias("sha"), print_.alias("print")))).alias(f"edit{v}") for v in (1, 2)]), "simhash-versions")
    placed = turns.join(per, "key")
    distinct = stored(placed.groupBy("own").agg(F.min("doc_id").alias("class_id")).select("own.*", "class_id"), "simhash-classes")
    classes = distinct.join(link_counts(distinct, radius), ["high", "low"], "left").select("high", "low", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    placed = placed.join(per.select(F.col("key").alias("next_key"), F.col("own").alias("next")), "next_key")
    placed = placed.join(classes, (F.col("own.high") == classes["high"]) & (F.col("own.low") == classes["low"]))
    slices = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))
    each = placed.withColumn("at", F.explode(slices)).withColumn("at", F.explode(F.sequence("at", F.least(F.col("at") + COPIES, "copies") - 1)))
    last = F.col("at") == 0
    return each.withColumns({"edit": F.when(last, F.col("edit1")).otherwise(F.col("edit2")), "next": F.when(last, F.col("next")).otherwise(F.col("own"))}).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.col("edit.sha").alias("edited_sha256"), written(F.col("own.high"), F.col("own.low")).alias("fingerprint"),
        written(F.col("edit.print.high"), F.col("edit.print.low")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edit.print")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"), "class_id", "n_links")
