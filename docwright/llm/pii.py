"""Personal data by bootstrapped contextual extraction, in DataFrame functions alone.

1. Base rules find e-mail addresses, IP addresses, card and phone numbers with their places in the whole text.
2. These seeds induce lexical patterns: the word before a seed, with the seed's kind. The graph of patterns and instances is a
   table of edges; instances are the seeds and all other tokens that look like identifiers (an @, or five digits and more).
3. A pattern's score is the weight of the instances after it over all occurrences of its word in the corpus; it counts when
   enough different instances support it, seeds or those accepted in the round before. An unseen instance's score is the
   noisy-or of the patterns before it. Both are computed in turn, so accepted instances induce new patterns, for a few rounds
   at least and on until a round brings no new pattern and scores stand still. They never fall, so this ends.
4. Unseen instances of high score become spans wherever they stand. Spans of the base rules always stay.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docwright.llm.common import stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: The base rules. Possessive forms and the look-behinds find the same matches, in linear time and without deep recursion.
RULES = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_BYTE_OR_ZERO = rf"(?:{_BYTE}|0++)"
_SPAN = "struct<kind:string,start:int,end:int,value:string,left:string>"
CONTEXT_CHARS = 64
BROADCAST_WORDS = 100_000
MIN_SEEDS, MIN_SCORE, ROUNDS = 3, 0.5, 3
STILL = 0.01  # rise of the sum of all scores of patterns below which a round without a new one is the last


def _luhn(digits: Column) -> Column:
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_BYTE_OR_ZERO}(?:\.{_BYTE_OR_ZERO}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _none() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def _spans(text: Column, rule: str, kind: str, valid, core=None) -> Column:
    """The valid matches of the rule with their places in code points, and the word before each. `core` trims a match."""
    matches = F.regexp_extract_all(text, F.lit(rule), F.lit(0))
    pairs = F.arrays_zip(matches.alias("m"), F.split(text, rule, -1).alias("p"))

    def add(state: Column, pair: Column) -> Column:
        match, piece = pair["m"], pair["p"]
        start = state["at"] + F.length(piece)
        value = core(match) if core else match
        first = start + (F.instr(match, value) - 1 if core else 0)
        before = F.right(F.concat(state["tail"], piece), F.lit(CONTEXT_CHARS))
        left = F.lower(F.regexp_extract(F.concat(before, F.left(match, F.instr(match, value) - 1)) if core else before, r"(\S++)\s++$", 1))
        span = F.struct(F.lit(kind).alias("kind"), first.alias("start"), (first + F.length(value)).alias("end"), value.alias("value"), left.alias("left"))
        keep = F.when(valid(value), F.concat(state["list"], F.array(span.cast(_SPAN)))).otherwise(state["list"])
        return F.when(match.isNull(), state).otherwise(F.struct(
            (start + F.length(match)).alias("at"), F.right(F.concat(before, match), F.lit(CONTEXT_CHARS)).alias("tail"), keep.alias("list")))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), _none().alias("list"))
    return F.aggregate(pairs, first, add, lambda s: s["list"])


def _base(text: Column, kind: str) -> Column:
    has = text.rlike("[0-9]") if kind != "email" else text.contains("@")
    if _NEEDS[kind] and kind != "email":
        has = has & text.contains(_NEEDS[kind])
    return F.when(has, _spans(text, RULES[kind], kind, lambda v: _valid(kind, v))).otherwise(_none())


def _tokens(text: Column) -> Column:
    """What looks like an identifier: it has an @, or five digits and more."""
    core = lambda v: F.regexp_replace(v, r"^[^A-Za-z0-9+]++|[^A-Za-z0-9]++$", "")
    likely = lambda v: (F.length(_digits(v)) >= 5) | (v.contains("@") & (F.length(v) >= 6))
    return F.when(text.rlike("[0-9@]"), _spans(text, _TOKEN, "unseen", likely, core)).otherwise(_none())


def scan(documents: DataFrame, keep_rows: bool = False) -> DataFrame:
    """(id, doc_id, base, unseen[, row]): spans of the base rules, and the other tokens that look like identifiers."""
    columns = [F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")] if keep_rows else []
    texts = documents.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"), *columns)
    found = texts.select("doc_id", *(["row"] if keep_rows else []), *[_base(F.col("text"), k).alias(k) for k in KINDS], _tokens(F.col("text")).alias("tokens"))
    base = found.withColumn("base", F.concat(*KINDS))
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))
    return stored(base.select(F.monotonically_increasing_id().alias("id"), "doc_id", "base", free.alias("unseen"), *(["row"] if keep_rows else [])), "pii-scan")


def word_counts(documents: DataFrame, words: DataFrame) -> DataFrame:
    """How often each of the given words stands in all texts. Up to BROADCAST_WORDS words go to every task; more of them are joined by exchange."""
    every = documents.select(F.explode(F.split(F.lower(text_or_empty("text")), r"\s+")).alias("left"))
    words = stored(words, "pii-words")
    if words.count() <= BROADCAST_WORDS:
        return every.join(F.broadcast(words), "left", "left_semi").groupBy("left").agg(F.count(F.lit(1)).alias("total"))
    return every.groupBy("left").agg(F.count(F.lit(1)).alias("total")).join(words, "left", "left_semi")


def discover(documents: DataFrame, scanned: DataFrame) -> DataFrame:
    """(value, kind): unseen identifiers of high score, with the kind that scores highest."""
    each = scanned.select(F.explode(F.concat("base", "unseen")).alias("s")).where("s.left <> ''")
    edges = stored(each.groupBy("s.left", "s.kind", "s.value").agg(F.count(F.lit(1)).alias("n")), "pii-edges")
    seeds = edges.where("kind <> 'unseen'").select("left", "kind", "value", F.col("n").cast("double").alias("weight"))
    possible = edges.groupBy("left").agg(F.count(F.lit(1)).alias("values")).where(F.col("values") >= MIN_SEEDS).select("left")
    totals = stored(word_counts(documents, possible), "pii-totals")  # of all words that can become patterns in any round
    seeds = stored(seeds.join(totals.select("left"), "left", "left_semi"), "pii-seeds")
    unseen = stored(edges.where("kind = 'unseen'").select("left", "value", "n").join(totals.select("left"), "left", "left_semi"), "pii-unseen")
    support, scores, passed, total = seeds, None, -1, 0.0
    for turn in itertools.count(1):
        patterns = support.groupBy("left", "kind").agg(F.sum("weight").alias("weight"), F.count_distinct("value").alias("support")).where(F.col("support") >= MIN_SEEDS)
        scored = stored(patterns.join(totals, "left").select("left", "kind", F.least(F.lit(0.99), F.col("weight") / F.col("total")).alias("p")), "pii-patterns")
        good = scored.where(F.col("p") >= MIN_SCORE)
        before, (passed, total) = (passed, total), scored.agg(F.count_if(F.col("p") >= MIN_SCORE), F.coalesce(F.sum("p"), F.lit(0.0))).first()
        if turn > ROUNDS and passed == before[0] and total - before[1] < STILL:
            break
        scores = stored(unseen.join(good, "left").groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log(1 - F.col("p"))))).alias("score")), "pii-scores")
        support = seeds.unionByName(unseen.join(scores, "value").select("left", "kind", "value", (F.col("n") * F.col("score")).alias("weight")))
    return scores.groupBy("value").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))


def find(documents: DataFrame, keep_rows: bool = False) -> DataFrame:
    """(doc_id, base, spans[, row]): spans as (kind, start, end) in code points, end exclusive, by start and then kind.

    A null text counts as empty and has no spans. Repeated rows and null ids each keep a row of their own; other columns are
    read only to be carried in `row`, so their names cannot clash.
    """
    scanned = scan(documents, keep_rows)
    tokens = scanned.select("id", F.explode("unseen").alias("s"))
    found = tokens.join(discover(documents, scanned), tokens["s.value"] == F.col("value")).select("id", F.struct(
        F.col("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.value").alias("value"), F.col("s.left").alias("left")).cast(_SPAN).alias("s"))
    more = found.groupBy("id").agg(F.collect_list("s").alias("more"))  # bounded by the text it comes from
    both = scanned.join(more, "id", "left")
    in_order = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return both.select("doc_id", in_order(F.col("base")).alias("base"), in_order(F.concat("base", F.coalesce("more", _none()))).alias("spans"), *(["row"] if keep_rows else []))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or each run of overlapping spans, as the kind of its first one in brackets."""
    def add(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(state["out"]).alias("out"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, first, add, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))))
