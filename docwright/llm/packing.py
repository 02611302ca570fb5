"""Best-fit packing of token sequences by exact-complement hashing.

Pieces of equal length are alike, so the plan is made from the counts of the 1,024 lengths and is as small for any number of
documents. From the longest length down, the gap it leaves is looked up among the lengths that are left: one, a pair or a triple
that fills it exactly is consumed as often as the counts allow. What has no exact complement is placed best fit, longest first,
in the fullest sequence that still takes it, and the plan of fewest sequences among a few orders of filling is taken. The plan is a table of runs: for each length and place, which ordinals go where.
Spark numbers the pieces of each length, over buckets so that a frequent length is no single group, and joins the runs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docwright.llm.common import slices, stored, text_or_empty
from docwright.llm.tokens import coder

SEQUENCE_TOKENS, END_ID = 1024, 2
BUCKET_ROWS = 100_000
Pattern = tuple[int, ...]


def complement(counts: np.ndarray, gap: int, most: int = 3) -> Pattern | None:
    """One, two or three lengths (at most `most`), all available, that together have exactly this length; the longest first."""
    if counts[gap]:
        return (gap,)
    if most < 2:
        return None
    a = np.arange(gap - 1, (gap - 1) // 2, -1)
    b = gap - a
    fits = np.flatnonzero((counts[a] > 0) & (counts[b] > (a == b)))
    if len(fits):
        return int(a[fits[0]]), int(b[fits[0]])
    if most < 3:
        return None
    for first in range(gap - 2, (gap - 1) // 3, -1):
        if not counts[first]:
            continue
        rest = gap - first
        b = np.arange(min(first, rest - 1), (rest - 1) // 2, -1)
        c = rest - b
        need_b, need_c = 1 + (b == first), 1 + (c == b) + (c == first)
        fits = np.flatnonzero((counts[b] >= need_b) & (counts[c] >= need_c))
        if len(fits):
            return first, int(b[fits[0]]), int(c[fits[0]])
    return None


def exact(lengths: dict[int, int], size: int, rounds: tuple[int, ...]) -> list[tuple[Pattern, int]]:
    """For each round, from the longest length down, gaps are filled exactly by up to that many pieces; the rest goes best fit."""
    counts = np.zeros(size + 1, dtype=np.int64)
    for n, c in lengths.items():
        counts[n] = c
    made = [((size,), int(counts[size]))] if counts[size] else []
    counts[size] = 0
    for most in rounds:
        for length in range(size - 1, 0, -1):
            while counts[length]:
                counts[length] -= 1
                found = complement(counts, size - length, most)
                counts[length] += 1
                if found is None:
                    break
                pattern = (length, *found)
                times = min(int(counts[n]) // k for n, k in Counter(pattern).items())
                for n in pattern:
                    counts[n] -= times
                made.append((pattern, times))
    return made + best_fit({int(n): int(counts[n]) for n in np.flatnonzero(counts)}, size)


def plan(lengths: dict[int, int], size: int = SEQUENCE_TOKENS) -> list[tuple[Pattern, int]]:
    """Patterns of lengths with how many sequences have each; all pieces are used.

    Filling by pairs and triples everywhere can spend the short pieces that long ones need, so the counts are planned with one, two
    and three pieces a gap, and the plan of fewest sequences is taken.
    """
    plans = [exact(lengths, size, rounds) for rounds in ((3,), (1, 2, 3), (1, 2), (1,), ())]
    return min(plans, key=lambda made: sum(times for _, times in made))


def best_fit(lengths: dict[int, int], size: int) -> list[tuple[Pattern, int]]:
    open_bins: dict[int, list[list]] = {}
    for length in sorted(lengths, reverse=True):
        left = lengths[length]
        while left:
            gap = min((g for g in open_bins if g >= length and open_bins[g]), default=None)
            if gap is None:
                each = min(size // length, left)
                times = left // each
                open_bins.setdefault(size - each * length, []).append([(length,) * each, times])
                left -= times * each
                continue
            pattern, times = open_bins[gap].pop()
            used = min(times, left)
            if times > used:
                open_bins[gap].append([pattern, times - used])
            open_bins.setdefault(gap - length, []).append([(*pattern, length), used])
            left -= used
    return [(pattern, times) for bins in open_bins.values() for pattern, times in bins]


def runs(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first ordinal, end ordinal, sequence of the first, offset)."""
    used: Counter[int] = Counter()
    rows, base = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], used[length] + times, base, offset))
            used[length] += times
            offset += length
        base += times
    return rows


def _cut(path: str, size: int, end_id: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            ids, offsets = coder(path).encode_with_added(part.column("text"))
            rows: list[list] = [[], [], [], [], []]
            end = np.array([end_id], dtype="<u4").tobytes()
            for at in range(part.num_rows):
                own = ids[offsets[at]:offsets[at + 1]].astype("<u4").tobytes() + end
                total = len(own) // 4
                borders = [0, *range(total % size or size, total + 1, size)] if total > size else [0, total]
                for piece, (a, b) in enumerate(zip(borders[:-1], borders[1:], strict=True)):
                    for column, value in zip(rows, (at, piece, a, b - a, zlib.crc32(own[4 * a:4 * b])), strict=True):
                        column.append(value)
            yield pa.record_batch({
                "doc_id": part.column("doc_id").take(pa.array(rows[0], pa.int64())),
                **{n: pa.array(v, pa.int64()) for n, v in zip(("piece", "start", "length", "ids_crc32"), rows[1:], strict=True)}})
    return cut


def pieces(documents: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """The pieces of each document: its ids and the end id; only what is longer than a sequence is cut, short piece first."""
    return documents.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(
        _cut(tokenizer, size, end_id), "doc_id long, piece long, start long, length long, ids_crc32 long")


def pack(documents: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its sequence_id and its offset there.

    A null or empty text is the end id alone. Repeated rows and null ids are packed like any others, each row by itself.
    Extra columns are not read. An empty table gives no sequences.
    """
    spark = documents.sparkSession
    cut = stored(pieces(documents, tokenizer, size, end_id), "pack-pieces")
    lengths = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `size` rows
    buckets = max(1, sum(lengths.values()) // BUCKET_ROWS)
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("length", "_bucket", (F.sum("n").over(W.partitionBy("length").orderBy("_bucket")) - F.col("n")).alias("_before"))
    numbered = dealt.withColumn("_row", F.row_number().over(W.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    numbered = numbered.join(before, ["length", "_bucket"]).withColumn("_ordinal", F.col("_row") + F.col("_before"))
    table = spark.createDataFrame(runs(plan(lengths, size)), "length long, _from long, _to long, _base long, offset long")
    placed = numbered.join(F.broadcast(table), "length").where("_ordinal >= _from AND _ordinal < _to")  # a few runs for each length
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_base") + F.col("_ordinal") - F.col("_from")).alias("sequence_id"), "offset")
