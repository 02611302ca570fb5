"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by the hash of the text, then that of the id, then that of the row's place, so equal texts stand together. For each splitter Spark
counts, exactly and over all partitions, the bytes below a set of probes; the interval that holds the target is narrowed to the
keys that lie in it and probed again, until the bytes below a probe meet the tolerance. Probes fall between groups of equal
texts as long as such a place will do; only a group larger than the tolerance is cut. Then the documents are exchanged once.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docwright.llm.common import stored, text_or_empty

SHARDS, ROW_BYTES = 24, 8
TOLERANCE, PROBES = 0.005, 31
BUCKET_BYTES = 128 << 20
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
_HALF = 1 << 64
_LOW = (1 << 32) - 1


def sized(documents: DataFrame) -> DataFrame:
    """The documents with all their columns, and size, text_crc32 and the two parts of the key (_k1, _k2) of each.

    The second part holds 32 bits of the id's hash, then 32 bits of the hash of the row's place: rows that agree in text and id
    have keys of their own, and which of them is where makes no difference. The keys are stored before they are used."""
    text = text_or_empty("text")
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(_LOW))
    return documents.withColumns({
        "size": (F.octet_length(text) + ROW_BYTES).cast("long"), "text_crc32": F.crc32(text),
        "_k1": F.xxhash64(text), "_k2": F.xxhash64("doc_id").bitwiseAND(F.lit(~_LOW)).bitwiseOR(place)})


def _unsigned(column: pa.Array) -> np.ndarray:
    """The order of signed values kept in unsigned ones."""
    return column.to_numpy().view(np.uint64) ^ np.uint64(1 << 63)


def below(probes: list[int], k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """How many of the sorted probes are not above each key."""
    high, low = (np.array([f(p) for p in probes], dtype=np.uint64) for f in (lambda p: p // _HALF, lambda p: p % _HALF))
    first, found = np.searchsorted(high, k1, "left"), np.searchsorted(high, k1, "right")
    for at in np.unique(first[first < found]).tolist():
        rows = np.flatnonzero((first == at) & (first < found))
        end = int(found[rows[0]])
        found[rows] = at + np.searchsorted(low[at:end], k2[rows], "right")
    return found


def _histogram(probes: list[int]):
    """Bytes and the least and greatest key between each two probes, for a partition."""
    def count(batches):
        held: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            k1, k2, size = _unsigned(batch.column("_k1")), _unsigned(batch.column("_k2")), batch.column("size").to_numpy()
            place = below(probes, k1, k2)
            order = np.lexsort((k2, k1, place))
            borders = np.flatnonzero(np.diff(place[order], prepend=-1))
            sums, ends = np.add.reduceat(size[order], borders), np.append(borders[1:], len(order)) - 1
            for b, total, a, z in zip(place[order][borders].tolist(), sums.tolist(), order[borders].tolist(), order[ends].tolist(), strict=True):
                low, high = int(k1[a]) * _HALF + int(k2[a]), int(k1[z]) * _HALF + int(k2[z])
                old = held.setdefault(b, [0, low, high])
                held[b] = [old[0] + total, min(old[1], low), max(old[2], high)]
        if held:
            yield pa.record_batch({
                "place": pa.array(list(held)), "bytes": pa.array([v[0] for v in held.values()], pa.int64()),
                **{n: pa.array([v[at].to_bytes(16, "big") for v in held.values()], pa.binary()) for at, n in ((1, "low"), (2, "high"))}})
    return count


def _probes(low: int, high: int) -> set[int]:
    """Evenly spread keys in the interval, between groups while there are several, else inside the one; and the interval's ends."""
    if low // _HALF != high // _HALF:
        first, last = low // _HALF + 1, high // _HALF
        spread = {(first + (last - first) * k // (PROBES - 1)) * _HALF for k in range(PROBES)}
    else:
        spread = {low + 1 + (high - low) * k // (PROBES - 1) for k in range(PROBES)}
    return {p for p in spread | {low, high + 1} if p < _HALF * _HALF}


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """Keys such that the bytes below the s-th are within the tolerance of s / shards of all, or as near as whole keys allow."""
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if not total:
        return []
    allowed = tolerance * total / shards
    targets = {s: total * s / shards for s in range(1, shards)}
    intervals, done = {s: (0, _HALF * _HALF - 1) for s in targets}, {}
    while len(done) < len(targets):
        probes = sorted({p for s, (low, high) in intervals.items() if s not in done for p in _probes(low, high)})
        rows = keys.mapInArrow(_histogram(probes), "place long, bytes long, low binary, high binary").groupBy("place").agg(
            F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high")).collect()  # one row per probe
        found = {r["place"]: r for r in rows}
        sums = np.cumsum([found[at]["bytes"] if at in found else 0 for at in range(len(probes))])  # below each probe
        for s, target in targets.items():
            if s in done:
                continue
            at = int(np.searchsorted(sums, target, "right"))  # the target lies between probe at - 1 and probe at
            ends = [(abs(float(sums[e]) - target), probes[e]) for e in (at - 1, at) if 0 <= e < len(probes)]
            near = min(ends)
            low, high = (int.from_bytes(found[at][n], "big") for n in ("low", "high"))
            if near[0] <= allowed:
                done[s] = near[1]
            elif low == high:
                under = float(sums[at - 1]) if at else 0.0
                done[s] = low if target - under <= under + found[at]["bytes"] - target else low + 1
            else:
                intervals[s] = (low, high)
    return [done[s] for s in sorted(done)]


def _shard_of(splits: list[int]) -> Column:
    """How many of the splitters are not above a row's key."""
    signed = lambda part: part - (_HALF >> 1)  # the order of unsigned values kept in signed ones
    at = [(F.lit(signed(p // _HALF)), F.lit(signed(p % _HALF))) for p in splits]
    passed = [F.when((F.col("_k1") > high) | ((F.col("_k1") == high) & (F.col("_k2") >= low)), 1).otherwise(0) for high, low in at]
    return reduce(Column.__add__, passed, F.lit(0)).cast("int")


def shard(documents: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The documents, whole and with all their columns, in shards of nearly equal bytes; ADDED names the columns that are added.

    A size is the UTF-8 bytes of the text (null: none) plus 8. Slots number a shard's rows from 0 without gaps. Rows of one text
    stay in one shard unless that would break the tolerance; then they are cut apart, repeated rows too.
    Null ids are ids like others. An empty table gives no rows. Columns of the documents that have one of these names are replaced.
    """
    rows = stored(sized(documents), "shard-rows")
    keys = rows.select("_k1", "_k2", "size")
    total = keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(1, -(-int(total) // (shards * bucket_bytes)))  # of a shard; each is one group of the exchange
    place = {"shard": _shard_of(splitters(keys, shards, tolerance)), "_bucket": F.pmod(F.xxhash64("_k1", "_k2"), F.lit(buckets))}
    counts = keys.withColumns(place).groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "_bucket", (F.sum("n").over(W.partitionBy("shard").orderBy("_bucket")) - F.col("n")).alias("_before"))
    numbered = rows.withColumns(place).withColumn("_row", F.row_number().over(W.partitionBy("shard", "_bucket").orderBy("_k1", "_k2")) - 1)
    added = {"law": F.lit("bytes"), "slot": (F.col("_row") + F.col("_before")).cast("long"), "grown_shard": F.lit(None).cast("int")}
    return numbered.join(F.broadcast(before), ["shard", "_bucket"]).withColumns(added).select(
        *[c for c in documents.columns if c not in ADDED], *ADDED)
