"""Alignment of two tokenizers over a corpus, by external spill counting.

1. Each text is coded by both vocabularies. A's and B's token ends cut its bytes into segments, each within one token of either side:
   these are its links, and the ends that both share close its groups.
2. A task collects links as numbers (B's id, A's id, document), sorts them, and cuts them by the remainder of B's id into RADIX
   parts. Each part is a run: zstd frames of its pairs with their totals, in order of B's id and then A's, and beside them the
   documents of each pair. Runs are rows of a stored table, so a lost executor loses none that is written.
3. Runs of one part are merged k-way by a heap over the last pairs of their open frames, FAN runs at a time, until one is left: each
   pair's count, and as B's id comes first, the highest count of each B id as it passes. Its size is bounded by the two
   vocabularies, not by the corpus.
4. The runs stream past the counts of their part once more and give each document its share. Only pairs' totals are ever
   brought together, so no pair, however frequent, gathers its documents in one task; the counts are sent to each group of FAN runs.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwright.llm.common import slices, stored, text_or_empty
from docwright.llm.tokens import coder, piece_coder
from docwright.llm.words import text_bytes

RADIX, FAN = 64, 64
RUN_LINKS, RUN_DOCUMENTS = 4_000_000, 1 << 16
FRAME_PAIRS, SLICE_ROWS = 1 << 15, 1 << 12
_ROWS = "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, run long, radix int, totals binary, shares binary"
_RUN = "radix int, slot long, run long, totals binary, shares binary"


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as zstd frames of FRAME_PAIRS rows, each behind its length."""
    press, out = zstandard.ZstdCompressor(level=3), []
    for at in range(0, len(columns[0]), FRAME_PAIRS):
        frame = press.compress(b"".join(np.ascontiguousarray(c[at:at + FRAME_PAIRS]).tobytes() for c in columns))
        out += [struct.pack("<II", len(columns[0][at:at + FRAME_PAIRS]), len(frame)), frame]
    return b"".join(out)


def frames(data: bytes, *kinds: str) -> Iterator[tuple[np.ndarray, ...]]:
    """The frames that pack wrote, one at a time."""
    press, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        rows, size = struct.unpack_from("<II", data, at)
        raw, begin, columns = press.decompress(data[at + 8:at + 8 + size]), 0, []
        for kind in kinds:
            columns.append(np.frombuffer(raw, dtype=kind, count=rows, offset=begin))
            begin += columns[-1].nbytes
        yield tuple(columns)
        at += 8 + size


def unpack(data: bytes, *kinds: str) -> tuple[np.ndarray, ...]:
    parts = list(frames(data, *kinds))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True)) if parts else tuple(np.zeros(0, dtype=k) for k in kinds)


def merged(runs: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, totals) in order, from runs in that order; one frame of each run is open at a time."""
    sources = [frames(run, "<u8", "<u8") for run in runs]
    open_frames, heap = {}, []

    def advance(k: int) -> None:
        block = next(sources[k], None)
        if block is None:
            open_frames.pop(k, None)
        else:
            open_frames[k] = block
            heapq.heappush(heap, (int(block[0][-1]), k))

    for k in range(len(runs)):
        advance(k)
    while heap:
        bound, _ = heap[0]
        keys, sums = [], []
        for k, (pairs, totals) in open_frames.items():  # what no later frame can add to
            upto = np.searchsorted(pairs, np.uint64(bound), "right")
            keys.append(pairs[:upto])
            sums.append(totals[:upto])
            open_frames[k] = pairs[upto:], totals[upto:]
        while heap and heap[0][0] == bound:
            advance(heapq.heappop(heap)[1])
        keys, sums = np.concatenate(keys), np.concatenate(sums)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        yield keys[starts], np.add.reduceat(sums[order], starts)


class Aligner:
    """Two vocabularies and what of them is needed to align texts."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = coder(path_a), piece_coder(path_b)
        self.size_a = len(self.a.token_bytes)
        self._bytes = [self._table(c.token_bytes) for c in (self.a, self.b)]
        self._decimal = self._table([str(i).encode() + b"," for i in range(max(self.size_a, len(self.b.token_bytes)))])

    @staticmethod
    def _table(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(v) for v in values], dtype=np.int64)
        return np.frombuffer(b"".join(values), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths

    @staticmethod
    def _joined(table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of the ids one after the other, and the end of each."""
        data, starts, lengths = table
        own = lengths[ids]
        ends = np.cumsum(own)
        return data[np.repeat(starts[ids] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)], ends

    def align(self, texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Counts and group hashes of each text; the pair and the text's number of each link."""
        n = len(texts)
        full = np.flatnonzero(np.diff(text_bytes(texts)[1]))
        out = {k: np.zeros(n, dtype=np.int64) for k in ("n_a", "n_b", "n_groups", "n_links")} | {"groups_sha256": np.full(n, "", dtype=object)}
        none = np.zeros(0, dtype=np.int64)
        if not len(full):
            return out, none, none
        spaced = pa.array([" " + t for t in texts.take(pa.array(full)).to_pylist()], pa.large_string())
        data, borders = text_bytes(spaced)
        sides = [c.encode(spaced) for c in (self.a, self.b)]
        good = np.ones(len(full), dtype=bool)
        for table, (ids, offsets) in zip(self._bytes, sides, strict=True):
            spelled, ends = self._joined(table, ids)
            if len(spelled) != len(data) or not np.array_equal(spelled, data):
                at = np.concatenate(([0], ends))[offsets]
                good &= [np.array_equal(spelled[at[i]:at[i + 1]], data[borders[i]:borders[i + 1]]) for i in range(len(full))]
        full, lengths = full[good], np.diff(borders)[good]
        if not len(full):
            return out, none, none
        (a, count_a), (b, count_b) = ((ids[np.repeat(good, np.diff(offsets))].astype(np.int64), np.diff(offsets)[good]) for ids, offsets in sides)
        ends_a, ends_b = np.cumsum(self._bytes[0][2][a]), np.cumsum(self._bytes[1][2][b])
        cuts = np.unique(np.concatenate([ends_a, ends_b]))
        at_a, at_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        shared = cuts[(ends_a[at_a] == cuts) & (ends_b[at_b] == cuts)]
        last = np.cumsum(lengths)
        text = np.searchsorted(last, cuts)
        out["n_a"][full], out["n_b"][full] = count_a, count_b
        out["n_links"][full] = np.bincount(text, minlength=len(full))
        out["n_groups"][full] = np.bincount(np.searchsorted(last, shared), minlength=len(full))
        out["groups_sha256"][full] = self._group_hashes(a, b, np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b), count_a + count_b)
        return out, b[at_b] * self.size_a + a[at_a], full[text]

    def _group_hashes(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, counts: np.ndarray) -> list[str]:
        """Of each text, the hash of its groups written out; the groups of a token's ends are given."""
        place_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
        place_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        ids, sign = np.empty(len(a) + len(b), dtype=np.int64), np.full(len(a) + len(b), ord(","), dtype=np.uint8)
        ids[place_a], ids[place_b] = a, b
        sign[place_a[np.append(group_a[1:] != group_a[:-1], True)]] = ord("|")
        sign[place_b[np.append(group_b[1:] != group_b[:-1], True)]] = ord(";")
        line, ends = self._joined(self._decimal, ids)
        line[ends - 1] = sign
        borders = np.concatenate(([0], ends[np.cumsum(counts) - 1]))
        raw = line.tobytes()
        return [hashlib.sha256(raw[x:y - 1]).hexdigest() for x, y in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]


@functools.cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _spilled(keys: list[np.ndarray], first: int, size_a: int) -> Iterator[pa.RecordBatch]:
    """The runs of the links collected: one row for each remainder of B's id that occurs."""
    every = np.sort(np.concatenate(keys))
    starts = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    times, every = np.diff(np.append(starts, len(every))), every[starts]
    pairs, texts = every >> np.uint64(16), (every & np.uint64(0xFFFF)).astype("<u2")
    radix = (pairs // np.uint64(size_a) % np.uint64(RADIX)).astype(np.uint8)
    order = np.argsort(radix, kind="stable")
    borders = np.searchsorted(radix[order], np.arange(RADIX + 1))
    for r in range(RADIX):
        own = order[borders[r]:borders[r + 1]]
        if not len(own):
            continue
        begins = np.flatnonzero(np.concatenate(([True], pairs[own][1:] != pairs[own][:-1])))
        totals = pack(pairs[own][begins].astype("<u8"), np.add.reduceat(times[own], begins).astype("<u8"))
        of_pair = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(own)))).astype("<u4")
        steps = np.diff(of_pair, prepend=np.uint32(0)).astype("<u1")  # 1 where another pair than before begins
        shares = pack(steps, texts[own], times[own].astype("<u4"))
        yield _batch(run=[first], radix=[r], totals=[totals], shares=[shares])


def _batch(**columns: list) -> pa.RecordBatch:
    kinds = {n: {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[k] for n, k in (c.split() for c in _ROWS.split(", "))}
    n = len(next(iter(columns.values())))
    return pa.record_batch({c: pa.array(columns[c], kind) if c in columns else pa.nulls(n, kind) for c, kind in kinds.items()})


def _coded(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, keys, links, first = aligner(path_a, path_b), [], 0, None
        for part in (s.slice(at, SLICE_ROWS) for s in slices(batches, "text") for at in range(0, s.num_rows, SLICE_ROWS)):
            rid = part.column("rid").to_numpy()
            if keys and (links >= RUN_LINKS or rid[-1] - first >= RUN_DOCUMENTS):
                yield from _spilled(keys, first, pair.size_a)
                keys, links = [], 0
            if not keys:
                first = int(rid[0])
            found, pairs, text = pair.align(part.column("text"))
            if len(pairs):
                keys.append((pairs.astype(np.uint64) << np.uint64(16)) | (rid[text] - first).astype(np.uint64))
                links += len(pairs)
            yield _batch(rid=rid, doc_id=part.column("doc_id").to_pylist(), **found)
        if keys:
            yield from _spilled(keys, first, pair.size_a)
    return run


def _merge(last: bool, size_a: int):
    """Merges the runs of each (radix, slot). The last merge gives each pair's count and whether it is its B id's highest."""
    def merge(key: tuple[int, int], runs: list[bytes]) -> pa.RecordBatch:
        blocks = list(merged(runs))
        pairs, totals = (np.concatenate(c) for c in zip(*blocks, strict=True))
        columns = [pairs, totals]
        if last:
            side = pairs // np.uint64(size_a)
            starts = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
            highest = np.repeat(np.maximum.reduceat(totals, starts), np.diff(np.append(starts, len(pairs))))
            columns.append((totals == highest).astype("<u1"))
        return pa.record_batch({"radix": pa.array([key[0]], pa.int32()), "slot": pa.array([0], pa.int64()), "run": pa.array([key[1]], pa.int64()),
                                "totals": pa.array([pack(*columns)], pa.binary()), "shares": pa.nulls(1, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for radix, slot, totals in zip(*(batch.column(c).to_pylist() for c in ("radix", "slot", "totals")), strict=True):
                if now != (radix, slot) and held:
                    yield merge(now, held)
                    held = []
                now = radix, slot
                held.append(totals)
        if held:
            yield merge(now, held)
    return run


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows, in which the counts of a part come before its runs: what each run gives to each of its documents."""
    counted: tuple[np.ndarray, ...] = ()
    for batch in batches:
        for run, totals, shares in zip(*(batch.column(c).to_pylist() for c in ("run", "totals", "shares")), strict=True):
            if shares is None:
                counted = unpack(totals, "<u8", "<u8", "<u1")
                continue
            pairs, counts, best = counted
            at = np.searchsorted(pairs, unpack(totals, "<u8", "<u8")[0])
            steps, text, times = unpack(shares, "<u1", "<u2", "<u4")
            at = at[np.cumsum(steps)]
            order = np.argsort(text, kind="stable")
            text, at, times = text[order], at[order], times[order].astype(np.int64)
            starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
            yield pa.record_batch({
                "rid": pa.array(run + text[starts].astype(np.int64)), "n_best": pa.array(np.add.reduceat(times * best[at], starts)),
                "count_sum": pa.array(np.add.reduceat(times * counts[at].astype(np.int64), starts))})


def align(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level vocabulary applied to a blank and the text, B a piece vocabulary that adds the blank itself. A null or empty text, or one
    that either side does not spell byte by byte, has zeros and an empty hash and no links. Repeated rows and null ids keep a
    row each and count each time. Ties for the highest count all count. Extra columns are not read.
    """
    size_a = len(coder(path_a).token_bytes)
    rows = documents.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    coded = stored(rows.mapInArrow(_coded(path_a, path_b), _ROWS), "align-coded")
    runs = coded.where("run IS NOT NULL").select("radix", "run", "totals", "shares")
    n = runs.groupBy("radix").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    groups, counts, last = -(-n // FAN), runs, False
    while not last:
        last, slots = n <= FAN, max(1, -(-n // FAN))
        dealt = counts.select("radix", F.pmod(F.xxhash64("run"), F.lit(slots)).cast("long").alias("slot"), "totals")
        counts = stored(dealt.repartition("radix", "slot").sortWithinPartitions("radix", "slot").mapInArrow(_merge(last, size_a), _RUN), "align-counts")
        n = slots
    salts = max(1, groups)
    first = counts.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))).withColumn("run", F.lit(-1).cast("long"))
    streams = first.unionByName(runs.withColumn("slot", F.pmod(F.xxhash64("run"), F.lit(salts)).cast("long")))
    given = streams.repartition("radix", "slot").sortWithinPartitions("radix", "slot", "run").mapInArrow(_shares, "rid long, n_best long, count_sum long")
    sums = given.groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    texts = coded.where("rid IS NOT NULL").select("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return texts.join(sums, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
