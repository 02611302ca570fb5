"""Benchmark passages inside documents, by size-partitioned MinHash containment search.

Test items are put into classes by the size of their shingle set, each class reaching to twice its smallest size. An item's
MinHash sketch is the k smallest hashes of its set, where k follows from the largest size u of its class: an item of which the
share t lies in a document misses at most u - ceil(t * u) shingles, so one more than that many sketch values cannot all be
missing. Every qualifying pair therefore shares a sketch value with the document, however long that is; banded signatures,
compared by resemblance, would lose a short item in a long text. Candidates are confirmed by the words of all shingles.

The sketch index is broadcast in blocks of a stated size: more items mean more passes over the documents, not a larger index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwright.llm.common import slices, text_or_empty
from docwright.llm.words import gram_hashes, word_hashes

SHINGLE_WORDS, PERCENT = 5, 80
INDEX_BYTES = 64 << 20
_RESULT = "doc_id long, item_id long, item_shingles long, found long, containment double"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingles_of(words: list[bytes], k: int) -> set[tuple[bytes, ...]]:
    return set(zip(*(words[at:] for at in range(k)), strict=False))


def sketch_size(size: int, percent: int = PERCENT) -> int:
    """How many of the smallest hashes an item of this size needs, by the largest size of its class."""
    u = (1 << size.bit_length()) - 1
    return min(size, u - -(-percent * u // 100) + 1)


class Index:
    """Sketches of a block of items: for each shingle length, sorted hashes with the items that have them, and a bitmap of them."""

    def __init__(self, items: list[tuple[int, str]], percent: int) -> None:
        self.percent, self.items, posted = percent, [], {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            k = min(SHINGLE_WORDS, len(words))
            shingles = shingles_of(words, k)
            hashes = np.unique(gram_hashes(word_hashes(pa.array([text]))[0], k))
            for h in hashes[:sketch_size(len(hashes), percent)]:
                posted.setdefault(k, []).append((int(h), len(self.items)))
            self.items.append((item_id, k, shingles))
        self.sketches = {}
        for k, rows in posted.items():
            rows.sort()
            hashes = np.array([h for h, _ in rows], dtype=np.uint64)
            bits = np.zeros(1 << 22, dtype=bool)
            bits[hashes & np.uint64((1 << 22) - 1)] = True
            self.sketches[k] = hashes, np.array([i for _, i in rows]), bits

    def candidates(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sorted distinct (text, item) pairs that share a sketch value."""
        found = [np.zeros((0, 2), dtype=np.int64)]
        for k, (hashes, items, bits) in self.sketches.items():
            grams = gram_hashes(words, k)
            at = np.flatnonzero(bits[grams & np.uint64((1 << 22) - 1)])
            low, high = np.searchsorted(hashes, grams[at], "left"), np.searchsorted(hashes, grams[at], "right")
            at, low, n = at[high > low], low[high > low], (high - low)[high > low]
            texts = np.searchsorted(counts, at, "right") - 1
            inside = at + k <= counts[texts + 1]
            texts, low, n = texts[inside], low[inside], n[inside]
            which = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else low
            found.append(np.column_stack([np.repeat(texts, n), items[which]]))
        return np.unique(np.concatenate(found), axis=0)


def _search(index: Index):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts, ids, rows = part.column("text"), part.column("doc_id"), []
            last, sets = -1, {}
            for t, i in index.candidates(*word_hashes(texts)).tolist():
                if t != last:
                    last, words, sets = t, words_of(texts[t].as_py()), {}
                item_id, k, shingles = index.items[i]
                if k not in sets:
                    sets[k] = shingles_of(words, k)
                found = len(shingles & sets[k])
                if 100 * found >= index.percent * len(shingles):
                    rows.append((ids[t].as_py(), item_id, len(shingles), found, found / len(shingles)))
            yield pa.record_batch(list(map(pa.array, zip(*rows, strict=True))) if rows else [[]] * 5, schema=pa.schema([
                ("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_shingles", pa.int64()), ("found", pa.int64()), ("containment", pa.float64())]))
    return search


def _blocks(benchmark: DataFrame, percent: int, index_bytes: int) -> Iterator:
    """A broadcast index for each block of items; a block's texts have about `index_bytes` / 8 bytes."""
    items = benchmark.select(F.col("item_id").cast("long"), text_or_empty("text").alias("text")).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") * 8), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // index_bytes))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([(r["item_id"], r["text"]) for r in rows], percent))


def _found(index: Index, part: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """(row, item_id, size of the item's set, shingles found) of each pair that is confirmed."""
    texts, last, words, sets = part.column("text"), -1, [], {}
    for t, i in index.candidates(*word_hashes(texts)).tolist():
        if t != last:
            last, words, sets = t, words_of(texts[t].as_py()), {}
        item_id, k, shingles = index.items[i]
        if k not in sets:
            sets[k] = shingles_of(words, k)
        found = len(shingles & sets[k])
        if 100 * found >= index.percent * len(shingles):
            yield t, item_id, len(shingles), found


def _search(index):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = list(_found(index.value, part))
            at, item_id, size, found = (pa.array([r[c] for r in rows], pa.int64()) for c in range(4))
            containment = pa.array([r[3] / r[2] for r in rows], pa.float64())
            yield pa.record_batch([part.column("doc_id").take(at), item_id, size, found, containment], names=["doc_id", "item_id", "item_shingles", "found", "containment"])
    return search


def _without(index):
    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            keep = np.ones(part.num_rows, dtype=bool)
            keep[[r[0] for r in _found(index.value, part)]] = False
            yield part.filter(pa.array(keep))
    return without


def find_items(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row per document and test item of whose distinct shingles at least `percent` lie in the document.

    Shingles have five words; an item of fewer words is one shingle of all of them. Items without words are in no document,
    documents without words hold no item. Repeated items count once, repeated documents each; null ids stay null. Extra columns
    are not read.
    """
    texts = documents.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text"))
    found = None
    for index in _blocks(benchmark, percent, index_bytes):
        more = texts.mapInArrow(_search(index), _RESULT)
        found = more if found is None else found.unionByName(more)
    return found


def without_items(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The documents, with all their columns, that hold no item by the rule of `find_items`."""
    frame = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "text"]).alias("row"), F.col("text").cast("string").alias("text"))
    for index in _blocks(benchmark, percent, index_bytes):
        frame = frame.mapInArrow(_without(index), frame.schema)
    return frame.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])
