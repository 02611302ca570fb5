"""An interpolated modified Kneser-Ney model of word pairs, counted in Spark and memory-mapped for scoring.

Counting moves packed arrays, not rows: a task counts its texts, splits the sorted keys over shards, and each shard is merged
once. The model is a folder of sorted arrays: hashes of all words (a word's id is its rank), and in each shard of pairs the
sorted keys (id of the word before, id of the word) with their counts. Dense arrays by id hold what the smoothing needs:
occurrences as a context, how many pairs of it were seen once, twice and more, and how many different words stand before a word.

    p(w|v) = max(c(vw) - D(c(vw)), 0) / c(v) + (D1 N1(v) + D2 N2(v) + D3 N3(v)) / c(v) * p(w)
    p(w)   = max(k(w) - D(k(w)), 0) / K + (mass discounted) / K / (V + 1),   k(w): different words before w, K: their sum

D1, D2 and D3 come from the counts of counts of each order. Scoring needs no exchange: a worker maps the files, looks up the
sorted distinct keys of a batch, and the system pages in what is touched. Words are told apart by 64-bit hashes, ids by 32 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwright.llm.common import crc_remainder, new_folder, slices, stored, text_or_empty
from docwright.llm.files import map_array, write_array
from docwright.llm.words import mix, word_hashes

END = np.uint64(0x5EED0FE2D0C5A11B)
FLUSH_KEYS = 1_500_000
_BLOBS = "shard long, keys binary, counts binary"


@dataclass
class Model:
    folder: str
    shards: int
    starts: np.ndarray  # rank of the first word of each shard, with the end
    n_tokens: int = 0
    discounts: list[tuple[float, float, float]] = field(default_factory=list)  # of pairs, of words
    pairs_total: int = 0  # K
    mass: float = 0.0

    @property
    def n_words(self) -> int:
        return int(self.starts[-1])


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word with the end token after each text, and the tokens before each text, with the end."""
    words, counts = word_hashes(texts)
    return np.insert(words, counts[1:], END), counts + np.arange(len(counts))


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte, so that Spark's compression finds the zeros."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sum of their counts."""
    if not keys:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    every, weights = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, weights = every[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.zeros(0, dtype=np.int64)
    return every[first], np.add.reduceat(weights, first) if len(first) else np.zeros(0, dtype=np.int64)


def by_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a word's hash; ranges of hashes, in order."""
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _counted(of, shard_of, shards: int):
    """Counts the keys that `of(texts)` gives and emits, for each shard, the sorted keys with their counts."""
    def emit(keys: list[np.ndarray]) -> pa.RecordBatch:
        own, counts = np.unique(np.concatenate(keys), return_counts=True)
        where = shard_of(own, shards)
        order = np.argsort(where, kind="stable")
        borders = np.searchsorted(where[order], np.arange(shards + 1))
        rows = [(s, pack_keys(own[order[a:b]]), counts[order[a:b]].astype(np.uint32).tobytes()) for s, (a, b) in enumerate(zip(borders[:-1], borders[1:], strict=True)) if b > a]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["shard", "keys", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for part in slices(batches, "text"):
            keys = of(part.column("text"))
            held.append(keys)
            n += len(keys)
            if n >= FLUSH_KEYS:
                yield emit(held)
                held, n = [], 0
        if n:
            yield emit(held)
    return count


def _blobs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = [unpack_keys(k) for k in table.column("keys").to_pylist()]
    return merged(keys, [np.frombuffer(c, dtype=np.uint32).astype(np.int64) for c in table.column("counts").to_pylist()])


def _small(counts: np.ndarray) -> np.ndarray:
    return counts.astype("<u2") if not len(counts) or counts.max() < 1 << 16 else counts.astype("<u4")


def _keep_words(folder: str):
    def keep(key: tuple, table: pa.Table) -> pa.Table:
        shard, (hashes, counts) = key[0].as_py(), _blobs(table)
        write_array(f"{folder}/words-{shard}", hashes)
        write_array(f"{folder}/word-counts-{shard}", counts.astype("<i8"))
        return pa.table({"shard": pa.array([shard], pa.int64()), "n": [len(hashes)], "total": [int(counts.sum())]})
    return keep


class Lookup:
    """The mapped files of a model; opened once in a worker."""

    def __init__(self, model: Model, pairs: bool) -> None:
        self.model = model
        full = np.diff(model.starts)
        self.words = [map_array(f"{model.folder}/words-{s}", "<u8") if full[s] else None for s in range(model.shards)]
        self._pairs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if pairs:
            dense = lambda name, kind: [map_array(f"{model.folder}/{name}-{s}", kind) if full[s] else None for s in range(model.shards)]
            self.counts, self.contexts, self.before = dense("word-counts", "<i8"), dense("contexts", "<i8"), dense("before", "<i8")

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """1 + rank of each of the sorted distinct hashes; 0 where the word is unknown."""
        found = np.zeros(len(hashes), dtype=np.int64)
        borders = np.searchsorted(by_hash(hashes, self.model.shards), np.arange(self.model.shards + 1))
        for s, words in enumerate(self.words):
            a, b = borders[s], borders[s + 1]
            if words is not None and b > a:
                at = np.minimum(np.searchsorted(words, hashes[a:b]), len(words) - 1)
                found[a:b] = np.where(words[at] == hashes[a:b], self.model.starts[s] + at + 1, 0)
        return found

    def dense(self, arrays: list, ids: np.ndarray, width: int = 1) -> np.ndarray:
        """Values by ids that rise but for zeros; zero for id 0."""
        out = np.zeros((len(ids), width) if width > 1 else len(ids), dtype=np.int64)
        known = np.flatnonzero(ids)
        borders = np.searchsorted(ids[known], self.model.starts + 1)
        for s, values in enumerate(arrays):
            at = known[borders[s]:borders[s + 1]]
            if values is not None and len(at):
                out[at] = (values.reshape(-1, width) if width > 1 else values)[ids[at] - 1 - self.model.starts[s]]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the sorted distinct keys; zero where the pair is unknown."""
        found = np.zeros(len(keys), dtype=np.int64)
        where = by_mix(keys, self.model.shards)
        order = np.argsort(where, kind="stable")
        borders = np.searchsorted(where[order], np.arange(self.model.shards + 1))
        for s in np.flatnonzero(np.diff(borders)):
            asked = order[borders[s]:borders[s + 1]]
            if s not in self._pairs:
                self._pairs[s] = _mapped_pairs(self.model.folder, int(s))
            known, counts = self._pairs[s]
            if len(known):
                at = np.minimum(np.searchsorted(known, keys[asked]), len(known) - 1)
                found[asked] = np.where(known[at] == keys[asked], counts[at], 0)
        return found


def _mapped_pairs(folder: str, shard: int) -> tuple[np.ndarray, np.ndarray]:
    try:
        keys = map_array(f"{folder}/pairs-{shard}", "<u8")
    except FileNotFoundError:
        return np.zeros(0, dtype="<u8"), np.zeros(0, dtype="<u2")
    counts = map_array(f"{folder}/pair-counts-{shard}", "<u2")
    return keys, counts if len(counts) == len(keys) else counts.view("<u4")


_opened: dict[tuple[str, bool], Lookup] = {}


def opened(model: Model, pairs: bool) -> Lookup:
    if (model.folder, pairs) not in _opened:
        _opened.clear()
        _opened[model.folder, pairs] = Lookup(model, pairs)
    return _opened[model.folder, pairs]


def by_mix(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a pair; spread evenly, so that a frequent first word is no hot shard."""
    return by_hash(mix(keys), shards)


def _pair_keys(model: Model):
    def of(texts: pa.Array) -> np.ndarray:
        hashes, counts = tokens(texts)
        distinct, which = np.unique(hashes, return_inverse=True)
        return keyed(opened(model, False).ids(distinct)[which].astype(np.uint64), counts)
    return of


def keyed(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(id before) << 32 | id of each token; before a text's first token stands id 0."""
    before = np.zeros(len(ids), dtype=np.uint64)
    before[1:] = ids[:-1]
    before[counts[:-1]] = 0
    return before << np.uint64(32) | ids


def _keep_pairs(model: Model):
    """Writes a shard of pairs; returns what its pairs add to each word, for the shard of words that has it."""
    def keep(key: tuple, table: pa.Table) -> pa.Table:
        shard, (keys, counts) = key[0].as_py(), _blobs(table)
        write_array(f"{model.folder}/pairs-{shard}", keys)
        write_array(f"{model.folder}/pair-counts-{shard}", _small(counts))
        first, second = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        seen, at = np.unique(first, return_index=True)
        sums = np.column_stack([np.add.reduceat(v, at) for v in (counts, (counts == 1).astype(np.int64), (counts == 2).astype(np.int64), (counts > 2).astype(np.int64))])
        later, times = np.unique(second, return_counts=True)
        rows = []
        for s in range(model.shards):
            low, high = model.starts[s] + 1, model.starts[s + 1] + 1
            a, b = np.searchsorted(seen, (low if s else 0, high))  # id 0, the start of a text, goes to the first shard
            c, d = np.searchsorted(later, (low, high))
            if b > a or d > c:
                rows.append((s, seen[a:b].tobytes(), sums[a:b].tobytes(), later[c:d].tobytes(), times[c:d].astype(np.int64).tobytes(), *(0,) * 4))
        rows.append((-1, b"", b"", b"", b"", *(int((counts == k).sum()) for k in range(1, 5))))
        return pa.table([pa.array(c) for c in zip(*rows, strict=True)], names=["shard", "seen", "sums", "later", "times", "c1", "c2", "c3", "c4"])
    return keep


def _keep_contexts(model: Model):
    def keep(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        low, n = int(model.starts[shard]) + 1, int(model.starts[shard + 1] - model.starts[shard])
        contexts, before, start = np.zeros((n, 4), dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(4, dtype=np.int64)
        for seen, sums, later, times in zip(*(table.column(c).to_pylist() for c in ("seen", "sums", "later", "times")), strict=True):
            ids, values = np.frombuffer(seen, dtype=np.int64), np.frombuffer(sums, dtype=np.int64).reshape(-1, 4)
            if len(ids) and not ids[0]:
                start += values[0]
                ids, values = ids[1:], values[1:]
            contexts[ids - low] += values
            before[np.frombuffer(later, dtype=np.int64) - low] += np.frombuffer(times, dtype=np.int64)
        write_array(f"{model.folder}/contexts-{shard}", contexts)
        write_array(f"{model.folder}/before-{shard}", before)
        if not shard:
            write_array(f"{model.folder}/start", start)
        return pa.table({"shard": pa.array([shard], pa.int64()), "total": [int(before.sum())], **{f"c{k}": [int((before == k).sum())] for k in range(1, 5)}, "more": [int((before > 2).sum())]})
    return keep


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the counts of counts; 0.5, 1 and 1.5 where those are too few."""
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(d if 0 <= d <= k else k / 2 for k, d in enumerate(found, 1))


def train(texts: DataFrame) -> Model | None:
    """The model of all texts of the column `text`; None if there is no row."""
    spark = texts.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_folder(spark, "language-model")
    counted = texts.mapInArrow(_counted(lambda t: tokens(t)[0], by_hash, shards), _BLOBS)
    words = stored(counted.groupBy("shard").applyInArrow(_keep_words(folder), "shard long, n long, total long"), "model-words").collect()  # a row for each shard
    if not words:
        return None
    sizes = np.zeros(shards + 1, dtype=np.int64)
    for r in words:
        sizes[r["shard"] + 1] = r["n"]
    model = Model(folder, shards, np.cumsum(sizes), sum(r["total"] for r in words))
    if model.n_words >= (1 << 32) - 1:
        raise ValueError("the ids of this model have 32 bits; it has more different words")
    counted = texts.mapInArrow(_counted(_pair_keys(model), by_mix, shards), _BLOBS)
    made = stored(counted.groupBy("shard").applyInArrow(
        _keep_pairs(model), "shard long, seen binary, sums binary, later binary, times binary, c1 long, c2 long, c3 long, c4 long"), "model-pairs")
    pairs = made.where("shard < 0").agg(*[F.sum(f"c{k}") for k in range(1, 5)]).first()
    dense = stored(made.where("shard >= 0").groupBy("shard").applyInArrow(
        _keep_contexts(model), "shard long, total long, c1 long, c2 long, c3 long, c4 long, more long"), "model-contexts")
    single = dense.agg(F.sum("total"), *[F.sum(f"c{k}") for k in range(1, 5)], F.sum("more")).first()
    model.discounts = [discounts(*pairs), discounts(*single[1:5])]
    model.pairs_total = single[0]
    one, two, three = model.discounts[1]
    model.mass = one * single[1] + two * single[2] + three * single[5]
    return model


def _discounted(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return counts - np.array([0.0, *by])[np.minimum(counts, 3)]


def _scored(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = opened(model, True)
        start = map_array(f"{model.folder}/start", "<i8")
        n, v = model.n_tokens, model.n_words
        for part in slices(batches, "text"):
            hashes, borders = tokens(part.column("text"))
            distinct, which = np.unique(hashes, return_inverse=True)
            own = files.ids(distinct)
            counts = files.dense(files.counts, own)
            base = np.log10((counts + 1) / (n + v + 1))
            alone = (_discounted(files.dense(files.before, own), model.discounts[1]) + model.mass / (v + 1)) / model.pairs_total
            context = files.dense(files.contexts, own, 4)
            ids = own[which].astype(np.uint64)
            keys = keyed(ids, borders)
            pairs, place = np.unique(keys, return_inverse=True)
            taken = _discounted(files.pair_counts(pairs), model.discounts[0])[place]
            before = np.full(len(ids), -1)
            before[1:] = which[:-1]
            before[borders[:-1]] = -1
            c = np.where((before < 0)[:, None], start, context[before])
            left = c[:, 1:] @ np.array(model.discounts[0])
            single, total = alone[which], np.maximum(c[:, 0], 1)
            p = np.where(c[:, 0] > 0, (taken + left * single) / total, single)
            sums = [np.diff(np.concatenate(([0.0], np.cumsum(x)))[borders]) for x in (base[which], np.log10(p), (counts > 0)[which])]
            yield pa.record_batch({
                "doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "n_tokens": pa.array(np.diff(borders)), "n_known": pa.array(sums[2].astype(np.int64)),
                "train_tokens": pa.array(np.full(part.num_rows, n)), "base_score": pa.array(sums[0]), "score": pa.array(sums[1])})
    return score


def score(documents: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens, base_score and score, the log10 probability of the text.

    The model learns from all whole texts whose crc32(doc_id) is not `held` modulo `folds`. A null or empty text is the end token
    alone. Repeated rows count each time, null ids count as empty text in the remainder. Without training rows the model is the
    uniform one over the unknown word, and score equals base_score, both log10(1) = 0 for each token. Extra columns are not read.
    """
    texts = documents.select(
        F.col("doc_id").cast("long"), text_or_empty("text").alias("text"), (crc_remainder("doc_id", folds) == held).alias("held_out"))
    model = train(texts.where(~F.col("held_out")).select("text"))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    if model is None:
        def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                zero = pa.array(np.zeros(part.num_rows, dtype=np.int64))
                n = pa.array(np.diff(tokens(part.column("text"))[1]))
                nothing = zero.cast(pa.float64())
                yield pa.record_batch([part.column("doc_id"), part.column("held_out"), n, zero, zero, nothing, nothing], names=schema.replace(",", "").split()[::2])
        return texts.select("doc_id", "text", "held_out").mapInArrow(unknown, schema)
    return texts.mapInArrow(_scored(model), schema)
