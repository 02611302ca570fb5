"""Text quality by positive-unlabelled learning.

Trusted positives are the rows labelled 1, the unlabelled set is all training text whatever its label. With the logistic loss
l the non-negative risk is  prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)]);  it is minimised by damped Newton
steps whose sums Spark takes over all training rows. The class prior is the share of 1 among the labelled training rows,
unless it is given. A linear score over measures of style goes through the logistic function, so it reads as a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwright.llm.common import crc_remainder, slices, stored, text_or_empty
from docwright.llm.words import _byte_values, gram_hashes, span_hashes, text_bytes, word_spans

_KINDS = {
    "lower": range(ord("a"), ord("z") + 1), "upper": range(ord("A"), ord("Z") + 1), "digit": range(ord("0"), ord("9") + 1),
    "line": b"\n", "stop": b".", "comma": b",", "mark": b"!?", "bar": b"|", "quote": b"'\"()-:;", "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "other": range(128, 256),
}
SHARES = (
    *_KINDS, "odd_words", "upper_words", "same_as_last", "new_words", "new_pairs", "short_words", "long_words")
N_FEATURES = 2 * len(SHARES) + 6
STEPS = (1.0, 0.5, 0.25, 0.125, 0.03125)
RIDGE = 1e-3


def features(texts: pa.Array) -> np.ndarray:
    """A row of measures for each whole text; an empty text has zeros and the constant."""
    data, offsets = text_bytes(texts)
    starts, ends, counts = word_spans(data, offsets)
    n_bytes, n_words = np.diff(offsets), np.diff(counts)
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    shares, sums = [], {}
    for kind, members in _KINDS.items():
        flag = np.zeros(256, dtype=bool)
        flag[list(members)] = True
        hits = flag[data]
        shares.append(np.diff(np.searchsorted(np.flatnonzero(hits), offsets)) / per_byte)
        if kind in ("upper", "symbol", "mark", "bar", "lower"):
            sums[kind] = np.concatenate(([0], np.cumsum(hits, dtype=np.int32)))
    inside = {k: s[ends] - s[starts] for k, s in sums.items()}
    hashes, length = span_hashes(_byte_values()[data], starts, ends), ends - starts
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[counts[:-1][n_words > 0]] = False
    share_of = lambda flag: np.diff(np.searchsorted(np.flatnonzero(flag), counts)) / per_word
    pairs = gram_hashes(hashes, 2)
    new = np.zeros((2, len(n_words)))
    for at, (a, b) in enumerate(zip(counts[:-1].tolist(), counts[1:].tolist(), strict=True)):
        if b > a:
            new[0, at] = len(np.unique(hashes[a:b])) / (b - a)
            new[1, at] = len(np.unique(pairs[a:b - 1])) / (b - a - 1) if b > a + 1 else 1.0
    shares += [
        share_of(inside["symbol"] + inside["mark"] + inside["bar"] > 0), share_of((inside["upper"] > 1) & (inside["lower"] == 0)), share_of(same), new[0], new[1],
        share_of(length <= 2), share_of(length >= 14)]
    shares, words = np.array(shares).T, np.log1p(n_words)
    mean = (np.diff(np.concatenate(([0], np.cumsum(length)))[counts]) / per_word) / 10
    return np.column_stack([
        shares, np.sqrt(shares), words / 5, mean, new[0] * words / 5, (1 - new[1]) * words / 5, (n_words > 0).astype(float), np.ones(len(n_words))]).astype(np.float32)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        rows = features(part.column("text"))
        yield pa.record_batch({"row": part.column("row"), "x": pa.array([r.tobytes() for r in rows], pa.binary())})


def _rows(documents: DataFrame, columns: list[str]) -> DataFrame:
    """(row, text): the named columns as one struct, so that no name can clash, and the text."""
    return documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").cast("string").alias("text"))


def featured(documents: DataFrame) -> DataFrame:
    """(row, x): the doc_id in a struct, and the measures of the whole text."""
    frame = _rows(documents, ["doc_id"])
    return frame.mapInArrow(_featured, frame.select("row", F.lit(b"").alias("x")).schema)


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float
    risk: float


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), dtype=np.float32).reshape(-1, N_FEATURES).astype(np.float64)


def _summed(frame: DataFrame, of) -> np.ndarray:
    """Adds up what `of(x, positive)` gives for each batch; sums meet in Spark by position, so the driver gets one vector."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = of(_matrix(batch), batch.column("positive").to_numpy(zero_copy_only=False))
                total = made if total is None else total + made
        if total is not None:
            yield pa.record_batch({"at": pa.array(np.arange(len(total))), "v": pa.array(total)})

    rows = frame.mapInArrow(parts, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(len(rows))
    for r in rows:
        total[r["at"]] = r["v"]
    return total


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def learn(training: DataFrame, prior: float, steps: int = 12) -> Model:
    """`training`: (x, positive) of all training rows. Without rows or positives every score is the prior."""
    d = N_FEATURES
    first = _summed(training, lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(0), (x * x).sum(0), x[p].sum(0)]))
    flat = Model(np.zeros(d), np.ones(d), np.concatenate([np.zeros(d - 1), [np.log(prior / (1 - prior))]]), prior, 0.0)
    if not len(first) or not first[1]:
        return flat
    n, m = first[:2]
    center, scale = first[2:d + 2] / n, np.sqrt(np.maximum(first[d + 2:2 * d + 2] / n - (first[2:d + 2] / n) ** 2, 0))
    scale[scale < 1e-6] = 1.0
    center[-1], scale[-1] = 0.0, 1.0
    positive = (first[2 * d + 2:] / m - center) / scale
    ridge = np.full(d, RIDGE)
    ridge[-1] = 0

    def risk(total: np.ndarray, w: np.ndarray) -> float:
        unlabelled, plus, minus = total[0] / n, total[1] / m, total[2] / m
        return prior * plus + max(0.0, unlabelled - prior * minus) + 0.5 * float(ridge @ (w * w))

    def losses(w: np.ndarray):
        def of(x: np.ndarray, p: np.ndarray) -> np.ndarray:
            g = (x - center) / scale @ w
            return np.concatenate([_loss(-g).sum(0), _loss(g[p]).sum(0), _loss(-g[p]).sum(0)])
        return of

    w, best = flat.weights, np.inf
    for _ in range(steps):
        def slope(x: np.ndarray, p: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            z = (x - center) / scale
            s = 1 / (1 + np.exp(-z @ w))
            return np.concatenate([s @ z, ((z * (s * (1 - s))[:, None]).T @ z).ravel()])

        total = _summed(training, slope)
        gradient = total[:d] / n - prior * positive + ridge * w
        curve = total[d:].reshape(d, d) / n + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, gradient)
        trials = np.column_stack([w - t * step for t in STEPS])
        tried = _summed(training, losses(trials)).reshape(3, -1)
        risks = [risk(tried[:, k], trials[:, k]) for k in range(len(STEPS))]
        k = int(np.argmin(risks))
        if not risks[k] < best - 1e-6:
            break
        w, best = trials[:, k], risks[k]
    return Model(center, scale, w, prior, best)


def _probability(x: np.ndarray, model: Model) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip((x.astype(np.float64) - model.center) / model.scale @ model.weights, -40, 40)))


def score(frame: DataFrame, model: Model) -> DataFrame:
    """(row, score) of what `featured` gives."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch({"row": batch.column("row"), "score": pa.array(_probability(_matrix(batch), model))})

    return frame.mapInArrow(scored, frame.select("row", F.lit(0.0).cast("double").alias("score")).schema)


def fit(table: DataFrame, labels: DataFrame, folds: int, prior: float | None = None) -> Model:
    """A model from the features of all training rows. No labelled row is left out: the fit has no sample."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(crc_remainder("doc_id", folds) != 0).groupBy(F.col("doc_id").alias("_id")).agg(
        F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high")
    if prior is None:
        total, ones = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("high"), F.lit(0))).first()
        prior = (ones + 1) / (total + 2)
    training = table.where(crc_remainder("row.doc_id", folds) != 0).select(F.col("row.doc_id").alias("_id"), "x").join(known, "_id", "left")
    training = stored(training.select("x", F.coalesce(F.col("high") == 1, F.lit(False)).alias("positive")), "quality-training")
    return learn(training, min(max(prior, 0.01), 0.99))


def classify(documents: DataFrame, labels: DataFrame, folds: int = 5, cut: float = 0.3, prior: float | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Rows whose crc32(doc_id) is 0 modulo `folds` are held out; their labels are not read. Null labels, and ids labelled both
    0 and 1, count as unlabelled. A null or empty text is scored like any other; repeated rows each get a row. Extra columns are
    not read.
    """
    table = stored(featured(documents), "quality-features")
    scored = score(table, fit(table, labels, folds, prior)).select(F.col("row.doc_id").alias("doc_id"), "score")
    return scored.select("doc_id", (crc_remainder("doc_id", folds) == 0).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, folds: int = 5, cut: float = 0.3) -> DataFrame:
    """The documents that the classifier takes for good, with all their columns."""
    model = fit(stored(featured(documents), "quality-features"), labels, folds)
    frame = _rows(documents, [c for c in documents.columns if c != "text"])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield part.filter(pa.array(_probability(features(part.column("text")), model) >= cut))

    kept = frame.mapInArrow(keep, frame.schema)
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])
