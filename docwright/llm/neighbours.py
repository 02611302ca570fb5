"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. Each block of vectors keeps an inverted file: for each pivot, the vectors
that have it and at which place. A query's own pivots are looked up, the places give the footrule distance (a pivot that only
one of the two has counts as placed last), and the best part of the block by that distance is ranked again by inner product.
Blocks are dealt by hash, so the best part of each block together is the best part of all. Queries are cut into blocks too, and
each pair of blocks is one task of bounded size; only the k best of a query and block leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docwright.llm.common import stored

#: A query meets about PREFIX ** 2 / PIVOTS postings a row: one.
PIVOTS, PREFIX = 1024, 32
BLOCK_ROWS, BLOCK_QUERIES = 16_384, 2_048
#: The part of a block that is ranked again, and how many rows at least for each neighbour wanted.
PART, EACH = 0.2, 5


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v): rows with an id whose vector is neither null, empty nor zero and holds no null or non-finite component.

    Where lengths differ, the shorter vectors are filled up with zeros, so a product runs over the components that both have."""
    v = F.col(column).cast("array<double>")
    frame = vectors.select(F.col("vec_id").cast("long"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0) & F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x)))
    longest = frame.agg(F.max(F.size("v"))).first()[0] or 0
    return frame.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("v"))))


def pivots_of(frame: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """At most n different vectors, those of the smallest hash of their id: a bounded sample that does not hang on order."""
    rows = frame.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(n).collect()
    return np.unique(np.array([r["v"] for r in rows], dtype=np.float64), axis=0) if rows else np.zeros((0, 0))


def _index(pivots: np.ndarray, prefix: int):
    def index(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1)
                order = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int16)
                yield pa.record_batch({
                    "vec_id": batch.column("vec_id"), "v": pa.array([r.tobytes() for r in x], pa.binary()), "near": pa.array([r.tobytes() for r in order], pa.binary())})
    return index


def footrules(near: np.ndarray, asked: np.ndarray, n_pivots: int):
    """For each query's prefix, the sum of what each vector saves of the greatest footrule distance, from an inverted file."""
    n, length = near.shape
    flat, places = near.ravel(), np.tile(np.arange(length), n)
    order = np.argsort(flat, kind="stable")
    rows, places = np.repeat(np.arange(n), length)[order], places[order]
    borders = np.searchsorted(flat[order], np.arange(n_pivots + 1))
    for query in asked:
        lists = [slice(borders[p], borders[p + 1]) for p in query.tolist()]
        saved = np.concatenate([2 * length - np.maximum(places[s], at) * 2 for at, s in enumerate(lists)])
        yield np.bincount(np.concatenate([rows[s] for s in lists]), weights=saved, minlength=n)


def _search(k: int, n_pivots: int, part: float):
    def search(key: tuple, table: pa.Table) -> pa.Table:
        is_query = table.column("query").to_numpy()
        read = lambda name, kind: np.array([np.frombuffer(b, dtype=kind) for b in table.column(name).to_pylist()])
        ids, vectors, near = table.column("vec_id").to_numpy(), read("v", np.float64), read("near", np.int16)
        own, x, base = ids[~is_query], vectors[~is_query], near[~is_query]
        out: list[tuple[int, int, float]] = []
        if len(own):
            again = min(len(own), max(EACH * k, -int(-part * len(own) // 1)))
            for query, q, saved in zip(ids[is_query].tolist(), vectors[is_query], footrules(base, near[is_query], n_pivots), strict=True):
                saved[own == query] = -1  # its own rows take no other's place
                best = np.argpartition(-saved, again - 1)[:again] if again < len(own) else np.arange(len(own))
                best = best[own[best] != query]
                scores = x[best] @ q
                first = np.lexsort((own[best], -scores))[:k]
                out += [(query, int(own[best[i]]), float(scores[i])) for i in first]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})
    return search


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, n_pivots: int = PIVOTS, prefix: int = PREFIX, part: float = PART) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by `every`, the k vectors found of largest inner product.

    Rows that `usable` leaves out take no part. Ties go to the smaller vec_id. A query repeated under one id is asked once, with
    the smallest of its vectors; repeated candidates each count, but none with the query's own id. Extra columns are not read.
    """
    frame = usable(vectors)
    pivots = pivots_of(frame, n_pivots)
    schema = "vec_id long, v binary, near binary"
    indexed = stored(frame.mapInArrow(_index(pivots, min(prefix, max(1, len(pivots) // 4))), schema), "permutation-index")
    n = indexed.count()
    queries = indexed.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min_by(F.struct("v", "near"), "v").alias("r")).select("vec_id", "r.*")
    blocks, asked = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n // (every * BLOCK_QUERIES)))
    deal = lambda name, to: F.explode(F.sequence(F.lit(0), F.lit(to - 1))).alias(name)
    own = lambda to: F.pmod(F.xxhash64("vec_id"), F.lit(to)).cast("int")
    data = indexed.select(own(blocks).alias("i"), deal("j", asked), F.lit(False).alias("query"), "vec_id", "v", "near")
    questions = queries.select(deal("i", blocks), own(asked).alias("j"), F.lit(True).alias("query"), "vec_id", "v", "near")
    found = data.unionByName(questions).groupBy("i", "j").applyInArrow(_search(k, len(pivots), part), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
