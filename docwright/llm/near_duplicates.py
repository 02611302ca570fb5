"""Near-duplicates by b-bit MinHash and a multi-index Hamming join.

1. A text's distinct five-word shingles give a signature of 64 symbols of 16 bits. Texts with equal sets are one class.
2. Signatures are cut into 13 chunks. Two signatures that differ in at most 25 symbols have, by the pigeonhole principle, a
   chunk with at most one error: each chunk is posted once for each symbol left out, so such a pair meets in a bucket,
   always. At a similarity of 0.85 a symbol differs with probability 0.15, and more than 25 of 64 differ for 6.3 of 10**7 such
   pairs; at 0.80 for 1.3 of 10**4; for fewer the more alike the texts are. Such a pair is missed unless others join its texts.
3. In a bucket every class is paired with the bucket's first one only. Pairs under the distance are confirmed on full sets.
   Where a bucket still holds several components, the classes of all such buckets with the same first class form a cluster,
   which is compared in blocks: its pairs of different components under the distance are confirmed inside the tasks, and only
   links that join components come out. So no group is expanded into all its pairs, and no link under the distance is lost.
4. Components come from alternating large-star and small-star steps over the confirmed links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docwright.llm.common import slices, stored, text_or_empty
from docwright.llm.words import _weights, mix, shingle_sets

SYMBOLS, DISTANCE, CHUNKS = 64, 25, 13
SHINGLE_WORDS = 5
ERRORS = DISTANCE // CHUNKS
BLOCK_CLASSES = 256
_BLOCK = 1 << 12


def _maps() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    factors = rng.integers(0, 1 << 31, SYMBOLS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return factors, rng.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32)


def _class_ids(sets: list[np.ndarray]) -> pa.Array:
    """A hash of each set; 0 for the empty set."""
    sums = [int(mix(s * np.uint64(0x9FB21C651E98DF25)).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
    return pa.array(np.array(sums, dtype=np.uint64).view(np.int64))


def _signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> bytes:
    """64 symbols of 16 bits: the smallest value of the set under each of 64 maps of 32-bit values, hashed once more."""
    low = np.full(SYMBOLS, 0xFFFFFFFF, dtype=np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), _BLOCK):
        np.minimum(low, (short[at:at + _BLOCK, None] * factors + shifts).min(axis=0), out=low)
    return (mix(low.astype(np.uint64)) >> np.uint64(48)).astype(np.uint16).tobytes()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors, shifts = _maps()
    for part in slices(batches, "text"):
        sets = shingle_sets(part.column("text"), SHINGLE_WORDS)
        yield pa.record_batch({
            "doc_id": part.column("doc_id"),
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "class_id": _class_ids(sets),
            "signature": pa.array([_signature(s, factors, shifts) if len(s) else None for s in sets], pa.binary()),
        })


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, size of the set, hash of the set, signature; one row per document."""
    return documents.select(F.col("doc_id").cast("long"), text_or_empty("text").alias("text")).mapInArrow(
        _sketch, "doc_id long, n_shingles long, class_id long, signature binary")


def _chunks() -> list[tuple[int, tuple[int, ...]]]:
    """Each chunk with each choice of symbols that remains when the allowed errors are left out."""
    borders = np.linspace(0, SYMBOLS, CHUNKS + 1).round().astype(int)
    return [(c, kept) for c in range(CHUNKS) for kept in combinations(range(borders[c], borders[c + 1]), borders[c + 1] - borders[c] - ERRORS)]


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunks = _chunks()
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            symbols = np.frombuffer(b"".join(part.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS).astype(np.uint64)
            keys = np.empty((len(symbols), len(chunks)), dtype=np.uint64)
            for k, (_, kept) in enumerate(chunks):
                keys[:, k] = mix((symbols[:, kept] * _weights(len(kept))).sum(axis=1) + np.uint64(k * 0x10001))
            ids = np.repeat(part.column("class_id").to_numpy(), len(chunks))
            yield pa.record_batch({"bucket": pa.array(keys.ravel().view(np.int64)), "class_id": pa.array(ids)})


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted postings: each class of a bucket of two or more with the bucket's first class, and whether there are more than two."""
    hub: tuple[int, int] | None = None

    def out(bucket: np.ndarray, ids: np.ndarray) -> pa.RecordBatch | None:
        nonlocal hub
        if not len(bucket):
            return None
        new = np.ones(len(bucket), dtype=bool)
        new[1:] = bucket[1:] != bucket[:-1]
        if hub and bucket[0] == hub[0]:
            new[0] = False
        firsts = np.flatnonzero(new)
        hubs = ids[firsts][np.cumsum(new) - 1] if len(firsts) else np.full(len(ids), hub[1])
        if not new[0]:
            head = firsts[0] if len(firsts) else len(ids)
            hubs = hubs.copy()
            hubs[:head] = hub[1]
        hub = (int(bucket[-1]), int(hubs[-1]))
        keep = ~new & (hubs != ids)
        return pa.record_batch({"bucket": pa.array(bucket[keep]), "a": pa.array(hubs[keep]), "b": pa.array(ids[keep])})

    for batch in batches:
        made = out(batch.column("bucket").to_numpy(), batch.column("class_id").to_numpy())
        if made is not None and made.num_rows:
            yield made


def _under_distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS) for c in ("sa", "sb"))
            yield batch.filter(pa.array((x != y).sum(axis=1) <= DISTANCE)).select(["a", "b"])


def _similar(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xa"), batch.column("xb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])
    return confirm


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        sets = shingle_sets(part.column("text"), SHINGLE_WORDS)
        yield pa.record_batch({"class_id": _class_ids(sets), "x": pa.array([s.tobytes() for s in sets], pa.binary())})


def _close(classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes allow the similarity and whose signatures are under the distance."""
    one = lambda s: classes.select(F.col("class_id").alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("signature").alias(f"s{s}"))
    both = pairs.join(one("a"), "a").where(F.col("na").isNotNull()).join(one("b"), "b")
    both = both.where((100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na")))
    return both.select("a", "b", "sa", "sb").mapInArrow(_under_distance, "a long, b long")


def _sets(documents: DataFrame, classes: DataFrame, asked: DataFrame) -> DataFrame:
    """(class_id, x) of the classes asked for: their full sets; texts are read again for these only."""
    chosen = classes.join(asked, "class_id").select(F.coalesce("doc_id", F.lit(-1 << 63)).alias("_doc")).distinct()
    texts = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)).alias("_doc"), text_or_empty("text").alias("text"))
    sets = texts.join(chosen, "_doc", "left_semi").select("text").mapInArrow(_full_sets, "class_id long, x binary").dropDuplicates(["class_id"])
    return stored(sets.join(asked, "class_id", "left_semi"), "near-sets")


def _confirmed(documents: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    sets = _sets(documents, classes, pairs.select(F.explode(F.array("a", "b")).alias("class_id")).distinct())
    first, second = (sets.select(F.col("class_id").alias(s), F.col("x").alias(f"x{s}")) for s in ("a", "b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "xa", "xb").mapInArrow(_similar(percent), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of undirected edges (a, b): the smallest node reachable. Links stay in tables; only two numbers reach the driver."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").where("a <> b").distinct(), "links")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        before = now


def _joining_links(percent: int):
    """Of two blocks of a cluster: links between different components, as many as it takes to join them, confirmed on full sets."""
    def links(key: tuple, table: pa.Table) -> pa.Table:
        ids, comp, n, own = (table.column(c).to_numpy() for c in ("class_id", "component", "n_shingles", "own"))
        symbols = np.frombuffer(b"".join(table.column("signature").to_pylist()), dtype=np.uint16).reshape(-1, SYMBOLS)
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("x").to_pylist()]
        distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
        starts, within = np.concatenate(([0], np.cumsum(n)[:-1])), key[1].as_py() == key[2].as_py()
        _, comp = np.unique(comp, return_inverse=True)
        root = np.arange(comp.max() + 1)
        found: list[tuple[int, int]] = []
        for at in range(len(ids)):
            fits = (root[comp] != root[comp[at]]) & (100 * n >= percent * n[at]) & (100 * n[at] >= percent * n)
            fits = np.flatnonzero(fits if within else fits & (own != own[at]))
            fits = fits[(symbols[fits] != symbols[at]).sum(axis=1) <= DISTANCE]
            if not len(fits):
                continue
            has = np.zeros(len(distinct), dtype=np.int32)
            has[flat[starts[at]:starts[at] + n[at]]] = 1
            both = np.add.reduceat(has[flat], starts)[fits]
            for other in fits[100 * both >= percent * (n[at] + n[fits] - both)].tolist():
                x, y = root[comp[at]], root[comp[other]]
                if x != y:
                    root[root == y] = x
                    found.append((ids[at], ids[other]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})
    return links


def _linked_in_blocks(documents: DataFrame, classes: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """Clusters are cut into blocks of about BLOCK_CLASSES, and each two blocks are one group: none is larger, however hot a bucket."""
    first = apart.groupBy("bucket").agg(F.min("class_id").alias("cluster"))
    members = stored(apart.join(first, "bucket").select("cluster", "class_id", "component").distinct(), "near-clusters")
    nodes = members.join(classes.select("class_id", "n_shingles", "signature"), "class_id")
    nodes = nodes.join(_sets(documents, classes, apart.select("class_id").distinct()), "class_id")
    sizes = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES).alias("blocks"))
    dealt = nodes.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class_id", "component", "n_shingles", "signature", "x",
    ).groupBy("cluster", "i", "j").applyInArrow(_joining_links(percent), "a long, b long")


def _still_apart(members: DataFrame, joined: DataFrame) -> DataFrame:
    """The buckets that hold several components: (bucket, class_id, component)."""
    placed = members.select("bucket", "class_id").join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "class_id"))
    apart = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(apart.where("low <> high").select("bucket"), "bucket")


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    A null or wordless text has an empty set and is linked with nothing. Repeated rows share their component. component_id is
    the smallest doc_id of the component; null ids count for it only if all are null. Extra columns of `documents` are not read.
    """
    sketched = stored(sketches(documents), "near-sketches")
    classes = stored(
        sketched.where("n_shingles > 0").groupBy("class_id").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")),
        "near-classes")
    posted = classes.select("class_id", "signature").mapInArrow(_post, "bucket long, class_id long")
    stars = stored(
        posted.repartition(F.col("bucket")).sortWithinPartitions("bucket", "class_id").mapInArrow(_stars, "bucket long, a long, b long"), "near-stars")
    tried = stored(_close(classes, stars.select("a", "b").distinct(), percent), "near-pairs")
    links = stored(_confirmed(documents, classes, tried, percent), "near-links")
    several = stars.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("a").alias("class_id")).where("n > 1")
    members = several.select("bucket", "class_id").unionByName(
        stars.join(several.select("bucket"), "bucket").select("bucket", F.col("b").alias("class_id")))
    joined = stored(components(links), "near-components")
    apart = stored(_still_apart(members, joined), "near-apart")
    if not apart.isEmpty():
        links = links.unionByName(stored(_linked_in_blocks(documents, classes, apart, percent), "near-links"))
        joined = stored(components(links), "near-components")
    placed = classes.select("class_id", "doc_id").join(joined.withColumnRenamed("node", "class_id"), "class_id")
    lowest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    own = classes.select("class_id", F.col("doc_id").alias("lowest")).join(
        placed.select("class_id", "component").join(lowest, "component").select("class_id", "component_id"), "class_id", "left")
    labelled = sketched.join(own, "class_id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "lowest")).otherwise(F.col("doc_id")).alias("component_id"))
    return labelled.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
