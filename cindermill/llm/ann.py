"""Approximate nearest neighbours by multi-index hashing.

Binary codes: vectors are centred, projected to their principal directions and rotated by an
iteratively learned orthogonal matrix, and the signs are the bits. Codes are cut into substrings and every substring is
indexed. If a code lies within Hamming radius R of a query's, at least one of its m substrings lies
within floor(R / m) of the query's substring (pigeonhole), so looking up all values that near in each
substring index retrieves every code within R. Those are verified, and their vectors reranked by
exact Euclidean distance in double precision.

R is learned too: on a bounded sample it is the radius that holds the true neighbours of nearly all
sampled queries. The index covers every vector, in shards by a hash of the id; queries go to all
shards in blocks, each shard answers with its nearest k, and these are merged. A query that has fewer
than k codes within R in a shard takes the shard's nearest codes beyond R as well.

Equal vectors are one entry of the index with its smallest k + 1 ids, the most that one answer can
need, so a vector that is repeated often costs no more than once.

Defined cases: vectors that are null, zero, of a length other than the most usual one (of equally
usual ones the longer), or with null or non-finite components take no part; a query without
candidates has no rows; repeated ids count as separate candidates, a query id with several vectors asks with
the smallest of them, and a query never meets its own id. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cindermill.llm.common import bounded_sample, materialise


@dataclass
class Hasher:
    """A learned rotation to `bits` signs, and the search radius."""

    mean: np.ndarray
    projection: np.ndarray
    substrings: int
    radius: int

    def bits(self, vectors: np.ndarray) -> np.ndarray:
        return ((vectors - self.mean) @ self.projection > 0).astype(np.uint8)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """One uint16 for each substring, n x substrings."""
        bits = self.bits(vectors)
        width = bits.shape[1] // self.substrings
        weights = (1 << np.arange(width)).astype(np.uint32)
        return (bits.reshape(len(bits), self.substrings, width) @ weights).astype(np.uint16)


_POPULATION = np.array([bin(v).count("1") for v in range(1 << 16)], dtype=np.uint8)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _POPULATION[a ^ b].sum(axis=-1, dtype=np.int64)


def fit(vectors: np.ndarray, bits: int = 64, substrings: int = 4, rounds: int = 30, k: int = 10, recall: float = 0.98, seed: int = 11) -> Hasher:
    """Learn projection, rotation and radius from sample vectors."""
    rng = np.random.default_rng(seed)
    mean = vectors.mean(axis=0)
    centred = vectors - mean
    dimension = vectors.shape[1]
    _, directions = np.linalg.eigh(centred.T @ centred)
    projection = directions[:, ::-1][:, :min(bits, dimension)]
    if projection.shape[1] < bits:  # more bits than dimensions: further random directions
        projection = np.hstack([projection, rng.standard_normal((dimension, bits - projection.shape[1])) / np.sqrt(dimension)])
    projected = centred @ projection
    rotation, _ = np.linalg.qr(rng.standard_normal((bits, bits)))
    for _ in range(rounds):
        signs = np.where(projected @ rotation > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(signs.T @ projected)
        rotation = (u @ v).T
    hasher = Hasher(mean, projection @ rotation, substrings, bits)
    asked = rng.permutation(len(vectors))[:200]
    codes = hasher.codes(vectors)
    needed = []
    for q in asked:
        distance = ((vectors - vectors[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        near = np.argsort(distance, kind="stable")[:min(k, len(vectors) - 1)]
        needed.append(hamming(codes[near], codes[q]))
    if needed and len(needed[0]):
        hasher.radius = int(np.quantile(np.concatenate(needed), recall, method="higher"))
    return hasher


class MultiIndex:
    """Substring indexes over the codes of one shard."""

    def __init__(self, hasher: Hasher, codes: np.ndarray):
        self.hasher, self.codes = hasher, codes
        self.width = hasher.projection.shape[1] // hasher.substrings
        self.order = [np.argsort(codes[:, s], kind="stable") for s in range(hasher.substrings)]
        self.begins = [np.r_[0, np.cumsum(np.bincount(codes[:, s], minlength=1 << self.width))] for s in range(hasher.substrings)]
        each = hasher.radius // hasher.substrings
        self.flips = np.array([sum(1 << b for b in flipped) for n in range(each + 1) for flipped in combinations(range(self.width), n)], dtype=np.uint16)

    def within(self, code: np.ndarray) -> np.ndarray:
        """Positions of all codes within the radius."""
        found = []
        for s in range(self.hasher.substrings):
            values = (self.flips ^ code[s]).astype(np.int64)
            begin, end = self.begins[s][values], self.begins[s][values + 1]
            full = end > begin
            begin, size = begin[full], (end - begin)[full]
            at = np.repeat(begin - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            found.append(self.order[s][at])
        candidates = np.unique(np.concatenate(found))
        return candidates[hamming(self.codes[candidates], code) <= self.hasher.radius]


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v: the vectors that take part, as arrays of doubles of the most usual length."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), F.col("n").desc()).limit(1).collect()
    return rows.where(F.size("v") == (usual[0]["n"] if usual else -1))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(df: DataFrame, key: str, vector: str, is_query, k: int = 10, sample_rows: int = 5000, shard_rows: int = 50_000, query_block: int = 2000) -> DataFrame:
    """query_id, rank, <key>, score: the k nearest found for every row for which the Column is_query(id) holds."""
    rows = materialise(usable(df, key, vector))
    count = rows.count()
    kind = f"query_id long, rank int, `{key}` long, score double"
    if not count:
        return df.sparkSession.createDataFrame([], kind)
    sample = bounded_sample(rows, "id", min(1.0, sample_rows / count)).orderBy("id").select("v").toArrow()
    hasher = fit(_matrix(sample.column("v")) if sample.num_rows else np.array(rows.first()["v"])[None, :], k=k)
    shared = df.sparkSession.sparkContext.broadcast(hasher)
    # of the ids that share a vector, the smallest k + 1
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    entries = numbered.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    shards = max(1, -(-count // shard_rows))
    index = entries.select(F.pmod(F.xxhash64("v"), F.lit(shards)).alias("shard"), "v", "ids")
    asked = rows.where(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // query_block))
    copies = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), "id", "v")
    queries = copies.groupBy("shard", "block").agg(F.collect_list("id").alias("ids"), F.collect_list("v").alias("vs"))  # about query_block rows

    def search(group_key, entries: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if entries.num_rows and queries.num_rows:
            hasher = shared.value
            vectors, ids = _matrix(entries.column("v")), entries.column("ids").combine_chunks()
            begins, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            codes = hasher.codes(vectors)
            index = MultiIndex(hasher, codes)
            for block in range(queries.num_rows):
                asked = queries.column("ids")[block].values.to_numpy()
                points = queries.column("vs")[block].values
                points = points.flatten().to_numpy().reshape(len(asked), -1)
                for query, point, code in zip(asked, points, hasher.codes(points)):
                    at = index.within(code)
                    if len(at) <= k < len(codes):
                        far = hamming(codes, code)
                        at = np.flatnonzero(far <= np.partition(far, k)[k])
                    elif len(at) <= k:
                        at = np.arange(len(codes))
                    distance = np.sqrt(((vectors[at] - point) ** 2).sum(axis=1))
                    size = begins[at + 1] - begins[at]
                    member = np.repeat(begins[at] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
                    members, distances = flat[member], np.repeat(distance, size)
                    other = members != query
                    members, distances = members[other], distances[other]
                    best = np.lexsort((members, distances))[:k]
                    out.append((np.full(len(best), query), members[best], distances[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    found = index.groupBy("shard").cogroup(queries.groupBy("shard")).applyInArrow(search, "query_id long, id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")
