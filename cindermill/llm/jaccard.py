"""Near-duplicates by SimHash, verified by the Jaccard similarity of word-shingle sets.

Operator 10's index comes first: every different set has a SimHash, the inverted index of byte positions with its
count filter finds those within DISTANCE bits, and each document is verified against the one of its group with the most
links. An exact check then finds what a SimHash of 64 bits can't, since texts of similarity 0.8 differ in about 10 bits. It
takes the components of the index as they are and loses no link:

* Of n shingles a set shares at least ceil(similarity * n) with a similar one. In the order of their values, both have as many of
  the shared ones among their first n - that + l as l says. A set of which fewer of those are in any other set is left out.
* The sets that stay meet in their rarest shingles, by size: as many as sets of the two sizes need (`prefix_postings`).
* Each posting verifies its members against one of them, then the pairs that are still in different components. Pairs in
  one component need no test of their own, since only components are asked for.

Every link is verified by the exact similarity of the two sets. Texts with equal sets are one node.

Defined cases: texts without words have equal, empty sets; fewer words than a shingle's make one
shingle; null and repeated ids as in simhash.keep_one.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cindermill.llm import simhash
from cindermill.llm.common import texts
from cindermill.llm.simhash import components, keep_rows, row_key
from cindermill.sources.scratch import Scratch

DISTANCE = 2
SPARE = 10
RATIO = 1.05


def shingle_set(text: str, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """The different hashes of a text's word shingles in order; words as in simhash.fingerprint."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    spaced = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1).tolist()
    n = max(1, len(words) - shingle + 1)
    hashed = xxhash.xxh64_intdigest
    return np.unique(np.array([hashed(spaced[a:b], seed) for a, b in zip([0, *(e + 1 for e in ends[:n - 1])], ends[-n:])], dtype=np.uint64))


def _node(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes())


def head(found: np.ndarray, similarity: float) -> tuple[np.ndarray, int]:
    """The first values of a set, in which it has one in common with every similar set for each of `least`, and `least`."""
    n = len(found)
    shared = math.ceil(similarity * n - 1e-9)
    # a similar set may be smaller, but not below `shared`, and so look at fewer of its own
    return found[:n - shared + 1 + n // SPARE], 1 + shared // SPARE


def signed(df: DataFrame, key: str, text: str, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row per document: its key, node (a hash of its shingle set), fp (the set's SimHash), and `head` with its `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                sets = [shingle_set(t, shingle) for t in texts(part.column(1))]
                nodes, fps = (np.array(x, dtype=np.uint64).view(np.int64) for x in ([_node(s) for s in sets], [simhash.majority((s[k:k + simhash.BLOCK] for k in range(0, len(s), simhash.BLOCK)), len(s)) for s in sets]))
                heads = [head(s, similarity) for s in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(nodes), pa.array(fps), pa.array([h.view(np.int64) for h, _ in heads], longs), pa.array([least for _, least in heads], pa.int64())], names=[key, "node", "fp", "head", "least"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, node long, fp long, head array<long>, least long")


def shingle_sets(df: DataFrame, text: str, shingle: int = 5) -> DataFrame:
    """node and shingles, the set itself, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                sets = [shingle_set(t, shingle) for t in texts(batch.column(0).slice(at, 512))]
                nodes = np.array([_node(s) for s in sets], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["node", "shingles"])

    return df.select(text).mapInArrow(run, "node long, shingles array<long>")


def overlap(one: Column, other: Column, similarity: float) -> Column:
    """The number of shingles that similar sets of these sizes share at least."""
    return F.ceil(similarity / (1 + similarity) * (one + other) - 1e-9)


def prefix_postings(sets: DataFrame, similarity: float) -> DataFrame:
    """node, band, far, size, after: the rarest shingles of each set, so many that similar sets have one of them in common.

    far is one over the mean number of sets that have a shingle of this set, size the number of its shingles, after that of those from this one on.

    Sets of n and m shingles that are similar share at least ceil(similarity / (1 + similarity) * (n + m)); in an order that is the same
    for all, by the number of sets and then by value, both have the first shared one among their first n (or m) - that + 1. So a band is
    a shingle for two classes of sizes, and a set has its bands for each class that similar sets can be in. What sets share that are less
    similar, such as a passage of a licence, is common and so comes last. Shingles of one set alone are left out.
    """
    each = sets.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("band"))
    shared = each.groupBy("band").agg(F.count("*").alias("df")).where("df > 1")
    counted = each.join(shared.hint("merge"), "band").groupBy("node", "size").agg(F.sum("df").alias("met"), F.sort_array(F.collect_list(F.struct("df", "band"))).alias("common"))
    # the shingles that a set has alone come first in its order
    counted = counted.withColumn("alone", F.col("size") - F.size("common"))
    of = lambda size: F.floor(F.log(size) / F.lit(math.log(RATIO)))
    least = F.ceil(F.col("size") * similarity - 1e-9)
    classed = counted.withColumn("class", of(F.col("size"))).withColumn("other", F.explode(F.sequence(of(least), of(F.floor(F.col("size") / similarity + 1e-9)))))
    smallest = F.greatest(least, F.floor(F.pow(F.lit(RATIO), F.col("other")) - 1e-6))
    left = F.col("size") - overlap(F.col("size"), smallest, similarity) + 1 - F.col("alone")
    chosen = classed.withColumn("left", left.cast("int")).where("left > 0").select("node", "class", "other", "size", "alone", "met", F.posexplode(F.slice("common", F.lit(1), F.col("left"))).alias("at", "c"))
    band = F.xxhash64("c.band", F.least("class", "other"), F.greatest("class", "other"))
    return chosen.select("node", band.alias("band"), (F.col("size") / (F.col("met") + F.col("alone"))).alias("far"), "size", (F.col("size") - F.col("alone") - F.col("at")).alias("after"))


class Linker:
    """Links that give the components of all similar pairs of nodes, posting table by posting table."""

    def __init__(self, sets: DataFrame, similarity: float, kept: Scratch):
        self.sets, self.similarity, self.kept = sets, similarity, kept
        self.edges = kept.keep("edges", sets.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false"))
        self.verified = 0
        self.roots: DataFrame | None = None  # of the nodes that the edges link; none before the first edge

    def verify(self, pairs: DataFrame) -> None:
        """Adds the pairs (a, b) whose sets are similar enough."""
        pairs = self.kept.keep("pairs", pairs)
        self.verified += (count := pairs.count())
        if not count:
            return
        one, other = (self.sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}"), F.size("shingles").alias(f"n_{x}")) for x in "ab")
        both = pairs.join(one.hint("merge"), "a").join(other.hint("merge"), "b").where(F.least("n_a", "n_b") >= self.similarity * F.greatest("n_a", "n_b"))
        common = F.size(F.array_intersect("set_a", "set_b"))
        found = both.withColumn("common", common).where(F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common")) >= self.similarity).select("a", "b")
        # a star for each component is as good as all its links, and there are no more of those than nodes
        stars = [] if self.roots is None else [self.roots.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))]
        self.edges = self.kept.keep("edges", reduce(DataFrame.unionByName, stars, found))
        self.roots = self.kept.keep("roots", components(self.edges))

    def mixed(self, postings: DataFrame) -> DataFrame:
        """The postings with the root of each node, those that have nodes of several components; without nodes that share too little with any set of their size on."""
        named = postings.drop("root")
        placed = named.withColumn("root", F.col("node")) if self.roots is None else named.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        placed = self.kept.keep("placed", placed)
        several = placed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("size").alias("smallest")).where("low < high").select("band", "smallest")
        able = placed.join(several.hint("merge"), "band").where(F.col("after") >= overlap(F.col("size"), F.col("smallest"), self.similarity))
        return self.kept.keep("mixed", able.drop("smallest"))

    def pivots(self, placed: DataFrame, turn: int) -> None:
        """Verifies the members of each posting against one of them, that of which the shingles are in the most sets."""
        chosen = placed.groupBy("band").agg(F.min_by(F.struct("node", "root"), F.struct("far", F.xxhash64("node", F.lit(turn)))).alias("pivot"))
        met = placed.join(chosen.hint("merge"), "band").where("root != pivot.root")
        self.verify(met.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct())

    def rest(self, placed: DataFrame) -> None:
        """Verifies all pairs of postings that are in different components."""
        one, other = (placed.select("band", F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("root", "size", "after")]) for x in "ab")
        # all that two sets share comes from their first band on
        able = F.least("after_a", "after_b") >= overlap(F.col("size_a"), F.col("size_b"), self.similarity)
        self.verify(one.join(other.hint("merge"), "band").where("a < b and root_a != root_b").where(able).select("a", "b").distinct())


def indexed(classes: DataFrame, kept: Scratch) -> DataFrame:
    """band, node, far, root: the groups of operator 10's links between the fingerprints of classes (node, fp) as postings; far falls with the number of a fingerprint's links."""
    links = kept.keep("links", simhash.links(classes, DISTANCE))
    degrees = links.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg((1 / (1 + F.count("*"))).alias("far"))
    grouped = components(links).select(F.col("node").alias("fp"), F.col("root").alias("band")).join(degrees, "fp")
    placed = classes.join(grouped, "fp", "left").select(F.coalesce("band", "fp").alias("band"), "node", F.coalesce("far", F.lit(1.0)).alias("far"), F.col("node").alias("root"))
    several = placed.groupBy("band").count().where("count > 1").select("band")
    return kept.keep("indexed", placed.join(several.hint("merge"), "band"))


def open_nodes(classes: DataFrame) -> DataFrame:
    """The nodes that have enough values of their head in common with others; a node with a similar one is among them."""
    each = classes.select("node", "least", F.explode("head").alias("band"))
    shared = each.withColumn("met", F.count("*").over(Window.partitionBy("band"))).where("met > 1")
    return shared.groupBy("node", "least").count().where("count >= least").select("node")


def roots(classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], kept: Scratch, similarity: float = 0.8, rounds: int = 1) -> DataFrame | None:
    """node, root: the components of all similar pairs of classes (node, fp, head, least), for the nodes that have such a pair; none if no node has.

    sets_of gives node and shingles, once each, for a table of nodes.
    """
    groups = indexed(classes.select("node", "fp"), kept)
    linker = Linker(kept.keep("sets", sets_of(open_nodes(classes))), similarity, kept)
    linker.pivots(groups, 0)
    placed = linker.mixed(kept.keep("fine", prefix_postings(linker.sets, similarity)))
    for turn in range(rounds):
        linker.pivots(placed, 1 + turn)
        placed = linker.mixed(placed)
    linker.rest(placed)
    return linker.roots


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of each group that similarity links connect, the one with the smallest key."""
    kept = Scratch(df.sparkSession)
    keyed = df.select(row_key(key, text).alias("row_"), F.col(text).alias("text_"))
    signs = signed(keyed, "row_", "text_", shingle, similarity)
    classes = kept.keep("classes", signs.groupBy("node").agg(F.min("row_").alias("row_"), *[F.any_value(c).alias(c) for c in ("fp", "head", "least")]))

    def sets_of(nodes: DataFrame) -> DataFrame:
        # sets are made anew for these alone; the table is written, so Spark knows its size when it plans the join with the texts
        wanted = kept.keep("wanted", classes.join(nodes, "node").select(F.col("row_.id").alias("id_"), F.col("row_.mark").alias("mark_")))
        chosen = keyed.join(wanted, F.col("row_.id").eqNullSafe(F.col("id_")) & (F.col("row_.mark") == F.col("mark_")), "left_semi")
        return shingle_sets(chosen, "text_", shingle).dropDuplicates(["node"])

    found = roots(classes, sets_of, kept, similarity)
    placed = classes.select("node", "row_", F.col("node").alias("root")) if found is None else classes.join(found.hint("merge"), "node", "left").select("row_", F.coalesce("root", "node").alias("root"))
    return keep_rows(df, placed.groupBy("root").agg(F.min("row_").alias("row_")).select("row_"), key, text)
