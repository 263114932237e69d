"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two fingerprints that differ in at most `distance` bits
agree in at least 8 - distance of them. Postings of single bytes would hold a 256th of all rows each, so
a posting is a set of two positions fewer than that with their bytes. A pair meets in as many postings as
there are such sets among the positions that it shares, so the guaranteed minimum of shared bytes is one of
met postings too: meetings are tallied by pair, pairs below it are removed, and the
others are verified by their differing bits. Equal fingerprints are one entry of the index.

For 2 bits, not all 70 sets of four positions are needed. The 14 whose numbers add up to zero without carry are a
quadruple system: any three positions are in exactly one of them, so any two positions are outside of three, and a
pair within 2 bits meets in these three at least. The index, and what is shuffled to count it, is a fifth.

A posting with more than CROWD different fingerprints is not paired. Each of its fingerprints looks up every value
within `distance` bits of it instead, so the work stays in proportion to the rows and no link is lost.

Groups are connected components of the links, found by alternating large-star and small-star steps,
each written to the shared folder; every step works on the linked fingerprints alone.

Defined cases: a null or empty text, or one of white space alone, has fingerprint zero and links like
any other; fewer words than a shingle's make one shingle; repeated rows share their component. A null
doc_id is a row like any other and never the smallest id, unless all in its component are null.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Iterator
from functools import reduce
from itertools import combinations
from operator import xor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import materialise, texts, unused

POSITIONS = 8
BLOCK = 1 << 16
CROWD = 2000


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lower-cases A-Z and splits at ASCII white space only
    if not words:
        return 0
    spaced = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    hashed = xxhash.xxh64_intdigest
    return majority((np.array([hashed(spaced[a:b], seed) for a, b in zip(first[at:at + BLOCK], last[at:at + BLOCK])], dtype=np.uint64) for at in range(0, n, BLOCK)), n)


def majority(blocks: Iterable[np.ndarray], n: int) -> int:
    """The bits that are set in over half of n 64-bit hashes, which come in blocks."""
    ones = np.zeros(64, dtype=np.int64)
    for h in blocks:
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """One row per document: its key and fp, the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in texts(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=[key, "fp"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, fp long")


def _byte_masks(positions: tuple[int, ...]) -> int:
    mask = sum(0xFF << (8 * p) for p in positions)
    return mask - (1 << 64) if mask >> 63 else mask


def position_sets(distance: int) -> tuple[list[tuple[int, ...]], int]:
    """Sets of positions, and how many of them at least are without any positions at which `distance` bits can differ."""
    sets = list(combinations(range(POSITIONS), max(1, POSITIONS - distance - 2)))
    if distance == 2:
        sets = [chosen for chosen in sets if reduce(xor, chosen) == 0]
    return sets, min(sum(not {*chosen} & {*differing} for chosen in sets) for differing in combinations(range(POSITIONS), distance))


def postings(fps: DataFrame, width: int, among: Collection[tuple[int, ...]] | None = None) -> DataFrame:
    """fp, kind, bytes: each different fingerprint once for every set of `width` positions, or for those among them that are given."""
    kinds = [(k, chosen) for k, chosen in enumerate(combinations(range(POSITIONS), width)) if among is None or chosen in among]
    sets = F.array(*[F.struct(F.lit(k).alias("kind"), F.col("fp").bitwiseAND(F.lit(_byte_masks(chosen))).alias("bytes")) for k, chosen in kinds])
    # adaptive execution merges fingerprints into a few tasks by their own few bytes, not by those of the entries that each becomes; dealt
    # out by fp itself, they would stay where distinct() put them
    dealt = fps.select("fp").distinct().repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    return dealt.select("fp", F.explode(sets).alias("p")).select("fp", "p.kind", "p.bytes")


def meetings(index: DataFrame, least: int, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b), a < b, that meet in at least `least` postings of at most `crowd` entries, and the fingerprints of larger ones."""
    # only postings with a second entry can give a pair; written, so that the index is counted once and Spark knows how few they are
    full = materialise(index.groupBy("kind", "bytes").agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high")).where("n > 1"))
    few = full.where("n = 2").select(F.col("low").alias("a"), F.col("high").alias("b"))
    many = materialise(index.join(full.where("n > 2").select("kind", "bytes", "n"), ["kind", "bytes"]))
    paired = many.where(F.col("n") <= crowd)
    left, right = paired.select("kind", "bytes", F.col("fp").alias("a")), paired.select("kind", "bytes", F.col("fp").alias("b"))
    more = left.join(right, ["kind", "bytes"]).where("a < b").select("a", "b")
    tally = few.unionByName(more).groupBy("a", "b").count()
    return tally.where(F.col("count") >= least).select("a", "b"), many.where(F.col("n") > crowd).select("fp").distinct()


def looked_up(crowded: DataFrame, distance: int) -> DataFrame:
    """Pairs (a, b), a < b, of crowded fingerprints within `distance` bits, by looking up every value that near."""
    flips = [sum(1 << bit for bit in bits) for n in range(1, distance + 1) for bits in combinations(range(64), n)]
    near = F.explode(F.lit([f - (1 << 64) if f >> 63 else f for f in flips])).alias("flip")
    return crowded.select(F.col("fp").alias("a"), near).select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("b")).where("a < b").join(crowded.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b")


def links(fps: DataFrame, distance: int = 2, crowd: int = CROWD) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints in column fp that differ in at most `distance` bits."""
    sets, least = position_sets(distance)
    met, crowded = meetings(postings(fps, len(sets[0]), sets), least, crowd)
    found = met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    if crowded.limit(1).count():
        found = found.unionByName(looked_up(materialise(crowded), distance)).distinct()
    return found


def components(edges: DataFrame) -> DataFrame:
    """For edges (a, b): one row (node, root) per node with the smallest node of its connected component."""
    edges = materialise(edges.select("a", "b"))
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("v").alias("b")), F.struct(F.col("m").alias("a"), F.col("u").alias("b")))).alias("e")).select("e.a", "e.b").where("a != b").distinct()
        following = materialise(small)
        # done when every node hangs on one root that hangs on nothing
        doubled = following.groupBy("b").count().where("count > 1").limit(1).count()
        chained = following.select(F.col("a").alias("b")).distinct().join(following.select("b"), "b", "left_semi").limit(1).count()
        edges = following
        if not doubled and not chained:
            roots = edges.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2, seed: int = 42) -> DataFrame:
    """One row per document: its key, fingerprint (16 hex digits) and component_id, the smallest key that links reach."""
    fps = materialise(fingerprints(df, key, text, shingle, seed))
    classes = materialise(fps.groupBy("fp").agg(F.min(key).alias("least")))
    roots = components(links(classes, distance))
    of_class = materialise(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    named = of_class.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = of_class.select("fp", "root").join(named, "root").select("fp", "component_id")
    return fps.join(answer, "fp").select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_key(key: str, text: str) -> Column:
    """Tells rows with different keys or texts apart, null keys included; orders by key, null last."""
    return F.struct(F.col(key).isNull().alias("missing"), F.col(key).alias("id"), F.xxhash64(text).alias("mark"))


def keep_rows(df: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """The rows whose row_key is among the chosen ones in column row_; of rows with equal key and text one stays. Helper columns have names that df has not."""
    mark, wanted_id, wanted_mark = (unused(df, name) for name in ("row_mark_", "id_", "mark_"))
    wanted = chosen.select(F.col("row_.id").alias(wanted_id), F.col("row_.mark").alias(wanted_mark))
    marked = df.withColumn(mark, F.xxhash64(text))
    kept = marked.join(wanted.hint("merge"), F.col(key).eqNullSafe(F.col(wanted_id)) & (F.col(mark) == F.col(wanted_mark)), "left_semi")
    repeated = marked.groupBy(key, mark).count().where("count > 1").limit(1).count()
    return (kept.dropDuplicates([key, mark]) if repeated else kept).drop(mark)


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component, the one with the smallest key."""
    rows = near_duplicates(df.select(row_key(key, text).alias("row_"), F.col(text).alias("text_")), "row_", "text_", **options)
    return keep_rows(df, rows.where("row_ <=> component_id").select("row_"), key, text)
