"""Bulk-synchronous best-fit packing of tokenised documents into sequences of a fixed capacity.

Documents become pieces (only those over the capacity are cut; the first piece takes the odd
length). Pieces over half the capacity open a sequence each. The others follow in bands of lengths
(lo, hi], hi = 2 lo, the longest band first, in rounds over two datasets, pieces and gaps:

1. pieces and gaps are range-sorted together, by size from the largest;
2. each range is swept: a piece takes the gap met last, which is its successor, the smallest that
   holds it. A gap of at least hi has room for size / hi pieces, a smaller one for one;
3. pieces left over claim gaps left over in earlier ranges. Claims are settled by rank: only the totals of
   the ranges, which their sweeps have counted, go to the driver, which deals each range's left pieces, by rank, to the nearest earlier
   ranges with gaps left, and a join on (range, place) brings both together;
4. gaps are updated; pieces without any gap open new sequences, the longest kind first, as many of
   consecutive rank in each as fit; what is left goes to the next round.

Defined cases: the literal of an added token of the vocabulary is that token's id where `added_tokens`
is set, as it is unless told otherwise and by the tokenizers library's default, and ordinary text else, as with its
encode_special_tokens; a null or empty text is its end token alone; repeated rows are packed as often as they
occur; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cindermill.llm.bpe import ChunkEncoder, kept_by_worker
from cindermill.llm.common import materialise, texts


def tokenizer_ranks(path: str) -> dict[bytes, int]:
    """Token ranks of a byte-level BPE in a tokenizers .json file, without its special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {t["id"] for t in spec.get("added_tokens", [])}
    # byte-level files write printable bytes as themselves and the others from U+0100 on, in order
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    return {bytes(byte_of[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if rank not in special}


def added_token_ids(path: str) -> dict[str, int]:
    """Ids of the added tokens of a tokenizers .json file by their literals."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens", [])
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that match more or less than their literal")
    return {t["content"]: t["id"] for t in added}


def shared_encoder(df: DataFrame, path: str, pattern: str, added_tokens: bool = True) -> Broadcast:
    """What id_encoder needs, for every task: a vocabulary file's ranks, the pattern and the added tokens."""
    return df.sparkSession.sparkContext.broadcast((tokenizer_ranks(path), pattern, added_token_ids(path) if added_tokens else {}))


#: Packs ids as unsigned 32-bit numbers; machines with the other byte order swap them.
_UINT32 = (lambda ids: array("I", ids)) if sys.byteorder == "little" else (lambda ids: np.array(ids, dtype="<u4"))


class KnownChunks(dict):
    """Packed ids of chunks that follow a space, encoded when first asked for; forgets all of them at `most`."""

    def __init__(self, encode: Callable[[str], bytes], most: int = 300_000):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        made = self[chunk] = self.encode(" " + chunk)
        return made


def id_encoder(spec: tuple[dict[bytes, int], str, dict[str, int]]) -> Callable[[pa.Array], Iterator[bytes]]:
    """Turns a column of texts into their packed little-endian 32-bit ids; chunks are known over columns."""
    import tiktoken

    ranks, pattern, added = spec
    encode_ordinary = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    encode = lambda chunk: _UINT32(encode_ordinary(chunk)).tobytes()
    known, cut = KnownChunks(encode), ChunkEncoder.cut
    literals = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or r"(?!)")
    packed = {literal: np.array([i], dtype="<u4").tobytes() for literal, i in added.items()}

    def plain(text: str) -> bytes:
        first, *rest = cut(text)
        return b"".join([encode(first), *map(known.__getitem__, rest)])

    def of(column: pa.Array) -> Iterator[bytes]:
        for text in texts(column):
            between = literals.split(text)
            ids = plain(between[0])
            yield ids if len(between) == 1 else ids + b"".join(packed[literal] + plain(part) for literal, part in zip(literals.findall(text), between[1:]))

    return of


def tokenised_pieces(df: DataFrame, path: str, pattern: str, capacity: int = 2048, end_id: int = 0, added_tokens: bool = True) -> DataFrame:
    """One row per piece of each document's ids and end token, with the crc32 of its little-endian 32-bit ids."""
    shared, mark = shared_encoder(df, path, pattern, added_tokens), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept_by_worker(mark, lambda: id_encoder(shared.value))
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for at, ids in enumerate(encode(batch.column(1))):
                ids += end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                rows += [(at, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            columns = [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(columns[0]), *columns[1:]], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return df.select("doc_id", "text").mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


GAP, PIECE, PLACED, CLAIM, SLOT, TOTAL = range(6)
#: A total's id is how many of its pieces fit in a sequence, size the number of pieces, sequence_id their length, room the slots.
#: place and before: a left piece's number in its range and the lengths before it; a gap's first slot and its slots that are left.
SWEPT = "kind int, id long, size long, sequence_id long, room long, part int, place long, before long"
#: other and slot: the range and place that a claim and a slot meet at.
SETTLED = "kind int, id long, size long, sequence_id long, room long, other int, slot long"
EXACT = 16


def _fits(capacity: int, size: int) -> int:
    """How many pieces of a size fit in a sequence; from 8 on kinds are two wide, and from EXACT on there is one."""
    fits = min(capacity // size, EXACT)
    return fits if fits < 8 else fits - fits % 2


def _batch(rows: list[tuple], kind: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split(" ") for field in kind.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, {"int": pa.int32(), "long": pa.int64()}[k]) for c, k in zip(columns, kinds)], names=list(names))


def _sweep(hi: int, capacity: int):
    """Over one range of gaps and pieces, largest first: pieces with their gaps, the pieces left over, every gap, and the totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_, pieces, length = TaskContext.get().partitionId(), [], 0, 0
        totals: dict[int, list[int]] = {}
        for batch in batches:
            rows = []
            for kind, ident, size in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if kind == GAP:
                    open_.append([ident, size, max(1, size // hi)])
                elif open_:
                    gap = open_[-1]
                    rows.append((PLACED, ident, size, gap[0], gap[1], part, 0, 0))
                    gap[2] -= 1
                    if not gap[2]:
                        open_.pop()
                        rows.append((GAP, gap[0], gap[1], gap[0], gap[1], part, 0, 0))
                else:
                    rows.append((PIECE, ident, size, None, None, part, pieces, length))
                    pieces, length = pieces + 1, length + size
                    total = totals.setdefault(_fits(capacity, size), [0, 0])
                    total[0], total[1] = total[0] + 1, total[1] + size
            yield _batch(rows, SWEPT)
        slots = 0
        for at in range(0, len(open_), 10_000):
            rows = []
            for ident, size, left in open_[at:at + 10_000]:
                rows.append((GAP, ident, size, ident, size, part, slots, left))
                slots += left
            yield _batch(rows, SWEPT)
        rows = [(TOTAL, fits, *total, 0, part, 0, 0) for fits, total in totals.items()]
        yield _batch(rows + [(TOTAL, 0, 0, 0, slots, part, 0, 0)] if slots else rows, SWEPT)

    return run


def deal_claims(totals: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int], dict[int, int]]:
    """Claims of ranges on earlier ranges from rows (range, pieces left, slots left) in order.

    Gives (range, first piece, end, range of the gaps, slot of the first piece; the next ones take the slots below),
    the number of each range's pieces that have a claim, and the slots that stay free in each range.
    """
    free, claims, claimed = [], [], {}
    for part, pieces, slots in totals:
        done = 0
        while done < pieces and free:
            other, top = free[-1]
            taken = min(top, pieces - done)
            claims.append((part, done, done + taken, other, top - 1))
            done += taken
            if taken == top:
                free.pop()
            else:
                free[-1] = (other, top - taken)
        claimed[part] = done
        if slots:
            free.append((part, slots))
    return claims, claimed, {part: top for part, top in free}


@dataclass
class Settlement:
    """What one round decides, by range: claims, slots that stay free, and where the ranks of pieces without a gap begin."""

    claims: dict[int, list[tuple[int, int, int, int]]]  # first piece, end, range of the gaps, slot of the first piece
    free: dict[int, int]
    claimed: dict[int, int]
    ranks: dict[int, int]
    lengths: dict[int, int]
    most: int  # the pieces without a gap of which so many fit in a sequence open new ones
    label: int

    @classmethod
    def of(cls, totals: list, label: int) -> tuple[Settlement, int]:
        """From the totals by range and by how many pieces fit in a sequence; also how many pieces are left for the next round."""
        by_part: dict[int, list] = {}
        for row in sorted(totals, key=lambda r: (r["part"], r["fits"])):
            by_part.setdefault(row["part"], []).append(row)
        claims, claimed, free = deal_claims([(part, sum(r["pieces"] for r in rows), sum(r["slots"] for r in rows)) for part, rows in by_part.items()])
        made = cls({}, free, claimed, {}, {}, EXACT + 1, label)
        for part, *claim in claims:
            made.claims.setdefault(part, []).append(tuple(claim))
        homeless: dict[int, int] = {}
        ranks = lengths = 0
        for part, rows in by_part.items():  # in rank order: the longest pieces, of which fewest fit, first
            made.ranks[part], made.lengths[part] = ranks, lengths
            done = claimed[part]
            for r in rows:
                left = r["pieces"] - min(done, r["pieces"])
                done -= r["pieces"] - left
                if left:
                    homeless[r["fits"]] = homeless.get(r["fits"], 0) + left
                ranks += left
                lengths += r["length"]
        made.most = min(homeless, default=EXACT + 1)
        return made, sum(n for fits, n in homeless.items() if fits != made.most)

    def settle(self, hi: int, capacity: int):
        """Gives every piece left over its claim, its new sequence or the next round, and turns the wanted gaps into slots."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            opened = 0
            for batch in batches:
                rows = []
                for kind, ident, size, sequence, room, part, place, before in zip(*(c.to_pylist() for c in batch.columns)):
                    if kind == PLACED:
                        rows.append((PLACED, ident, size, sequence, room, None, None))
                    elif kind == GAP:
                        rows.append((GAP, ident, size, sequence, room, None, None))
                        rows += [(SLOT, None, None, sequence, room, part, slot) for slot in range(max(place, self.free.get(part, 0)), place + before)]
                    elif place < self.claimed[part]:
                        first, _, other, slot = next(c for c in self.claims[part] if c[0] <= place < c[1])
                        rows.append((CLAIM, ident, size, None, None, other, slot - (place - first)))
                    elif _fits(capacity, size) != self.most:
                        rows.append((PIECE, ident, size, None, None, None, None))
                    else:
                        rank = self.ranks[part] + place - self.claimed[part]
                        group = rank // self.most if self.most < EXACT else (self.lengths[part] + before) // (capacity - hi)
                        new = -((self.label << 44) + group + 1)  # no piece has a negative number
                        if new != opened:  # a sequence whose pieces are in several tasks is opened more than once, and counted once
                            opened = new
                            rows.append((GAP, new, capacity, new, capacity, None, None))
                        rows.append((PLACED, ident, size, new, capacity, None, None))
                yield _batch(rows, SETTLED)

        return run


def _round(state: DataFrame, hi: int, capacity: int, label: int = 0) -> tuple[DataFrame, int]:
    """One round for pieces of lengths in (hi / 2, hi]: the next state with the pieces placed, and how many are left."""
    lo = hi // 2
    state = state.select("kind", "id", "size")
    order = [F.col("size").desc(), F.col("kind"), F.col("id")]
    active = state.where((F.col("kind") == PIECE) | (F.col("size") > lo))
    swept = materialise(active.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_sweep(hi, capacity), SWEPT))
    # a row for each range and each of its at most EXACT kinds
    totals = swept.where(F.col("kind") == TOTAL).select("part", F.col("id").alias("fits"), F.col("size").alias("pieces"), F.col("sequence_id").alias("length"), F.col("room").alias("slots"))
    settlement, left = Settlement.of(totals.collect(), label)
    settled = swept.where(F.col("kind") != TOTAL).mapInArrow(settlement.settle(hi, capacity), SETTLED)
    rows = settled.where(F.col("kind") <= PLACED).drop("other", "slot")
    if settlement.claims:
        claims = settled.where(F.col("kind") == CLAIM).select("id", "size", "other", "slot")
        slots = settled.where(F.col("kind") == SLOT).select("sequence_id", "room", "other", "slot")
        rows = rows.unionByName(claims.join(slots, ["other", "slot"]).select(F.lit(PLACED).alias("kind"), "id", "size", "sequence_id", "room"))
    in_gap = Window.partitionBy("sequence_id").orderBy("kind", "id")
    length = F.when(F.col("kind") == PLACED, F.col("size")).otherwise(0)
    # a gap comes before its pieces: they are put one after the other, and what is left is a gap again
    updated = rows.where(F.col("kind") != PIECE).withColumns({"number": F.row_number().over(in_gap), "upto": F.sum(length).over(in_gap.rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum(length).over(Window.partitionBy("sequence_id"))})
    none = F.lit(None).cast("long")
    placed = F.col("kind") == PLACED
    kept = updated.where(placed | ((F.col("number") == 1) & (F.col("all") < F.col("room"))))
    made = kept.select("kind", "id", F.when(placed, F.col("size")).otherwise(F.col("room") - F.col("all")).alias("size"), F.when(placed, F.col("sequence_id")).alias("sequence_id"), F.when(placed, F.lit(capacity) - F.col("room") + F.col("upto") - F.col("size")).alias("offset"))
    waiting = rows.where(F.col("kind") == PIECE).unionByName(state.where((F.col("kind") == GAP) & (F.col("size") <= lo)), allowMissingColumns=True)
    return materialise(made.unionByName(waiting.select("kind", "id", "size", none.alias("sequence_id"), none.alias("offset")))), left


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to rows with a length of 1 to capacity."""
    numbered = materialise(pieces.withColumn("_item", F.monotonically_increasing_id()))
    half, none = capacity // 2, F.lit(None).cast("long")
    large = numbered.where(F.col("length") > half)
    rounds = [large.select(F.col("_item").alias("id"), F.col("_item").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    state = large.where(F.col("length") < capacity).select(F.lit(GAP).alias("kind"), F.col("_item").alias("id"), (F.lit(capacity) - F.col("length")).alias("size"))
    bands = [half >> k for k in range(half.bit_length())]
    band = F.lit(None)
    for hi in bands:
        band = F.when((F.col("length") <= hi) & (F.col("length") > hi // 2), hi).otherwise(band)
    sizes = {r["band"]: r["count"] for r in numbered.groupBy(band.alias("band")).count().collect()}
    for hi in bands:
        left = sizes.get(hi, 0)
        if left:
            mine = numbered.where((F.col("length") <= hi) & (F.col("length") > hi // 2))
            state = state.select("kind", "id", "size").unionByName(mine.select(F.lit(PIECE).alias("kind"), F.col("_item").alias("id"), F.col("length").alias("size")))
        while left:
            made, left = _round(state, hi, capacity, len(rounds))
            rounds.append(made.where(F.col("kind") == PLACED).select("id", "sequence_id", "offset"))
            state = made.where(F.col("kind") != PLACED)
    places = reduce(DataFrame.unionByName, rounds).withColumnRenamed("id", "_item")
    return numbered.join(places, "_item").drop("_item")


def pack_documents(df: DataFrame, path: str, pattern: str, capacity: int = 2048, added_tokens: bool = True) -> DataFrame:
    """Tokenise documents and pack their pieces."""
    return pack(tokenised_pieces(df, path, pattern, capacity, added_tokens=added_tokens), capacity)
