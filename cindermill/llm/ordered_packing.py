"""Order-preserving packing: the token stream of consecutive documents is cut into windows by dynamic programming.

The ids of a table's documents follow each other in the order in which its rows are read. Windows of at
most `capacity` ids are cut from them without a change of order, so nothing is shuffled: a task tokenises its rows and cuts
them in runs of whole documents of about `run_tokens` ids. A run's cuts are the cheapest way from its begin to its
end: a window costs its padding, a cut its penalty. Cuts stand at the ends of documents, for nothing, or of sentences, for a small
penalty; where a sentence is longer than a window, also between any two of its ids, for a larger one. A window whose length is a
power of two is not padded.

With f(j) the least cost up to place p(j), padding makes f(j) = penalty(j) + capacity - p(j) + min(f(i) + p(i)) over the
windows that end there: a sliding minimum, which a queue that keeps only rising values gives without a search. The
unpadded lengths are at most log2(capacity) + 1 further candidates.

Defined cases: a null or empty text is its end token alone; added tokens as in `packing`; repeated rows are packed as often as they occur; a
document longer than a run is a run of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from cindermill.llm.bpe import kept_by_worker
from cindermill.llm.packing import id_encoder, shared_encoder

CAPACITY, RUN_TOKENS = 2048, 1 << 20
SENTENCE, WITHIN = 4, 32  # penalties in ids of padding


STOP, SPACE, BREAK = 1, 2, 4


def sentence_marks(ranks: dict[bytes, int], size: int) -> np.ndarray:
    """By id, as bits: it ends a sentence if white space follows, it begins with white space, it breaks a line."""
    marks = np.zeros(size, np.uint8)
    for token, rank in ranks.items():
        marks[rank] = STOP * token.rstrip(b"\"')]").endswith((b".", b"!", b"?")) | SPACE * token[:1].isspace() | BREAK * (b"\n" in token)
    return marks


def sentence_ends(ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """For every id but the last whether a sentence ends behind it."""
    bits = marks[ids]
    here, next_ = bits[:-1], bits[1:]
    return ((here & STOP & next_ >> 1) | (here & ~next_) >> 2).astype(bool)


def cut_places(places: np.ndarray, penalties: np.ndarray, capacity: int = CAPACITY, within: int = WITHIN) -> tuple[np.ndarray, np.ndarray]:
    """Rising places with their penalties, and every place of the spans between them that are longer than a window."""
    long = np.flatnonzero(np.diff(places, prepend=0) > capacity)
    if len(long):
        more = np.concatenate([np.arange((places[k - 1] if k else 0) + 1, places[k]) for k in long])
        order = np.argsort(np.concatenate([places, more]), kind="stable")
        penalties = np.concatenate([penalties, np.full(len(more), within)])[order]
        places = np.concatenate([places, more])[order]
    return places, penalties


def unpadded(places: np.ndarray, capacity: int) -> tuple[list[int], list[int], list[int]]:
    """(j, i, power): numbers of places a power of two apart, i before j, in order of j; place 0 has number 0, others count from 1."""
    whole = np.concatenate([[0], places])
    number = np.full(whole[-1] + 1, -1, np.int32)
    number[whole] = np.arange(len(whole))
    found = []
    for power in (1 << k for k in range(capacity.bit_length())):
        later = np.searchsorted(whole, power)
        at = number[whole[later:] - power]
        some = np.flatnonzero(at >= 0)
        found.append(np.stack([some + later, at[some], np.full(len(some), power)]))
    pairs = np.concatenate(found, axis=1)
    return tuple(pairs[:, np.argsort(pairs[0], kind="stable")].tolist())


def cheapest_cuts(places: np.ndarray, penalties: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """The places of the cheapest cuts from 0 to the last place; no two neighbouring places may be more than capacity apart."""
    ends, begins, powers = unpadded(places, capacity)
    ends.append(-1)
    # worth is cost plus place, so that a padded window adds capacity to it and an unpadded one its length
    at, worth, back, pair = [0, *places.tolist()], [0], [-1], 0
    queue, head, k = [0], 0, 0  # numbers with rising worth
    for place, penalty in zip(places.tolist(), penalties.tolist()):
        k += 1
        low = place - capacity
        while at[queue[head]] < low:
            head += 1
        begin = queue[head]
        value = worth[begin] + capacity
        while ends[pair] == k:
            i = begins[pair]
            if worth[i] + powers[pair] < value:
                begin, value = i, worth[i] + powers[pair]
            pair += 1
        value += penalty
        worth.append(value)
        back.append(begin)
        while len(queue) > head and worth[queue[-1]] >= value:
            queue.pop()
        queue.append(k)
    cuts = []
    while k > 0:
        cuts.append(at[k])
        k = back[k]
    return cuts[::-1]


class Run:
    """Documents of one run, as far as they have come."""

    def __init__(self):
        self.size, self.ids, self.ends = 0, [], []

    def add(self, ids: bytes) -> None:
        """A document's ids with the end token."""
        self.ids.append(ids)
        self.size += len(ids) // 4
        self.ends.append(self.size)

    def candidates(self, marks: np.ndarray, sentence: int) -> tuple[np.ndarray, np.ndarray]:
        """Places to cut at, with penalties: the ends of documents and of sentences, but none before an end token."""
        ends = np.array(self.ends)
        open_ = np.append(sentence_ends(np.frombuffer(b"".join(self.ids), "<u4"), marks), False)
        open_[np.maximum(ends - 2, 0)] = False
        open_[ends - 1] = True
        places = np.flatnonzero(open_) + 1
        penalties = np.full(len(places), sentence)
        penalties[np.searchsorted(places, ends)] = 0
        return places, penalties

    def pieces(self, marks: np.ndarray, sentence: int, capacity: int, within: int, first: int) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """(number of the document, start, length, crc32, tokens of the document, sequence, offset); sequences are counted from `first`."""
        cuts = cheapest_cuts(*cut_places(*self.candidates(marks, sentence), capacity, within), capacity)
        sequence, begin, upto = first, 0, iter(cuts)
        end = next(upto)
        low = 0
        for row, (ids, high) in enumerate(zip(self.ids, self.ends)):
            start = low
            while start < high:
                stop = min(end, high)
                yield row, start - low, stop - start, zlib.crc32(ids[4 * (start - low):4 * (stop - low)]), high - low, sequence, start - begin
                start = stop
                if stop == end:
                    sequence, begin, end = sequence + 1, end, next(upto, None)
            low = high


def pack_in_order(df: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, end_id: int = 1, added_tokens: bool = True, sentence: int = SENTENCE, within: int = WITHIN, run_tokens: int = RUN_TOKENS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for every piece of the documents' ids and end tokens."""
    shared, mark = shared_encoder(df, path, pattern, added_tokens), uuid.uuid4().hex
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, marks = kept_by_worker(mark, lambda: (id_encoder(shared.value), sentence_marks(shared.value[0], 1 + max(end_id, *shared.value[0].values(), *shared.value[2].values()))))
        end, sequence = np.array([end_id], dtype="<u4").tobytes(), TaskContext.get().partitionId() << 40
        held, keys = Run(), []

        def close() -> pa.RecordBatch:
            nonlocal sequence, held, keys
            columns = list(zip(*held.pieces(marks, sentence, capacity, within, sequence)))
            sequence = columns[5][-1] + 1
            ids = pa.concat_arrays(keys).take(pa.array(columns[0], pa.int64()))
            held, keys = Run(), []
            return pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in columns[1:])], names=["doc_id", *names])

        for batch in batches:
            taken = 0
            for row, ids in enumerate(encode(batch.column(1)), 1):
                held.add(ids + end)
                if held.size >= run_tokens:
                    keys.append(batch.column(0).slice(taken, row - taken))
                    taken = row
                    yield close()
            keys.append(batch.column(0).slice(taken))
        if held.size:
            yield close()

    kinds = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, {', '.join(f'{name} long' for name in names)}"
    return df.select("doc_id", "text").mapInArrow(run, kinds)
