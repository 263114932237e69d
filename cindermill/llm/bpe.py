"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

A sequence of tokens is the BPE encoding of its bytes exactly if every neighbouring pair of its
tokens is (no merge of a smaller rank reaches across the boundary while it is open). So the encoding
of every prefix has one last token, and reading left to right needs only the token emitted last and
the bytes after it. Those two make up a state of the transducer. States and transitions are built
when first met and kept in tables; a boundary is emitted as soon as the encodings of all prefixes
that a later token can still start from share it, which the longest token bounds.

Decoding keeps a UTF-8 automaton of nine states; for each state and token the state after the whole
token is looked up, and characters come out as soon as they are complete.

Defined cases: a null text counts as empty and gives no tokens. Text of any length is cut before
single spaces only, where no match of the pattern can cross.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import TypeVar

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cindermill.llm.common import texts

T = TypeVar("T")


def read_ranks(path: str) -> dict[bytes, int]:
    """The token ranks of a .tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


START, DEAD = -1, -2


class State(dict):
    """A state of the transducer: byte -> (next state, token that ends there), filled in when first asked for."""

    __slots__ = ("machine", "suffix", "lasts")

    def __init__(self, machine: MergeTransducer, suffix: bytes, lasts: tuple[int, ...]):
        self.machine, self.suffix, self.lasts = machine, suffix, lasts

    def __missing__(self, byte: int) -> tuple[State, int]:
        made = self[byte] = self.machine.move(self, byte)
        return made


class Parts(dict):
    """token -> the two tokens that its last merge joins, None for a single byte."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}

    def __missing__(self, token: int) -> tuple[int, int] | None:
        pieces = [self.tokens[token][i:i + 1] for i in range(len(self.tokens[token]))]
        while len(pieces) > 2:
            at = min(range(len(pieces) - 1), key=lambda i: self.ranks.get(pieces[i] + pieces[i + 1], 1 << 60))
            pieces[at:at + 2] = [pieces[at] + pieces[at + 1]]
        made = self[token] = (self.ranks[pieces[0]], self.ranks[pieces[1]]) if len(pieces) == 2 else None
        return made


class MergeTransducer:
    """Encodes one pre-token at a time; at most max_states states are kept before starting anew."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 200_000, lookahead: int = 4096):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        #: a token, or the beginning of one -> its rank or -1, and whether a longer token begins with it
        self.known = {token: (rank, False) for token, rank in ranks.items()}
        for token in ranks:
            for n in range(len(token)):
                self.known[token[:n]] = (ranks.get(token[:n], -1), True)
        #: left << 32 | right -> the rank that merging two tokens gives
        self.merges = {ranks[token[:n]] << 32 | ranks[token[n:]]: rank for token, rank in ranks.items() for n in range(1, len(token)) if token[:n] in ranks and token[n:] in ranks}
        self.max_states, self.lookahead = max_states, lookahead
        self.parts = Parts(ranks)
        self._pairs: dict[int, bool] = {}
        self._bytes = [bytes((b,)) for b in range(256)]
        self._restart()

    def _restart(self) -> None:
        for state in getattr(self, "states", {}).values():
            state.clear()  # states point at each other
        #: (bytes from the earliest place where a token can still start, for each place the token that ends there or DEAD) -> the state
        self.states: dict[tuple[bytes, tuple[int, ...]], State] = {}
        self.first = self._state(b"", (START,))

    def _state(self, suffix: bytes, lasts: tuple[int, ...]) -> State:
        state = self.states.get((suffix, lasts))
        if state is None:
            state = self.states[suffix, lasts] = State(self, suffix, lasts)
        return state

    def stays_apart(self, left: int, right: int) -> bool:
        """Whether no merge crosses the boundary of two tokens, going back through the merges that made them."""
        a, b, limit, apart, merged, parts = left, right, 1 << 60, True, self.merges.get, self.parts
        while True:
            if merged(a << 32 | b, limit) < limit:
                apart = False
                break
            older_a, older_b = parts[a], parts[b]
            if older_b is None or (older_a is not None and a > b):
                if older_a is None:
                    break
                limit, a = a, older_a[1]
            else:
                limit, b = b + 1, older_b[0]  # of two equal merges the left one comes first
        if len(self._pairs) > 500_000:
            self._pairs.clear()
        self._pairs[left << 32 | right] = apart
        return apart

    def move(self, state: State, byte: int) -> tuple[State, int]:
        """The state after one more byte, and the last token of the encoding of all bytes up to it."""
        suffix, pairs, known, found, live = state.suffix + self._bytes[byte], self._pairs, self.known, None, []
        for p, last in enumerate(state.lasts):
            if last != DEAD:
                token, longer = known.get(suffix[p:], (-1, False))
                if token >= 0 and found is None:
                    apart = last == START or pairs.get(last << 32 | token)
                    if apart is None:
                        apart = self.stays_apart(last, token)
                    if apart:
                        found = token
                if longer:
                    live.append(last)
                    continue
            if live:  # places before the first one alive are left out
                live.append(DEAD)
        if found is None:
            raise ValueError("the vocabulary has no token for a byte")
        live.append(found)
        return self._state(suffix[len(suffix) + 1 - len(live):], tuple(live)), found

    def _boundary(self, state: State, ends: list[int]) -> int:
        """The last token boundary that every continuation shares; ends has the token ending after each byte."""
        place = len(ends)
        base = place + 1 - len(state.lasts)
        for p in (base + k for k, last in enumerate(state.lasts) if last != DEAD):
            while p != place:
                if place > p:
                    place -= self.sizes[ends[place - 1]]
                else:
                    p -= self.sizes[ends[p - 1]]
        return place

    def _path(self, ends: list[int], place: int) -> list[int]:
        out, sizes = [], self.sizes
        while place:
            token = ends[place - 1]
            out.append(token)
            place -= sizes[token]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        if len(self.states) > self.max_states:
            self._restart()
        state, out, ends = self.first, [], []
        add, most = ends.append, self.lookahead
        for start in range(0, len(piece), most):
            if start and (place := self._boundary(state, ends)):
                out += self._path(ends, place)
                del ends[:place]
            for byte in piece[start:start + most] if len(piece) > most else piece:
                state, token = state[byte]
                add(token)
        return out + self._path(ends, len(ends))


#: A space after white space, or white space at the end: there, cutting at every space is not exact.
_ODD_SPACE = re.compile(r"\s |\s\Z")


class Recent:
    """A cache of two generations, filled for many keys at once: when the younger is full it becomes the older one, which goes."""

    def __init__(self, make: Callable[[set[str]], dict[str, T]], size: int):
        self.make, self.size, self.old = make, size, {}
        self.now: dict[str, T] = {}
        self.long: list[str] = []

    def fill(self, wanted: set[str]) -> dict[str, T]:
        """A dictionary with all that is wanted, good until the next call."""
        for key in self.long:  # long keys are not kept
            self.now.pop(key, None)
        missing = wanted - self.now.keys()
        if len(self.now) + len(missing) > self.size:
            self.old, self.now, missing = self.now, {}, wanted
        found = {key: self.old[key] for key in missing & self.old.keys()}
        self.now.update(found)
        made = self.make(missing - found.keys())
        self.now.update(made)
        self.long = [key for key in made if len(key) > 64]
        return self.now


class ChunkEncoder:
    """Encodes whole texts chunk by chunk; a chunk is what stands between two spaces, encoded with the space before it.

    `encode` turns a set of strings into their encodings, which a bounded cache keeps for chunks.
    """

    def __init__(self, encode: Callable[[set[str]], dict[str, T]], cached: int = 200_000, group: int = 1 << 21):
        self.encode, self.group = encode, group
        self.chunks = Recent(lambda new: {key[1:]: made for key, made in encode({" " + key for key in new}).items()}, cached)

    @staticmethod
    def cut(text: str) -> list[str]:
        parts = text.split(" ")
        if not _ODD_SPACE.search(text):
            return parts
        joined = [parts[0]]
        for part in parts[1:]:
            if not joined[-1] or joined[-1][-1].isspace():
                joined[-1] += " " + part
            else:
                joined.append(part)
        return joined

    def of(self, texts: Iterable[str]) -> Iterator[list[T]]:
        """For each text the encodings of its chunks in order; texts are taken in groups of about `group` characters."""
        held, size = [], 0
        for text in texts:
            held.append(self.cut(text))
            size += len(text)
            if size >= self.group:
                yield from self._group(held)
                held, size = [], 0
        yield from self._group(held)

    def _group(self, cuts: list[list[str]]) -> Iterator[list[T]]:
        first = self.encode({cut[0] for cut in cuts})
        known = self.chunks.fill(set().union(*(cut[1:] for cut in cuts)))
        for cut in cuts:
            yield [first[cut[0]], *map(known.__getitem__, cut[1:])]


#: Fixed value: the pattern whose matches in a chunk of Latin letters and closing marks are known beforehand.
WORDS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ɏ]+)([,.;:!?]*)")


def pattern_encoder(ranks: dict[bytes, int], pattern: str, cached: int = 200_000) -> ChunkEncoder:
    """Encodes each match of the pattern by the transducer: packed little-endian unsigned 32-bit ids, and the ids in decimal."""
    find, transducer, plain = regex.compile(pattern).findall, MergeTransducer(ranks), _PLAIN.fullmatch if pattern == WORDS_PATTERN else lambda chunk: None

    def encode_matches(new: set[str]) -> dict[str, tuple[bytes, bytes]]:
        # in order, so that neighbours take the same way through the transducer
        return {match: packed(transducer.encode(data)) for data, match in sorted((match.encode(), match) for match in new)}

    def packed(ids: list[int]) -> tuple[bytes, bytes]:
        return array("I", ids).tobytes(), " ".join(map(str, ids)).encode()

    matches = Recent(encode_matches, cached * 3 // 2)

    def encode(chunks: set[str]) -> dict[str, tuple[bytes, bytes]]:
        cut = {}
        for chunk in chunks:
            found = plain(chunk)
            cut[chunk] = find(chunk) if found is None else found.groups() if found[2] else (found[1],)
        known, out = matches.fill(set().union(*cut.values())), {}
        for chunk, parts in cut.items():
            if len(parts) == 1:
                out[chunk] = known[parts[0]]
            else:
                made = [known[part] for part in parts]
                out[chunk] = b"".join([ids for ids, _ in made]), b" ".join([decimal for _, decimal in made])
        return out

    return ChunkEncoder(encode, cached)


def ids_of(parts: list[tuple[bytes, bytes]]) -> np.ndarray:
    """The ids of a text from its encoded chunks."""
    return np.frombuffer(b"".join([ids for ids, _ in parts]), dtype="<u4")


ACCEPT, REJECT = 0, 8


def _utf8_moves() -> list[list[int]]:
    """States: 0 between characters; 1, 2, 3 so many continuation bytes to come; 4 to 7 after E0, ED, F0 and F4, whose next byte is narrower; 8 invalid."""
    moves = [[REJECT] * 256 for _ in range(9)]
    for byte in range(256):
        if byte < 0x80:
            moves[0][byte] = 0
        elif 0xC2 <= byte <= 0xDF:
            moves[0][byte] = 1
        elif 0xE0 <= byte <= 0xEF:
            moves[0][byte] = {0xE0: 4, 0xED: 5}.get(byte, 2)
        elif 0xF0 <= byte <= 0xF4:
            moves[0][byte] = {0xF0: 6, 0xF4: 7}.get(byte, 3)
        if 0x80 <= byte <= 0xBF:
            for state in (1, 2, 3):
                moves[state][byte] = state - 1
            moves[4 if byte >= 0xA0 else 5][byte] = 1
            moves[6 if byte >= 0x90 else 7][byte] = 2
    return moves


class StreamDecoder:
    """Turns token ids into text; characters come out when their last byte has come in."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.bytes = _utf8_moves()
        self.after: list[dict[int, int]] = [{} for _ in range(9)]
        self.whole = np.zeros(max(tokens, default=0) + 1, dtype=bool)
        for token in tokens:
            self.whole[token] = self.step(ACCEPT, token) == ACCEPT
        self.state, self.held = ACCEPT, b""

    def step(self, state: int, token: int) -> int:
        """The automaton's state after a whole token."""
        now = self.after[state].get(token)
        if now is None:
            now = state
            for byte in self.tokens[token]:
                now = self.bytes[now][byte]
            self.after[state][token] = now
        return now

    def feed(self, ids: Iterable[int]) -> str:
        """The characters completed by more ids; bytes that cannot be UTF-8 become U+FFFD."""
        ids, out, at = np.asarray(ids, dtype=np.int64), [], 0
        numbers = ids.tolist()
        data = list(map(self.tokens.__getitem__, numbers))
        # between these places no token leaves a character open
        for begin in [*[0] * (self.state != ACCEPT and bool(numbers)), *np.flatnonzero(~self.whole[ids]).tolist()]:
            if begin < at:
                continue
            out.append(b"".join(data[at:begin]).decode())
            at, state = begin, self.state
            while at < len(numbers):
                state = self.step(state, numbers[at])
                at += 1
                if state in (ACCEPT, REJECT):
                    break
            out.append(self._feed(numbers[begin:at]))
        out.append(b"".join(data[at:]).decode())
        return "".join(out)

    def _feed(self, ids: list[int]) -> str:
        data, state = [self.held], self.state
        for token in ids:
            state = self.step(state, token)
            data.append(self.tokens[token])
            if state == REJECT:
                data, state = [b"".join(data).decode("utf-8", "replace").encode()], ACCEPT
        joined = b"".join(data)
        cut = len(joined)
        if state != ACCEPT:  # the open character starts at the last lead byte
            cut = max(i for i in range(len(joined)) if joined[i] >= 0xC0)
        self.state, self.held = state, joined[cut:]
        return joined[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        left, self.state, self.held = self.held.decode("utf-8", "replace"), ACCEPT, b""
        return left

    def decode(self, ids: Iterable[int], block: int = 1 << 16) -> Iterator[str]:
        """The whole text in blocks."""
        for start in range(0, len(ids), block):
            yield self.feed(ids[start:start + block])
        yield self.finish()


_kept: dict[str, object] = {}


def kept_by_worker(mark: str, make: Callable[[], T]) -> T:
    """What `make` builds, kept for the tasks that one Python worker runs after each other; only the last mark's is kept."""
    if mark not in _kept:
        _kept.clear()
        _kept[mark] = make()
    return _kept[mark]


@contextmanager
def without_collector() -> Iterator[None]:
    """No search for reference cycles meanwhile: it would walk through the caches again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def encode_decode(df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: its key, n_tokens, ids_sha256 of the decimal ids and decoded_sha256 of what the ids decode to.

    The ranks are sent to every task; their number is that of the vocabulary.
    """
    shared, mark = df.sparkSession.sparkContext.broadcast((ranks, pattern)), uuid.uuid4().hex

    def tools() -> tuple[ChunkEncoder, StreamDecoder]:
        return pattern_encoder(*shared.value), StreamDecoder({rank: token for token, rank in shared.value[0].items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = kept_by_worker(mark, tools)
        seen: dict[bytes, tuple[int, str, str]] = {}  # copies met by one task are worked out once

        def describe(parts: list[tuple[bytes, bytes]]) -> tuple[int, str, str]:
            ids, decoded = ids_of(parts), hashlib.sha256()
            for part in decoder.decode(ids):
                decoded.update(part.encode())
            return len(ids), hashlib.sha256(b" ".join([decimal for _, decimal in parts if decimal])).hexdigest(), decoded.hexdigest()

        for batch in batches:
            with without_collector():
                if len(seen) >= 100_000:
                    seen.clear()
                marks = [hashlib.blake2b(value.encode(), digest_size=16).digest() for value in texts(batch.column(1))]
                new = {mark: at for at, mark in enumerate(marks) if mark not in seen}
                described = map(describe, encoder.of(batch.column(1)[at].as_py() or "" for at in new.values()))
                seen.update(zip(new, described))
                n, ids_hash, text_hash = zip(*map(seen.__getitem__, marks)) if marks else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return df.select(key, text).mapInArrow(run, schema)


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: its key and the array `ids`."""
    shared, mark = df.sparkSession.sparkContext.broadcast((ranks, pattern)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(mark, lambda: pattern_encoder(*shared.value))
        for batch in batches:
            ids = [ids_of(parts).astype(np.int32) for parts in encoder.of(texts(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, ids array<int>")


def decode(df: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per array of ids: its key and the decoded text."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = StreamDecoder({rank: token for token, rank in shared.value.items()})
        for batch in batches:
            out = ["".join(decoder.decode(value.as_py() or [])) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[key, "text"])

    return df.select(key, ids).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, text string")
