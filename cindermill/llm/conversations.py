"""Repair of the turn structure of conversations by integer weights on a graph of edits.

A conversation's rows become a path through a small automaton of role initials: an optional system
turn, then user and assistant in turn, ending with the assistant, or nothing at all. Each edit is an edge with
one integer as its weight: the high digits are its cost, and of the low digits, one for each place
of the audit, the one at the edit's place is its letter's code; places behind the audit's end stay zero. A node
knows its row, its state and how many letters came before, so an edge's weight is fixed, weights only add up, and the smallest
integer is the cheapest path with the least audit in ASCII order.

Rows are sorted by conversation and turn over ranges, which split long conversations, and cut into blocks of
a bounded number of rows. A block's smallest weights from each state to each other are found by themselves; the
blocks of a conversation are then added in order, which needs the letters only, never the texts. That is the same minimum:
two paths of one block with equal costs have audits of which neither begins the other, since what the longer one
has more would be insertions, which cost more. The chosen path goes back to the blocks, which write the repaired turns.

Defined cases: null roles and texts count as one space, and so do null ids and turns where they are written out;
an empty role has no initial, so it is never kept; rows of one turn are ordered by role and text; rows of a null conv_id are one
conversation; repeated rows are duplicates of their first; a conversation without rows has zeros and an empty
audit; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import materialise

#: Costs of edits, and of a truncated row that is not deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Letters of the audit in ASCII order; their codes are 1 to 4, 0 is behind the end.
LETTERS = "DIKR"
D, I, K, R = range(1, 5)
#: States: nothing yet, after system, after user, after assistant. A conversation ends in the first or the last.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
FOLLOWS = {"s": (SYSTEM, (START,)), "u": (USER, (START, SYSTEM, ASSISTANT)), "a": (ASSISTANT, (USER,))}
LEGAL = ("su", "ua", "au")
BITS = 3
BLOCK_ROWS, BLOCK_CHARS = 32, 1 << 20
#: White space as the contract has it, within a character class.
SPACE = r"\x20\x09-\x0D"


class Row(NamedTuple):
    """What the edits of a row depend on."""

    initial: str
    required: bool  # blank or duplicate: it has to go
    truncated: bool


def block_weights(rows: list[Row], state: int) -> dict[int, tuple[int, str]]:
    """For every state that the rows can lead to from `state`: the cost and audit of the smallest weight."""
    most = (DELETE * len(rows) + 2 * INSERT) // INSERT  # deleting all rows costs no more than this many insertions
    places = len(rows) + most
    cost_at = BITS * places
    letter = [[code << BITS * (places - 1 - p) for p in range(places)] for code in range(5)]
    insert, delete = INSERT << cost_at, DELETE << cost_at
    best: list[list[int | None]] = [[None] * 4 for _ in range(most + 1)]  # by insertions so far and state
    best[0][state] = 0

    def relax(nodes: list, k: int, to: int, weight: int) -> None:
        if nodes[k][to] is None or weight < nodes[k][to]:
            nodes[k][to] = weight

    def insertions(done: int) -> None:
        for k in range(most):
            for q, weight in enumerate(best[k]):
                if weight is not None:
                    relax(best, k + 1, ASSISTANT if q == USER else USER, weight + insert + letter[I][done + k])

    for done, row in enumerate(rows):
        insertions(done)
        after: list[list[int | None]] = [[None] * 4 for _ in range(most + 1)]
        kept = (TRUNCATED if row.truncated else 0) << cost_at
        changed = kept + (REROLE << cost_at)
        keep_to, keep_from = FOLLOWS.get(row.initial, (None, ()))
        for k, nodes in enumerate(best):
            for q, weight in enumerate(nodes):
                if weight is None:
                    continue
                relax(after, k, q, weight + delete + letter[D][done + k])
                if not row.required:
                    if q in keep_from:
                        relax(after, k, keep_to, weight + kept + letter[K][done + k])
                    relax(after, k, ASSISTANT if q == USER else USER, weight + changed + letter[R][done + k])
        best = after
    insertions(len(rows))
    out = {}
    for q in range(4):
        weights = [nodes[q] for nodes in best if nodes[q] is not None]
        if weights:
            out[q] = _read(min(weights), places)
    return out


def _read(weight: int, places: int) -> tuple[int, str]:
    """Cost and audit of a weight."""
    digits = [weight >> BITS * (places - 1 - p) & 7 for p in range(places)]
    return weight >> BITS * places, "".join(LETTERS[code - 1] for code in digits if code)


def _digits(audit: str) -> int:
    value = 0
    for letter in audit:
        value = value << BITS | LETTERS.index(letter) + 1
    return value


class Chain:
    """The smallest weights of a conversation's blocks so far, by state, and the ways to them."""

    def __init__(self):
        self.places, self.at = 0, {START: (0, 0, None)}  # state -> (weight, letters, (way before, segment))

    def add(self, entries: list[tuple[int, int, int, str]]) -> None:
        """One more block from rows (from state, to state, cost, audit)."""
        more = max((len(audit) for *_, audit in entries), default=0)
        places, after = self.places + more, {}
        for begin, end, cost, audit in entries:
            if begin not in self.at:
                continue
            weight, letters, way = self.at[begin]
            high, low = weight >> BITS * self.places, weight & (1 << BITS * self.places) - 1
            added = (high + cost << BITS * places) + (low << BITS * more) + (_digits(audit) << BITS * (places - letters - len(audit)))
            if end not in after or added < after[end][0]:
                after[end] = (added, letters + len(audit), (way, begin, audit))
        self.places, self.at = places, after

    def result(self) -> tuple[int, list[tuple[int, str]]]:
        """The cost, and for each block the state before it and its part of the audit."""
        weight, _, way = min((self.at[q] for q in ENDS if q in self.at), key=lambda node: node[0])
        segments = []
        while way is not None:
            way, begin, audit = way
            segments.append((begin, audit))
        return weight >> BITS * self.places, segments[::-1]


def repaired_turns(lines: list[tuple[str, str]], state: int, audit: str) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that an audit leaves of rows (role, text)."""
    rows = iter(lines)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit == "K":
            state = FOLLOWS[role[0]][0]
        else:
            state = ASSISTANT if state == USER else USER
            role = "assistant" if state == ASSISTANT else "user"
        yield edit, role, text


def faulty_rows(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) one by one with copy, blank, duplicate and truncated.

    A row is a duplicate unless it is the first copy in the first turn of its role and text; that turn is a
    minimum, combined before the shuffle, so no conversation and no repeated text is one group.
    """
    same = ["conv_id", "turn", "role", "text"]
    counted = rows.groupBy(*same).agg(F.sum("copies").alias("n"), F.lit(False).alias("first"))
    firsts = rows.groupBy("conv_id", "role", "text").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("t")).select("conv_id", F.col("t.turn").alias("turn"), "role", "text", F.lit(0).cast("long").alias("n"), F.lit(True).alias("first"))
    merged = counted.unionByName(firsts).groupBy(*same).agg(F.sum("n").alias("n"), F.max("first").alias("first"))
    each = merged.select(*same, "first", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    duplicate = ~blank & ~(F.col("first") & (F.col("copy") == 1))
    return each.select(*same, "copy", blank.alias("blank"), duplicate.alias("duplicate"), (~blank & ~duplicate & ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("truncated"))


def _block_schema(df: DataFrame) -> str:
    conv, turn = (df.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    return f"conv_id {conv}, part int, block long, first_turn {turn}, last_turn {turn}, turns long, head string, tail string, illegal long, blank long, duplicate long, truncated long, entries array<struct<begin:int,end:int,cost:long,audit:string>>, lines array<struct<role:string,text:string>>"


def blocks(rows: DataFrame) -> DataFrame:
    """Faulty rows sorted by conversation and turn and cut into blocks: what each adds to the counts, its weights, and its rows."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]
    kinds = _block_schema(rows)
    arrow = _arrow_schema(rows, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, made, held, chars, whole = TaskContext.get().partitionId(), 0, [], [], 0, False

        def close() -> None:
            nonlocal number, held, chars, whole
            facts = [Row(r[2][:1], r[4] or r[5], r[6]) for r in held]
            # a conversation whose first row the range has begins at the start; others may come from any state
            states = (START,) if whole else range(4)
            entries = [{"begin": q, "end": end, "cost": cost, "audit": audit} for q in states for end, (cost, audit) in block_weights(facts, q).items()]
            turns = [r[1] for r in held if r[1] is not None]
            initials = [f.initial for f in facts]
            made.append({
                "conv_id": held[0][0], "part": part, "block": number, "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None, "turns": len(set(turns)),
                "head": initials[0], "tail": initials[-1], "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
                "blank": sum(r[4] for r in held), "duplicate": sum(r[5] for r in held), "truncated": sum(r[6] for r in held),
                "entries": entries, "lines": [{"role": r[2], "text": r[3]} for r in held],
            })
            number, held, chars, whole = number + 1, [], 0, False

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                other = bool(held) and held[0][0] != row[0]
                if other or len(held) >= BLOCK_ROWS or chars >= BLOCK_CHARS:
                    close()
                    whole = other
                held.append(row)
                chars += len(row[3])
            yield pa.RecordBatch.from_pylist(made, schema=arrow)
            made = []
        if held:
            close()
        yield pa.RecordBatch.from_pylist(made, schema=arrow)

    columns = rows.select("conv_id", "turn", "role", "text", "blank", "duplicate", "truncated", "copy")
    return columns.repartitionByRange(*order).sortWithinPartitions(*order).drop("copy").mapInArrow(run, kinds)


def _arrow_schema(df: DataFrame, kinds: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(kinds))


CHOSEN = "part int, block long, state int, segment string"
TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def choose(cut: DataFrame) -> DataFrame:
    """For every block its state and part of the audit; the first block of a conversation also has its totals and whole audit.

    The blocks of a conversation stream through one task in order, without their texts: the audit is one value, whatever reads it.
    """
    kinds = f"conv_id {cut.schema['conv_id'].dataType.simpleString()}, {CHOSEN}, {', '.join(f'{c} long' for c in TOTALS)}, audit string"
    arrow = _arrow_schema(cut, kinds)
    needed = ["conv_id", "part", "block", "first_turn", "last_turn", "turns", "head", "tail", "illegal", "blank", "duplicate", "truncated", "entries"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chain, out = [], None, []

        def close() -> None:
            cost, segments = chain.result()
            for (part, block), (state, segment) in zip(keys, segments):
                out.append({"conv_id": held[0]["conv_id"], "part": part, "block": block, "state": state, "segment": segment})
            gaps = high - low + 1 - turns if low is not None else 0
            out[-len(keys)] |= {"gaps": gaps, "cost": cost, "audit": "".join(s for _, s in segments), **sums}

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    close()
                    held = []
                if not held:
                    held, chain, keys, low, high, turns, sums = [row], Chain(), [], None, None, 0, dict.fromkeys(("illegal", "blank", "duplicate", "truncated"), 0)
                    tail = None
                for name in sums:
                    sums[name] += row[name]
                sums["illegal"] += tail is not None and tail + row["head"] not in LEGAL
                tail = row["tail"]
                if row["turns"]:
                    turns += row["turns"] - (high is not None and high == row["first_turn"])
                    low, high = row["first_turn"] if low is None else low, row["last_turn"]
                chain.add([(e["begin"], e["end"], e["cost"], e["audit"]) for e in row["entries"]])
                keys.append((row["part"], row["block"]))
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
            out = []
        if held:
            close()
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return cut.select(*needed).repartition("conv_id").sortWithinPartitions("conv_id", "part", "block").mapInArrow(run, kinds)


class Repair(NamedTuple):
    """totals: a row per conversation with rows; turns: the repaired ones, in the order of part, block and place."""

    totals: DataFrame
    turns: DataFrame


def repair(rows: DataFrame) -> Repair:
    """From rows (conv_id, turn, role, text, copies) without nulls in role and text."""
    cut = materialise(blocks(faulty_rows(rows)))
    chosen = materialise(choose(cut))
    kinds = f"conv_id {cut.schema['conv_id'].dataType.simpleString()}, part int, block long, place int, edit string, role string, text string"
    arrow = _arrow_schema(cut, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                lines = [(x["role"], x["text"]) for x in row["lines"]]
                out += [{"conv_id": row["conv_id"], "part": row["part"], "block": row["block"], "place": k, "edit": edit, "role": role, "text": text} for k, (edit, role, text) in enumerate(repaired_turns(lines, row["state"], row["segment"]))]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    joined = cut.select("conv_id", "part", "block", "lines").join(chosen.select("part", "block", "state", "segment"), ["part", "block"])
    return Repair(chosen.where("cost IS NOT NULL").select("conv_id", *TOTALS, "audit"), joined.mapInArrow(run, kinds))


def turn_digests(turns: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the newline-joined `role:text` of its turns.

    SHA-256 is one chain, so a conversation's turns stream in order through one task, which holds one batch of them.
    """
    kinds = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string"
    arrow = _arrow_schema(turns, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest = None, None
        for batch in batches:
            out = []
            for key, role, text in zip(*(column.to_pylist() for column in batch.columns)):
                if digest is None or key != conv:
                    if digest is not None:
                        out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()})
                    conv, digest = key, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": digest.hexdigest()}], schema=arrow)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "place")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, kinds)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies) after faults that the crc32 of `conv_id:turn` modulo 20 chooses."""
    written = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(written("text"), "[.!?]", "")).otherwise(written("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(written("role"))
    return conversations.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def repaired_conversations(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for each conv_id of `conversations`: totals, audit and digest of the repaired `rows`."""
    totals, turns = repair(rows)
    found = totals.join(turn_digests(turns).withColumnRenamed("conv_id", "conv_"), F.col("conv_id").eqNullSafe(F.col("conv_")), "left").drop("conv_").withColumnRenamed("conv_id", "conv_")
    every = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("conv_")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return every.select("conv_id", *(zero(c) for c in TOTALS[:5]), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
