"""Ordered packing, conversation repair and spelling variants against brute force and SQL."""

import collections
import functools
import hashlib
import itertools
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cindermill.llm import conversations, ordered_packing, queries, variants

SF = "/root/testdata/sf0.01"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


# ordered packing

def window_cost(length, capacity):
    return 0 if length & (length - 1) == 0 else capacity - length


def cheapest(places, penalties, capacity):
    """The least cost by trying every earlier place."""
    best = {0: 0}
    for place, penalty in zip(places, penalties):
        best[place] = penalty + min(best[i] + window_cost(place - i, capacity) for i in best if place - i <= capacity)
    return best[places[-1]]


@pytest.mark.parametrize("seed", range(40))
def test_cuts_are_the_cheapest(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([1, 7, 16, 50]))
    places = np.unique(rng.integers(1, 30 * capacity, 60))
    penalties = rng.integers(0, 9, len(places))
    places, penalties = ordered_packing.cut_places(places, penalties, capacity, within=5)
    cuts = ordered_packing.cheapest_cuts(places, penalties, capacity)
    places, penalties = places.tolist(), penalties.tolist()
    of = dict(zip(places, penalties))
    windows = [b - a for a, b in zip([0, *cuts], cuts)]
    assert cuts[-1] == places[-1] and all(0 < w <= capacity for w in windows)
    assert sum(window_cost(w, capacity) + of[c] for w, c in zip(windows, cuts)) == cheapest(places, penalties, capacity)


def test_sentences_end_before_white_space():
    from cindermill.llm.packing import tokenizer_ranks

    ranks, library = tokenizer_ranks(PATH), Tokenizer.from_file(PATH)
    ids = np.array(library.encode('One 3.14 two. "Three!" Four\n\nFive? six', add_special_tokens=False).ids, "<u4")
    ends = np.flatnonzero(ordered_packing.sentence_ends(ids, ordered_packing.sentence_marks(ranks, 50_300))) + 1
    cut = [library.decode(ids[a:b].tolist()) for a, b in zip([0, *ends], [*ends, len(ids)])]
    assert cut == ["One 3.14 two.", ' "Three!"', " Four\n\n", "Five?", " six"]


def pieces_hold(got, texts, capacity, end_id=1):
    library = Tokenizer.from_file(PATH)
    for key, pieces in got.groupby("doc_id"):
        ids = [*library.encode(texts[key] or "", add_special_tokens=False).ids, end_id]
        for _, copy in pieces.groupby(pieces.sort_values(["sequence_id", "offset"]).start.eq(0).cumsum()):
            copy = copy.sort_values("start")
            assert copy["length"].sum() == len(ids) and (copy.doc_tokens == len(ids)).all()
            assert copy.start.tolist() == np.r_[0, copy["length"].cumsum()[:-1]].tolist()
            assert all(zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for p in copy.itertuples())
    for _, placed in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert placed.offset.tolist() == np.r_[0, placed["length"].cumsum()[:-1]].tolist() and placed["length"].sum() <= capacity


@pytest.mark.parametrize("capacity, run_tokens", [(2048, 1 << 20), (64, 500), (1, 3)])
def test_documents_packed_in_order(spark, capacity, run_tokens):
    texts = [None, "", " ", "a", "One. Two. Three! " * 40, "x" * 9000, "same text", "no stop " * 300, "<|endoftext|> literal"]
    rows = [(i, t, 1.0, "x", 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[6], rows[6]], "doc_id int, text string, length double, offset string, sequence_id int")
    got = ordered_packing.pack_in_order(docs, PATH, PATTERN, capacity, run_tokens=run_tokens).toPandas()
    pieces_hold(got, texts, capacity)
    assert (got.doc_id == 6).sum() >= 3
    first = got[got.start == 0].sort_values(["sequence_id", "offset"]).doc_id.tolist()
    assert sorted(first) == sorted([*range(9), 6, 6])
    assert ordered_packing.pack_in_order(docs.where("false"), PATH, PATTERN).count() == 0


def test_little_padding_on_the_table(spark):
    got = queries.op11_ordered_packing(spark, SF).toPandas()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(got.doc_id) == set(texts)
    pieces_hold(got, texts, 2048)
    lengths = got.groupby("sequence_id")["length"].sum()
    assert sum(window_cost(int(n), 2048) for n in lengths) < 0.01 * lengths.sum()


# conversations

def cheapest_repair(rows):
    """(cost, audit, lines) by recursion over rows (initial, required, truncated, role, text)."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))

    @functools.lru_cache(None)
    def best(i, state, inserted):
        found = []
        other = 3 if state == 2 else 2
        name = "assistant" if other == 3 else "user"

        def add(after, cost, letter, line=None):
            if after is not None:
                found.append((after[0] + cost, letter + after[1], ((line,) if line is not None else ()) + after[2]))

        if i == len(rows) and state in (0, 3):
            found.append((0, "", ()))
        if inserted < 3:
            add(best(i, other, inserted + 1), 5, "I", f"{name}:")
        if i < len(rows):
            initial, required, truncated, role, text = rows[i]
            add(best(i + 1, state, 0), 2, "D")
            if not required:
                penalty = 5 if truncated else 0
                to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((initial, state))
                if to is not None:
                    add(best(i + 1, to, 0), penalty, "K", f"{role}:{text}")
                add(best(i + 1, other, 0), penalty + 1, "R", f"{name}:{text}")
        return min(found, default=None)

    return best(0, 0, 0)


def expected(conv_id, rows):
    out = []
    for turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else " " if role is None else role
        out += [(turn, role, text)] * (kind != 0) * (2 if kind == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, facts = set(), []
    for _, role, text in out:
        core = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
        seen.add((role, text))
        facts.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated", role, text, fault))
    turns = [t for t, *_ in out if t is not None]
    cost, audit, lines = cheapest_repair(tuple(f[:5] for f in facts))
    faults = collections.Counter(f[5] for f in facts)
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(facts))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_conversations_against_brute_force(spark):
    rng = random.Random(7)
    roles, texts = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "student"], ["Yes.", "No?", "Maybe", " ", "", None, "Well!\n", "é.", "x" * 5000]
    rows = [(c, rng.choice([t, t, t, t // 2, None]), rng.choice(roles), rng.choice(texts)) for c in range(60) for t in range(rng.randint(1, 9))]
    rows += [(1000, t, ("user", "assistant", "tool")[rng.randrange(3)], rng.choice(texts)) for t in range(300)]  # many blocks
    rows += [(2000, t, "assistant" if t % 2 else "user", f"turn {t}.") for t in range(100)]
    rows += [(None, t, "user", "Hi.") for t in range(5)] + [rows[3]] * 3
    table = spark.createDataFrame([(*r, 1.5, "x") for r in rows], "conv_id long, turn long, role string, text string, part double, copies string")
    by = collections.defaultdict(list)
    for conv_id, *rest in rows:
        by[conv_id].append(rest)
    got = conversations.repaired_conversations(table, conversations.damage(table)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == {c: expected(c, some) for c, some in by.items()} and len(got) == len(by)
    assert conversations.repaired_conversations(table.where("false"), conversations.damage(table.where("false"))).count() == 0


@pytest.mark.parametrize("seed", range(25))
def test_blocks_of_any_size_give_the_whole_minimum(seed):
    rng = random.Random(seed)
    rows = [conversations.Row(rng.choice("suaaut"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(1, 14))]
    cost, audit, _ = cheapest_repair(tuple((*r, "", "") for r in rows))
    for size in (1, 2, 5, 20):
        chain = conversations.Chain()
        for at in range(0, len(rows), size):
            states = range(4) if at else (0,)
            chain.add([(q, end, c, a) for q in states for end, (c, a) in conversations.block_weights(rows[at:at + size], q).items()])
        found, segments = chain.result()
        assert (found, "".join(s for _, s in segments)) == (cost, audit)


def test_repaired_turns_as_rows(spark):
    rows = spark.createDataFrame([(1, 0, "assistant", "First.", 1), (1, 1, "user", "Second.", 1), (1, 2, "assistant", "Third.", 1), (1, 3, "assistant", "Third.", 1)], "conv_id int, turn int, role string, text string, copies long")
    found = conversations.repair(rows)
    assert [tuple(r) for r in found.turns.orderBy("part", "block", "place").select("edit", "role", "text").collect()] == [("K", "user", "Second."), ("K", "assistant", "Third.")]
    assert found.totals.first()["audit"] == "DKKD"


# spelling variants

def variants_by_definition(docs, least_length, least_count, modulus, ratio=5):
    counts = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % modulus else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least_length and c >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(a) + 1 == len(b) and any(b[:k] + b[k + 1:] == a for k in range(len(b)))

    close = {w: [x for x in n if near(w, x)] for w in n}
    best = {w: min(close[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: b if b is not None and n[b] >= ratio * n[w] else None for w, b in best.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(close[w]), n[form[w]] if form[w] else None) for w in n}


@pytest.mark.parametrize("letters, length", [("ab", 5), ("abcé", 6), ("aAbÀàÿ", 7)])
def test_variants_against_brute_force(spark, letters, length):
    rng = random.Random(length)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, length + 2))) for _ in range(120)]
    docs = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(120)], k=80))) for i in range(40)]
    docs += [(None, "aaaa aaaab-aaaa"), (100, None), (101, ""), (102, "ß×÷ª 12 a1b"), docs[0], docs[0], (103, "abcdefghij " * 3000)]
    table = spark.createDataFrame([(*d, 1, "x", 2.0) for d in docs], "doc_id long, text string, n int, word string, place double")
    got = variants.spelling_variants(table, least_length=4, least_count=2, modulus=7).collect()
    assert {r["word"]: tuple(r[1:]) for r in got} == variants_by_definition(docs, 4, 2, 7) and len(got) == len({r["word"] for r in got})
    assert variants.spelling_variants(table.where("false")).count() == 0


def test_a_chain_of_forms_has_its_last_as_root(spark):
    text = " ".join(["letter"] * 1 + ["lettere"] * 5 + ["lettered"] * 25 + ["letteredx"] * 125 + ["unrelated"] * 9)
    got = {r["word"]: r for r in variants.spelling_variants(spark.createDataFrame([(1, text)], "doc_id int, text string"), least_count=1).collect()}
    assert {got[w]["root"] for w in ("letter", "lettere", "lettered", "letteredx")} == {"letteredx"} and got["letter"]["form"] == "lettere"
    assert got["unrelated"]["root"] == "unrelated" and got["unrelated"]["form"] is None


# SQL

@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_spelling_variants"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLES[name])
    assert got.columns == [c[0] for c in want.description]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)
