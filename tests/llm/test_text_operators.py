"""Tokenising, packing, language ID, toxicity and quality against libraries, brute force and held-out rows."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cindermill.llm import bpe, langid, packing, quality, queries, toxicity
from cindermill.llm.common import id_remainder

SF = "/root/testdata/sf0.01"
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
KIND = "doc_id long, text string, lang string, source string, n_chars long, bits double, score string, length long"
ODD = [None, "", " ", "\n\n", "a", "the the the", "é日😀", "x" * 300_000, "  two  spaces  ", "tab\t\ttab", "it's they'll", "The same text", "The same text", "<|endoftext|>", " nbsp  em"]


def odd_documents(spark):
    """Nulls, empty, long and repeated texts, repeated ids, columns with clashing names."""
    rows = [(i, t, None if i % 3 == 0 else "en", None, None, 1.0, "x", 7) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[4], rows[11]], KIND)


def empty(df):
    return df.where("false")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def encoding():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_transducer_equals_library_on_random_texts():
    encode, own, rng = encoding().encode_ordinary, bpe.pattern_encoder(RANKS, PATTERN), random.Random(3)
    texts = []
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "日", "😀", "'s", "'t", "12", "!", "the", "ing", "\x1c", " ", "'", "A", "tion", " the", "\r\n"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        texts.append(text)
    for text, parts in zip(texts, own.of(texts)):
        assert bpe.ids_of(parts).tolist() == encode(text), text
        assert b" ".join([decimal for _, decimal in parts if decimal]).decode() == " ".join(map(str, encode(text)))


def test_chunk_encoder_with_a_small_cache_and_small_groups():
    encode, own = encoding().encode_ordinary, bpe.pattern_encoder(RANKS, PATTERN, cached=20)
    own.group = 50
    texts = [f"the word{i % 37} and {'x' * (i % 90)} {i} é" for i in range(300)]
    for _ in range(2):
        assert [bpe.ids_of(parts).tolist() for parts in own.of(texts)] == [encode(text) for text in texts]


def test_transducer_with_few_states_and_short_lookahead():
    small = bpe.MergeTransducer(RANKS, max_states=50, lookahead=4)
    encode = encoding().encode_ordinary
    for word in ("internationalisation", "aaaaaaaaaaaaaaaaaaaaaaa", "thethethethe", "supercalifragilistic"):
        assert small.encode(word.encode()) == encode(word)


def test_decoder_streams_characters():
    decoder = bpe.StreamDecoder({rank: token for token, rank in RANKS.items()})
    text = "naïve 日本 😀 ok"
    ids = encoding().encode_ordinary(text)
    for block in (1, 2, 5):
        assert "".join(decoder.decode(ids, block)) == text
    assert "".join(decoder.decode([RANKS[b"\xf0"], RANKS[b"a"]])) == "�a"


def test_encode_decode(spark):
    docs, encode = odd_documents(spark), encoding().encode_ordinary
    got = bpe.encode_decode(docs, RANKS, PATTERN).collect()
    assert len(got) == docs.count()
    for r in got:
        text = ODD[r["doc_id"]] or ""
        ids = encode(text)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.encode_decode(empty(docs), RANKS, PATTERN).count() == 0
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS).collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}


def test_packing(spark, documents):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs = odd_documents(spark).select("doc_id", "text").unionByName(documents.limit(300).select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = packing.pack_documents(docs, path, PATTERN).toPandas()
    for key, pieces in got.drop_duplicates(["doc_id", "piece"]).sort_values("piece").groupby("doc_id"):
        ids = library.encode(texts[key], add_special_tokens=False).ids + [0]
        assert pieces["length"].sum() == len(ids) and (pieces["length"].iloc[1:] == 2048).all() and (len(ids) > 2048 or len(pieces) == 1)
        for p in pieces.itertuples():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes())
    got = got.sort_values(["sequence_id", "offset"])
    for _, placed in got.groupby("sequence_id"):
        assert placed["offset"].tolist() == np.r_[0, placed["length"].cumsum()[:-1]].tolist() and placed["length"].sum() <= 2048
    assert len(got) == docs.count() + (got["piece"] > 0).sum()
    assert got["sequence_id"].nunique() <= math.ceil(got["length"].sum() / 2048) + 1
    assert packing.pack_documents(empty(docs), path, PATTERN).count() == 0


def test_added_tokens_are_as_by_the_library(spark, tmp_path):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    some = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> y  z ", "<|endoftext", "plain text"]
    spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in queries.op2_best_fit_packing(spark, str(tmp_path)).collect()}
    for i, text in enumerate(some):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (got[i]["length"], got[i]["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert (50256 in library.encode(some[0], add_special_tokens=False).ids)


def best_fit_decreasing(lengths, capacity):
    gaps, opened = [], 0
    for x in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= x), default=None)
        if fit is None:
            opened += 1
            gaps.append(capacity - x)
        else:
            gaps.remove(fit)
            gaps.append(fit - x)
    return opened


@pytest.mark.parametrize("kind", ["even", "short", "one length", "over a third", "full"])
def test_rounds_are_as_good_as_best_fit_decreasing(spark, kind):
    rng = np.random.default_rng(1)
    draw = {"even": lambda: rng.integers(1, 101, 400), "short": lambda: rng.integers(1, 8, 600), "one length": lambda: np.full(300, 7), "over a third": lambda: rng.integers(20, 55, 300), "full": lambda: np.full(9, 100)}
    lengths = draw[kind]().tolist()
    rows = spark.createDataFrame([(i % 5, x) for i, x in enumerate(lengths)], "doc_id int, length long")
    got = packing.pack(rows, 100).toPandas().sort_values(["sequence_id", "offset"])
    assert sorted(got["length"]) == sorted(lengths)
    for _, placed in got.groupby("sequence_id"):
        assert placed["offset"].tolist() == np.r_[0, placed["length"].cumsum()[:-1]].tolist() and placed["length"].sum() <= 100
    assert got["sequence_id"].nunique() <= best_fit_decreasing(lengths, 100) + 1


def test_a_round_gives_pieces_their_best_gaps(spark):
    rng = np.random.default_rng(4)
    gaps, pieces = rng.integers(20, 60, 300).tolist(), rng.integers(33, 65, 200).tolist()
    rows = [(packing.GAP, i, g) for i, g in enumerate(gaps)] + [(packing.PIECE, 1000 + i, x) for i, x in enumerate(pieces)]
    made, _ = packing._round(spark.createDataFrame(rows, "kind int, id long, size long"), 64, 100)
    free, want = sorted(gaps), []
    for x in sorted(pieces, reverse=True):  # one piece a gap, each in the smallest that holds it
        fit = next((g for g in free if g >= x), None)
        if fit is not None:
            free.remove(fit)
            want.append((x, fit))
    got = [(r["size"], gaps[r["sequence_id"]]) for r in made.where("kind = 2 AND sequence_id BETWEEN 0 AND 999").collect()]
    assert sorted(got) == sorted(want)


def test_claims_are_dealt_to_the_nearest_earlier_ranges():
    claims, claimed, free = packing.deal_claims([(0, 1, 3), (1, 0, 2), (2, 3, 1), (5, 4, 0)])
    assert claims == [(2, 0, 2, 1, 1), (2, 2, 3, 0, 2), (5, 0, 1, 2, 0), (5, 1, 3, 0, 1)]
    assert claimed == {0: 0, 1: 0, 2: 3, 5: 3} and free == {}


def test_language_held_out(spark, documents):
    held = id_remainder("doc_id", 4) == 2
    filters = langid.fit(documents.where(~held))
    got = langid.predict(documents.where(held), filters).toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.98 and got["score"].between(0, 1).all()
    odd = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd_documents(spark), filters).collect()}
    assert odd[0] == odd[1] == odd[2] == "und" and odd[5] == "en" and odd[11] == "en"
    assert langid.predict(empty(odd_documents(spark)), filters).count() == 0
    kept = langid.keep_identified(odd_documents(spark), filters)
    assert kept.columns == odd_documents(spark).columns and {0, 1, 2}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_language_filter_has_every_kept_ngram_and_few_others(spark):
    rows = [(i, w, l) for i, (w, l) in enumerate([("the cat and the dog " * 5, "en"), ("der hund und die katze " * 5, "de")] * 5)]
    filters = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), n_slots=1 << 12)
    total, hits = filters.hits("the cat and the dog " * 5)
    assert hits[filters.languages.index("en")] == total and filters.predict("die katze")[0] == "de"
    assert (filters.false_positive < 0.05).all()


@pytest.mark.parametrize("length", [0, 1, 3, 98, 99, 100, 101, 102, 200, 1000])
def test_language_ngrams_in_pieces_are_those_of_the_whole(length):
    text = ("the cat's und der hund  ñandú " * 50)[:length]
    whole, cut = (np.sort(np.concatenate(list(langid.ngram_hashes(text, chunk)))) for chunk in (10 ** 6, 100))
    assert (whole == cut).all() and len(whole) == len(cut)


def test_language_by_the_definition_with_more_than_64_languages(spark):
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = {f"l{k:02d}": ["".join(rng.choice(letters) for _ in range(6)) for _ in range(6)] for k in range(70)}
    rows = [(i, " ".join(rng.choice(words) for _ in range(40)), name) for i, (name, words) in enumerate(list(own.items()) * 3)]
    filters = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), n_slots=1 << 16)
    assert filters.slots.shape == (1 << 16, 2) and sorted(filters.languages) == sorted(own)
    asked = [(i, " ".join(words), name) for i, (name, words) in enumerate(own.items())]
    for r in langid.predict(spark.createDataFrame(asked, "doc_id long, text string, lang string"), filters).collect():
        text, name = asked[r["doc_id"]][1:]
        hashes = np.concatenate(list(langid.ngram_hashes(text)))
        shares = []
        for k in range(70):  # each n-gram against each language's filter, one at a time
            bits = [all(int(filters.slots[slot[j], k // 64]) >> (k % 64) & 1 for slot in langid._slots(hashes, 1 << 16)) for j in range(len(hashes))]
            shares.append(max(0.0, (sum(bits) / len(bits) - filters.false_positive[k]) / (1 - filters.false_positive[k])))
        best = max(range(70), key=lambda k: shares[k])
        second = max(s for k, s in enumerate(shares) if k != best)
        assert r["lang_pred"] == filters.languages[best] == name and r["score"] == pytest.approx(shares[best] / (shares[best] + second))


def test_language_ties_go_to_the_language_seen_more(spark):
    rows = [(i, "same words here", lang) for i, lang in enumerate(["b", "b", "b", "a", "a", "a", "c"] * 3)]
    filters = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert filters.predict("same words here")[:2] == ("a", 0.5)


def test_language_without_training(spark):
    none = langid.fit(empty(odd_documents(spark)))
    assert {r["lang_pred"] for r in langid.predict(odd_documents(spark), none).collect()} == {"und"}


def test_toxicity_held_out(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = id_remainder("doc_id", 5) == 0
    model = toxicity.fit(documents.where(~held), labels)
    scored = toxicity.decide(toxicity.score(documents.where(held), model), model).join(labels, "doc_id").toPandas()
    assert (scored["predicted"] == scored["toxic"]).mean() > 0.93 and scored["score"].between(0, 1).all()
    odd = toxicity.score(odd_documents(spark), model).toPandas()
    assert odd["score"].notna().all() and odd.loc[odd.doc_id.isin([11, 12]), "score"].nunique() == 1
    assert toxicity.score(empty(odd_documents(spark)), model).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 63, 64, 65, 66, 127, 128, 129, 1000])
def test_toxicity_blocks_give_the_whole_text(size):
    model, words = toxicity.ConvolutionalClassifier.fresh(), toxicity.WordIds()
    model.words[:] = np.random.default_rng(size).standard_normal(model.words.shape)
    ids = words.of(" ".join(f"w{i}" for i in range(size)))
    assert np.allclose(model.pooled(ids, 64), model.pooled(ids, 5000), atol=1e-5)


def test_toxicity_score_by_the_definition(spark):
    model, words = toxicity.ConvolutionalClassifier.fresh(seed=3), toxicity.WordIds()
    model.biases = [b + 0.1 for b in model.biases]
    some = ["", "one", "One, two; three!", "the same the same", "w " * 5000 + "rare " + "w " * 4500, None]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(some):
        ids = words.of(text or "")
        rows = [np.zeros(16)] * 2 + [model.words[k >> 16] + model.prefixes[k & 0xFFFF] for k in ids] + [np.zeros(16)] * 2
        top = [max([0.0] + [float(sum(rows[at + j] @ kernel[j, :, f] for j in range(w)) + bias[f]) for at in range(len(rows) - w + 1)]) for w, kernel, bias in zip(toxicity.WIDTHS, model.kernels, model.biases) for f in range(kernel.shape[2])] if len(rows) < 50 else model.pooled(ids, 10 ** 6)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(np.array(top) @ model.output + model.intercept))), abs=1e-5)


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd_documents(spark), labels)
    assert toxicity.score(odd_documents(spark), model).agg(F.max("score")).first()[0] < 1e-6


def naive_kneser_ney(trusted, order):
    """Probabilities by the definition, with dictionaries."""
    counts = [collections.Counter() for _ in range(order + 1)]
    for text in trusted:
        data = b"\n" * (order - 1) + text.encode()
        for i in range(order - 1, len(data)):
            counts[order][data[i - order + 1:i + 1]] += 1
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    totals, discounts = [None], [None]
    for k in range(1, order + 1):
        n = [sum(c == i for c in counts[k].values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        discounts.append([min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i) for i in (1, 2, 3)] if all(n) else [0.5, 1.0, 1.5])
        contexts = collections.defaultdict(list)
        for g, c in counts[k].items():
            contexts[g[:-1]].append(c)
        totals.append(contexts)

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / 256
        context, d = totals[k].get(gram[:-1]), discounts[k]
        if context is None:
            return p(gram[1:])
        off = lambda c: d[min(c, 3) - 1]
        c = counts[k][gram]
        return max(c - off(c), 0) / sum(context) + sum(min(off(x), x) for x in context) / sum(context) * p(gram[1:]) if c else sum(min(off(x), x) for x in context) / sum(context) * p(gram[1:])

    return p


def test_perplexity_equals_definition(spark, documents):
    some = [r["text"][:400] for r in documents.orderBy("doc_id").limit(12).collect()]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate([*some, "zzz new é", "", None])], "doc_id long, text string, lang string")
    p = naive_kneser_ney(some[:8], quality.ORDER)
    for limit in (10 ** 6, 0):  # all probabilities to every task, and requests of blocks
        got = {r["doc_id"]: r["bits"] for r in quality.perplexity(docs, docs.where("doc_id < 8"), limit).collect()}
        for i, text in enumerate([*some, "zzz new é"]):
            data = b"\n" * (quality.ORDER - 1) + text.encode()
            bits = -sum(math.log2(p(data[j:j + quality.ORDER])) for j in range(len(data) - quality.ORDER + 1)) / len(text.encode())
            assert got[i] == pytest.approx(bits, abs=1e-4)
        assert got[13] is None and got[14] is None


def test_long_texts_keep_their_context(monkeypatch):
    text = bytes(range(97, 123)) * 50
    whole = np.sort(quality.gram_codes(text))
    monkeypatch.setattr(quality, "SLICE", 100)
    assert (np.sort(np.concatenate(list(quality._code_slices(iter([text]))))) == whole).all()


def test_quality_keeps_good_and_drops_bad(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.judge(documents, labels.where("quality = 1")).join(labels, "doc_id").toPandas()
    assert got.loc[got.quality == 1, "keep"].mean() > 0.98 and got.loc[got.quality == 0, "keep"].mean() < 0.2
    odd = odd_documents(spark)
    assert quality.judge(odd, empty(labels)).where("keep").count() == odd.count()
    assert quality.judge(empty(odd), labels).count() == 0
    assert quality.keep_documents(odd, labels).columns == odd.columns


def test_scarce_language_keeps_unseen_clean_texts(spark):
    tables = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{tables}/documents.parquet").join(spark.read.parquet(f"{tables}/labels.parquet").where("quality = 1"), "doc_id").select("doc_id", "lang", "text").where("lang in ('en', 'es')").orderBy("doc_id").toPandas()
    scarce, others = rows[rows.lang == "es"].head(80), rows[rows.lang == "en"].head(150)
    docs = spark.createDataFrame([*scarce.itertuples(index=False, name=None), *others.itertuples(index=False, name=None)], "doc_id long, lang string, text string")
    trusted = [(int(i),) for i in [*scarce.doc_id[:10], *others.doc_id[:100]]]
    kept = {r["doc_id"] for r in quality.judge(docs, spark.createDataFrame(trusted, "doc_id long")).where("keep").collect()}
    assert len(kept & set(scarce.doc_id[10:])) > 0.95 * 70 and len(kept & set(others.doc_id[100:])) > 0.95 * 50
