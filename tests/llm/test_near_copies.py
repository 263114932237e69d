"""The near-duplicate stage on boilerplate and clashing columns; labels and ids that repeat."""

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from cindermill.llm import jaccard, quality, simhash, toxicity


def boilerplate(n, seed=1):
    """n texts that share 300 of 430 words, with a near copy of every fourth."""
    rng = np.random.default_rng(seed)
    shared = " ".join(f"licence{k}" for k in range(300))
    rows = []
    for i in range(n):
        own = [f"w{x}" for x in rng.integers(0, 10 ** 9, 130)]
        rows.append((2 * i, f"{' '.join(own[:60])} {shared} {' '.join(own[60:])}"))
        if i % 4 == 0:
            own[3] = own[77] = "changed"
            rows.append((2 * i + 1, f"{' '.join(own[:60])} {shared} {' '.join(own[60:])}"))
    return rows


def kept_and_verified(spark, monkeypatch, rows):
    counts = []
    real = jaccard.Linker.verify

    def counted(self, pairs):
        real(self, pairs)
        counts.append(self.verified)

    monkeypatch.setattr(jaccard.Linker, "verify", counted)
    got = {r["doc_id"] for r in jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    monkeypatch.setattr(jaccard.Linker, "verify", real)
    return got, counts[-1]


def test_a_shared_passage_makes_no_pairs_of_all(spark, monkeypatch):
    verified = []
    for n in (100, 400):
        got, pairs = kept_and_verified(spark, monkeypatch, boilerplate(n))
        assert got == {2 * i for i in range(n)}
        verified.append(pairs)
    assert verified[1] < 6 * verified[0] and verified[1] < 20 * 400


def test_every_similar_pair_of_the_fine_postings_meets(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 60, 40)
    sets = {i: sorted({int(x) for x in np.where(rng.random(40) < 0.15, rng.integers(0, 400, 40), base)}) for i in range(80)}
    frame = spark.createDataFrame(list(sets.items()), "node long, shingles array<long>")
    by = {}
    for r in jaccard.prefix_postings(frame, 0.8).collect():
        by.setdefault(r["band"], set()).add(r["node"])
    met = {(a, b) for nodes in by.values() for a in nodes for b in nodes if a < b}
    similar = {(a, b) for a in sets for b in sets if a < b and len({*sets[a]} & {*sets[b]}) >= 0.8 * len({*sets[a]} | {*sets[b]})}
    assert similar and similar <= met


def test_clashing_columns_stay(spark):
    clashing = ("id_", "mark_", "row_mark_", "kept_", "ROW_", "text_", "node", "root")
    docs = spark.createDataFrame([(k, text, "en", *[10 * k + c for c in range(len(clashing))]) for k, text in ((1, "a b c"), (2, "a b c"), (3, "something else"))], "doc_id long, text string, lang string, " + ", ".join(f"{c} int" for c in clashing))
    want = sorted(tuple(r) for r in docs.where("doc_id != 2").collect())
    for keep in (simhash.keep_one, jaccard.keep_one):
        got = keep(docs)
        assert got.columns == docs.columns and sorted(tuple(r) for r in got.collect()) == want
    kept = quality.keep_documents(docs, spark.createDataFrame([(1,)], "doc_id long"))
    assert kept.columns == docs.columns and set(map(tuple, kept.collect())) <= set(map(tuple, docs.collect()))


def test_labels_and_ids_that_repeat_stay_bounded(spark):
    docs = spark.createDataFrame([(i % 40, f"text {i} with words {'bad' if i % 40 < 20 else 'good'}", "en") for i in range(4000)], "doc_id long, text string, lang string")
    labels = spark.range(200_000).select(F.col("id").alias("doc_id"), (F.col("id") < 20).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.where("text like 'text 1 %' or text like 'text 30 %'"), model).collect()
    assert len(scored) == 2 and all(0 <= r["score"] <= 1 for r in scored)


def test_toxicity_learns_from_rows_outside_the_start(spark):
    # every label's words are in one document of 25 each; a start of about two documents of a label knows few of them
    rows = [(i, f"plain words {'vile' if i % 2 else 'kind'}{i % 60} and more of them", i % 2) for i in range(1500)]
    docs = spark.createDataFrame([(i, text, "en") for i, text, _ in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, toxic) for i, _, toxic in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, per_label=2)
    fresh = spark.createDataFrame([(k, f"plain words {'vile' if k % 2 else 'kind'}{k} and more of them") for k in range(60)], "doc_id long, text string")
    assert sum((r["score"] >= 0.5) == r["doc_id"] % 2 for r in toxicity.score(fresh, model).collect()) >= 57
    start = toxicity.fit(docs.where("doc_id < 750"), labels, per_label=2)
    assert (start.words != model.words).any()


def test_toxicity_steps_by_blocks_are_the_whole_text_s():
    model, words = toxicity.ConvolutionalClassifier.fresh(), toxicity.WordIds()
    ids = words.of(" ".join(f"w{i}" for i in range(300)))
    whole, parts = model._tops(ids, 1000), model._tops(ids, 64)
    assert all((a == b).all() for a, b in zip(whole[0], parts[0])) and np.allclose(np.concatenate(whole[1]), np.concatenate(parts[1]), atol=1e-5)
    _, values = model._activations(ids)
    assert all((v.argmax(axis=0) == a).all() for v, a in zip(values, whole[0]))


def edited_copies(n, common=200, seed=4):
    """A text of 150 words and n copies of it, each with 1 to 9 words replaced by some of `common` ones, so that similarities are 0.4 to 1."""
    rng = np.random.default_rng(seed)
    base, rows = [f"b{k}" for k in range(150)], [(0, " ".join(f"b{k}" for k in range(150)))]
    for i in range(n):
        words = list(base)
        for at in rng.choice(150, int(rng.integers(1, 10)), replace=False):
            words[at] = f"common{rng.integers(0, common)}"
        rows.append((i + 1, " ".join(words)))
    return rows


def kept_by_all_pairs(rows):
    sets = {k: set(jaccard.shingle_set(text).tolist()) for k, text in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {find(k) for k in sets}


def test_a_large_group_of_near_copies_makes_no_pairs_of_all(spark, monkeypatch):
    verified = []
    for n in (100, 400):
        rows = edited_copies(n)
        got, pairs = kept_and_verified(spark, monkeypatch, rows)
        assert got == kept_by_all_pairs(rows) and 1 < len(got) < n
        verified.append(pairs)
    assert verified[1] < 6 * verified[0] and verified[1] < 5 * 400
    # copies that have most of their changes in common, too
    rows = edited_copies(400, common=8)
    got, pairs = kept_and_verified(spark, monkeypatch, rows)
    assert got == kept_by_all_pairs(rows) and pairs < 5 * 400


def test_the_stage_takes_its_groups_from_the_byte_position_index(spark, monkeypatch):
    met = []
    real = simhash.meetings

    def counted(index, *args):
        met.append(index.select("fp").distinct().count())
        return real(index, *args)

    monkeypatch.setattr(simhash, "meetings", counted)
    rows = edited_copies(30)
    docs = spark.createDataFrame([*rows, *[(1000 + k, text) for k, text in rows]], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.distinct(spark, docs, "").collect()} == kept_by_all_pairs(rows)
    assert met == [len({jaccard.shingle_set(text).tobytes() for _, text in rows})]


def test_open_nodes_hold_every_similar_pair():
    rng = np.random.default_rng(8)
    for _ in range(2000):
        n, kept = int(rng.integers(1, 120)), rng.random()
        shared = rng.integers(0, 2**63, max(1, int(n * (0.8 + 0.2 * kept))), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([shared, rng.integers(0, 2**63, int(rng.integers(0, 1 + n // 4)), dtype=np.uint64)])) for _ in "ab")
        if len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b)):
            (one, least), (other, too) = jaccard.head(a, 0.8), jaccard.head(b, 0.8)
            assert len(np.intersect1d(one, other)) >= max(least, too)


def test_the_index_is_made_by_all_tasks_and_counted_once(spark, monkeypatch):
    fps = spark.range(3000).select(F.xxhash64(F.col("id") % 2500).alias("fp"))
    index = simhash.postings(fps, 4)
    by_task = [r["count"] for r in index.groupBy(F.spark_partition_id()).count().collect()]
    assert len(by_task) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(by_task) == 70 * 2500
    assert max(by_task) < 2 * sum(by_task) / len(by_task)
    written = []
    monkeypatch.setattr(simhash, "materialise", lambda df, real=simhash.materialise: written.append(real(df)) or written[-1])
    met, _ = simhash.meetings(index, 15)
    assert len(written) == 2 and {*written[0].columns} == {"kind", "bytes", "n", "low", "high"}
    # what the pairs come from is read from the two tables, not made anew
    assert "Generate" not in met._jdf.queryExecution().optimizedPlan().toString()


def test_the_index_has_fourteen_postings_a_fingerprint_and_loses_no_pair(spark, monkeypatch):
    indexed, tallies = [], []
    real = simhash.meetings

    def counted(index, least, *args):
        indexed.append(index.count())
        tallies.append(least)
        return real(index, least, *args)

    monkeypatch.setattr(simhash, "meetings", counted)
    base = 0x0123456789ABCDEF
    # a bit or two in each byte or pair of bytes, and the last bit of all
    flips = {1 << 8 * p + 3 for p in range(8)} | {1 << 8 * p + 3 | 1 << 8 * q + 5 for p in range(8) for q in range(8)} | {1 << 63}
    values = sorted(int(np.uint64(base ^ f).astype(np.int64)) for f in flips | {0})
    near = {(a, b) for k, a in enumerate(values) for b in values[k + 1:] if bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    found = [(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()]
    assert set(found) == near and len(found) == len(near)
    # before, 70 postings a fingerprint were shuffled and counted, and shuffled again to be paired
    assert indexed == [14 * len(values)] and tallies == [3]


def test_the_tally_is_the_least_number_of_sets_that_a_pair_shares():
    for distance in range(1, 7):
        sets, least = simhash.position_sets(distance)
        assert least > 0
        for n in range(distance + 1):
            for differing in combinations(range(8), n):
                assert sum(not set(chosen) & set(differing) for chosen in sets) >= least
