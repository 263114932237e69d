"""Text quality by the perplexity of an interpolated modified Kneser-Ney n-gram model.

N-grams are of UTF-8 bytes, so an n-gram is one exact integer and the model needs no vocabulary. It
is trained on trusted text. Counts, continuation counts, contexts and discounts are tables sharded by
n-gram, and the probability of every n-gram that occurs in the corpus comes from joins of those, one
order after the other: p_k(g) = max(c - D(c), 0) / c(context) + gamma(context) * p_(k-1)(suffix). A
document's perplexity then adds up the logarithms of its own n-grams.

How documents get at the probabilities: documents are put in blocks of bounded size; each block asks for its
distinct n-grams, the requests are joined with the probabilities, and the answers return to the
block. Where all probabilities together stay below `broadcast_grams` (counted first), every task
gets them at once instead; both ways give the same numbers.

Documents are kept if their perplexity is no higher than their language's threshold, a quantile over
the trusted documents of that language times a margin. Trusted documents are scored for it by models
that have not seen them: texts are dealt to folds by their hash and each fold is scored by a model of
the others, so equal texts never judge each other. A language with fewer trusted documents than
`enough` has at least the quantile over all languages, and an upper bound (mean and three standard deviations) in
place of a quantile that its documents cannot show; one without trusted documents has the quantile over all.

Defined cases: a null or empty text has perplexity null and is not kept; null languages count as one
language of their own; repeated rows get equal answers, in keep_documents by doc_id: a document is
kept if any row of its id is. Without any trusted text nothing can be judged and all is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import materialise, unused

ORDER = 5
SLICE = 1 << 21
FRAME = b"\n" * (ORDER - 1)
TAG = 56


def gram_codes(text: bytes) -> np.ndarray:
    """The n-grams that end at each byte of a text, as integers; line ends stand before the text."""
    data = np.frombuffer(FRAME + text, dtype=np.uint8).astype(np.int64)
    n = len(text)
    codes = np.zeros(n, dtype=np.int64)
    for k in range(ORDER):
        codes <<= 8
        codes |= data[k:k + n]
    return codes


def _code_slices(texts: Iterator[bytes]) -> Iterator[np.ndarray]:
    """The n-grams of many texts in arrays of about SLICE; a longer text is cut with its context kept."""
    held, size = [], 0
    for text in texts:
        for at in range(0, len(text), SLICE):
            piece = text[at:at + SLICE]
            if at:
                before = text[at - ORDER + 1:at]
                held.append(gram_codes(before + piece)[ORDER - 1:])
            else:
                held.append(gram_codes(piece))
            size += len(piece)
            if size >= SLICE:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


def _batch_texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    for value in batch.column(column):
        yield value.as_py() or b""


def gram_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """gram, n: how often each n-gram occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes in _code_slices(t for batch in batches for t in _batch_texts(batch, 0)):
            grams, n = np.unique(codes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return df.select(F.col(text).cast("binary")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def tagged(gram: str, model) -> Column:
    """N-grams of several models side by side: the model's number stands above the n-gram's bytes."""
    return F.col(gram).bitwiseOR(F.shiftleft(model, TAG))


def fold_counts(df: DataFrame) -> DataFrame:
    """fold, gram, n: how often each n-gram occurs in the texts of each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dealt = batch.column(0).to_numpy()
            for fold in np.unique(dealt):
                for codes in _code_slices(_batch_texts(batch.filter(pa.array(dealt == fold)), 1)):
                    grams, n = np.unique(codes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), fold)), pa.array(grams), pa.array(n.astype(np.int64))], names=["fold", "gram", "n"])

    return df.select("fold", F.col("text").cast("binary")).mapInArrow(run, "fold long, gram long, n long").groupBy("fold", "gram").agg(F.sum("n").alias("n"))


def _suffix(gram: str, order: int):
    return F.col(gram).bitwiseAND(F.lit((1 << 8 * order) - 1 | 0x7F << TAG))


class KneserNeyTables:
    """Count tables of each order with their contexts; n-grams may be tagged by model."""

    def __init__(self, counts: DataFrame):
        level = counts.select(F.lit(ORDER).alias("k"), "gram", F.col("n").alias("c"))
        levels = level
        for k in range(ORDER - 1, 0, -1):
            level = level.groupBy(_suffix("gram", k).alias("gram")).agg(F.count("*").alias("c")).select(F.lit(k).alias("k"), "gram", "c")
            levels = levels.unionByName(level)
        self.levels = materialise(levels)
        of = {(r["k"], r["model"]): r for r in self.levels.groupBy("k", F.shiftright("gram", TAG).alias("model")).agg(*[F.count(F.when(F.col("c") == i, 1)).alias(f"n{i}") for i in (1, 2, 3, 4)]).collect()}
        self.discounts = {at: self._discounts(*[of[at][f"n{i}"] for i in (1, 2, 3, 4)]) for at in of}
        self.models = sorted({model for _, model in of})

    @staticmethod
    def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
        """Modified Kneser-Ney discounts for counts of 1, 2 and more; plain ones where a count of counts is missing."""
        if not (n1 and n2 and n3 and n4):
            return 0.5, 1.0, 1.5
        y = n1 / (n1 + 2 * n2)
        return tuple(float(np.clip(i - (i + 1) * y * b / a, 0.05, i)) for i, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1))

    def order(self, k: int) -> tuple[DataFrame, DataFrame]:
        """gram, own (discounted relative frequency); context, gamma (mass left to the lower order)."""
        c = F.col("c")
        by_model = F.array(*[F.array(*map(F.lit, self.discounts.get((k, model), (0.0, 0.0, 0.0)))) for model in range(max(self.models) + 1)])
        discount = F.get(F.get(by_model, F.shiftright("gram", TAG).cast("int")), (F.least(c, F.lit(3)) - 1).cast("int"))
        rows = self.levels.where(F.col("k") == k).select("gram", "c", F.shiftright("gram", 8).alias("context"), discount.alias("d"))
        contexts = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum(F.least("d", F.col("c").cast("double"))).alias("freed")).select("context", "total", (F.col("freed") / F.col("total")).alias("gamma"))
        own = rows.join(contexts, "context").select("gram", (F.greatest(c - F.col("d"), F.lit(0.0)) / F.col("total")).alias("own"))
        return own, contexts.select("context", "gamma")

    def log_probabilities(self, grams: DataFrame) -> DataFrame:
        """gram, logp (base 2) for every n-gram asked for, seen in training or not."""
        below = None
        for k in range(1, ORDER + 1):
            need = grams.select("gram") if k == ORDER else grams.select(_suffix("gram", k).alias("gram")).distinct()
            own, contexts = self.order(k)
            rows = need.join(own, "gram", "left").withColumn("context", F.shiftright("gram", 8)).join(contexts, "context", "left")
            if below is None:
                rows = rows.withColumn("p", F.lit(1 / 256))
            else:
                rows = rows.withColumn("suffix", _suffix("gram", k - 1)).join(below, "suffix")
            below = rows.select(F.col("gram").alias("suffix"), (F.coalesce("own", F.lit(0.0)) + F.coalesce("gamma", F.lit(1.0)) * F.col("p")).alias("p"))
            if k < ORDER:  # written order by order, which keeps each plan small
                below = materialise(below)
        return below.select(F.col("suffix").alias("gram"), F.log2("p").cast("float").alias("logp"))


def _mean_bits(text: bytes, model: int, grams: np.ndarray, logp: np.ndarray) -> float | None:
    if not text:
        return None
    total = 0.0
    for codes in _code_slices(iter((text,))):
        codes.sort()  # neighbouring look-ups then touch neighbouring memory
        codes |= model << TAG
        total -= float(logp[np.searchsorted(grams, codes)].sum(dtype=np.float64))
    return total / len(text)


SCORES = "doc_id long, lang string, model long, bits double"


def _bits_rows(batch_columns, grams: np.ndarray, logp: np.ndarray) -> pa.RecordBatch:
    keys, langs, models, texts = batch_columns
    bits = [_mean_bits(t.as_py() or b"", m.as_py(), grams, logp) for m, t in zip(models, texts)]
    return pa.RecordBatch.from_arrays([keys, langs, models, pa.array(bits, pa.float64())], names=["doc_id", "lang", "model", "bits"])


def _plain(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("model").cast("long"), F.col("text").cast("binary"), *more)


def score_by_broadcast(docs: DataFrame, probabilities: DataFrame) -> DataFrame:
    """doc_id, lang, model, bits per byte, with all probabilities sent to every task."""
    table = probabilities.orderBy("gram").toArrow()
    shared = docs.sparkSession.sparkContext.broadcast((table.column("gram").to_numpy(), table.column("logp").to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _bits_rows(batch.columns, *shared.value)

    return _plain(docs).mapInArrow(run, SCORES)


def score_by_blocks(docs: DataFrame, probabilities: DataFrame, block_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, lang, model, bits per byte, with requests of blocks of documents joined to the probabilities."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    blocked = _plain(docs, F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"))

    def ask(group: pa.Table) -> pa.Table:
        found = np.empty(0, dtype=np.int64)
        models = group.column("model").to_numpy()
        for model in np.unique(models):
            for codes in _code_slices(t.as_py() or b"" for t in group.filter(pa.array(models == model)).column("text")):
                found = np.union1d(found, codes | model << TAG)
        block = group.column("block")[0].as_py()
        return pa.table({"block": pa.array(np.full(len(found), block, dtype=np.int64)), "gram": pa.array(found)})

    requests = blocked.groupBy("block").applyInArrow(ask, "block long, gram long")
    answers = requests.join(probabilities, "gram").select("block", "gram", "logp")

    def answer(key, group: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known.column("gram").to_numpy())
        grams, logp = known.column("gram").to_numpy()[order], known.column("logp").to_numpy()[order]
        if not group.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "lang": pa.array([], pa.string()), "model": pa.array([], pa.int64()), "bits": pa.array([], pa.float64())})
        group = group.combine_chunks()
        return pa.Table.from_batches([_bits_rows((b.column("doc_id"), b.column("lang"), b.column("model"), b.column("text")), grams, logp) for b in group.to_batches()])

    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(answer, SCORES)


def perplexity(docs: DataFrame, trusted: DataFrame, broadcast_grams: int = 4_000_000, folds: int = 0) -> DataFrame:
    """doc_id, lang, model, bits (base-2 logarithm of the perplexity per byte) of every document.

    Model 0 has learned from all trusted texts. With folds, trusted documents come once more, each with
    a model from 1 on that has learned from the other folds only; folds without others give no rows.
    """
    dealt = trusted.select("doc_id", "lang", "text", F.pmod(F.xxhash64("text"), F.lit(max(1, folds))).alias("fold"))
    dealt = materialise(dealt) if folds else dealt
    counts = materialise(fold_counts(dealt))
    teaches = F.array(F.lit(0), *[F.when(F.col("fold") != k, k + 1) for k in range(folds)])
    training = counts.select("gram", "n", F.explode(F.array_compact(teaches).cast("array<bigint>")).alias("model"))
    tables = KneserNeyTables(materialise(training.groupBy(tagged("gram", F.col("model")).alias("gram")).agg(F.sum("n").alias("n"))))
    if not tables.discounts:
        return docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.lit(0).cast("long").alias("model"), F.lit(None).cast("double").alias("bits"))
    asked, rows = gram_counts(docs).select("gram"), docs.select("doc_id", "lang", "text", F.lit(0).cast("long").alias("model"))
    if folds:
        judged = F.col("fold") + 1
        held_out = judged.isin(tables.models)
        asked = asked.unionByName(counts.where(held_out).select(tagged("gram", judged).alias("gram")))
        rows = rows.unionByName(dealt.where(held_out).select("doc_id", "lang", "text", judged.cast("long").alias("model")))
    probabilities = materialise(tables.log_probabilities(materialise(asked)))
    small = probabilities.count() <= broadcast_grams
    return score_by_broadcast(rows, probabilities) if small else score_by_blocks(rows, probabilities)


def language_limits(known: DataFrame, quantile: float, enough: int) -> tuple[dict[str | None, float], float | None]:
    """Limits in bits by language and over all of them, without margin."""
    measures = (F.percentile_approx("bits", quantile, 10_000).alias("q"), F.count("*").alias("n"), F.avg("bits").alias("mean"), F.stddev_samp("bits").alias("sd"))
    overall = known.agg(*measures).first()["q"]
    limits = {}
    for r in known.groupBy("lang").agg(*measures).collect():
        limits[r["lang"]] = r["q"] if r["n"] >= enough else max(overall, r["q"], r["mean"] + 3 * (r["sd"] or 0.0))
    return limits, overall


def judge(docs: DataFrame, trusted_ids: DataFrame, quantile: float = 0.995, margin: float = 1.1, broadcast_grams: int = 4_000_000, broadcast_ids: int = 8_000_000, folds: int = 5, enough: int = 100) -> DataFrame:
    """doc_id, lang, perplexity, threshold and keep for every document; trusted_ids has the doc_id of trusted ones.

    Up to broadcast_ids of them, counted first, go to every task; more of them are joined by a shuffle of the texts.
    """
    trusted_ids = materialise(trusted_ids.select("doc_id").distinct())
    few = trusted_ids.count() <= broadcast_ids
    trusted = docs.join(F.broadcast(trusted_ids) if few else trusted_ids.hint("merge"), "doc_id", "left_semi")
    answers = materialise(perplexity(docs, trusted, broadcast_grams, folds))
    scores = answers.where("model = 0")
    limits, overall = language_limits(answers.where("model > 0 AND bits IS NOT NULL"), quantile, enough)
    if overall is None:  # all trusted texts are in one fold: only their own scores are there
        limits, overall = language_limits(scores.join(trusted_ids, "doc_id", "left_semi").where("bits IS NOT NULL"), quantile, enough)
    limit = F.lit(overall).cast("double")
    for lang, q in limits.items():
        limit = F.when(F.col("lang").eqNullSafe(F.lit(lang)), F.lit(q)).otherwise(limit)
    judged = scores.withColumn("limit", limit * margin)
    keep = F.lit(True) if overall is None else F.coalesce(F.col("bits") <= F.col("limit"), F.lit(False))
    return judged.select("doc_id", "lang", F.pow(F.lit(2.0), "bits").alias("perplexity"), F.pow(F.lit(2.0), "limit").alias("threshold"), keep.alias("keep"))


def keep_documents(docs: DataFrame, trusted_ids: DataFrame, **options) -> DataFrame:
    """The documents that `judge` keeps, with all their columns."""
    name = unused(docs, "kept_")
    kept = judge(docs, trusted_ids, **options).where("keep").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(kept.hint("merge"), docs["doc_id"].eqNullSafe(F.col(name)), "left_semi")
