"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word has two embeddings added up, one found by a hash of the word and one by a hash of its first
letters. Filters of several widths slide over the words; each filter's largest activation in the text
goes to a logistic output. Training starts on a bounded sample of labelled texts; then every labelled text takes a
step, whole, partition by partition from the same start, and the changes are averaged. Texts are read
whole, in overlapping blocks that have just the windows of the text, whose maxima are combined.

Besides the common threshold of 0.5 on the score, thresholds are calibrated by language: for each
language of the training rows the score, in thousandths, that separates its labels with fewest errors, by the scores that
texts have before they are learned from. The language never enters a score.

Defined cases: a null text counts as empty; a text without words gets the score of all filters at
rest. Labels that are null, or without a document, are not read; a document labelled more than once
is toxic if any label says so. Without labelled rows every score is 0. Equal texts get equal scores.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import bounded_sample, materialise, texts

BUCKETS = 1 << 15
WIDTHS = (1, 2, 3)
_EDGES = re.compile(r"^\W+|\W+$")


class WordIds(dict):
    """Hashed ids (word, prefix) of raw words, kept in a bounded cache."""

    def __init__(self, prefix: int = 5, cached: int = 300_000):
        super().__init__()
        self.prefix, self.cached = prefix, cached

    def __missing__(self, raw: str) -> int:
        word = _EDGES.sub("", raw).casefold()
        data = word.encode("utf-8", "surrogatepass")
        ids = (zlib.crc32(data) % BUCKETS) << 16 | (zlib.crc32(b"^" + word[:self.prefix].encode("utf-8", "surrogatepass")) % BUCKETS)
        if len(self) >= self.cached:
            self.clear()
        if len(raw) <= 64:
            self[raw] = ids
        return ids

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))


@dataclass
class ConvolutionalClassifier:
    """Parameters: word and prefix embeddings, a kernel and a bias for each width, the output weights."""

    words: np.ndarray
    prefixes: np.ndarray
    kernels: list[np.ndarray]  # width x dimension x filters
    biases: list[np.ndarray]
    output: np.ndarray
    intercept: float
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fresh(cls, dimension: int = 16, filters: int = 8, seed: int = 7) -> ConvolutionalClassifier:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(draw(BUCKETS, dimension, scale=0.1), draw(BUCKETS, dimension, scale=0.1), [draw(w, dimension, filters, scale=1 / np.sqrt(w * dimension)) for w in WIDTHS], [np.zeros(filters, dtype=np.float32) for _ in WIDTHS], draw(len(WIDTHS) * filters, scale=0.3), 0.0)

    def embed(self, ids: np.ndarray) -> np.ndarray:
        return self.words[ids >> 16] + self.prefixes[ids & 0xFFFF]

    def _activations(self, ids: np.ndarray, before: int = max(WIDTHS) - 1, after: int = max(WIDTHS) - 1) -> tuple[np.ndarray, list[np.ndarray]]:
        """Embeddings framed by so many places of silence, and for each width the filter values at every place."""
        x = np.zeros((before + len(ids) + after, self.words.shape[1]), dtype=np.float32)
        if len(ids):
            x[before:before + len(ids)] = self.embed(ids)
        values = []
        for w, kernel, bias in zip(WIDTHS, self.kernels, self.biases):
            n = max(0, len(x) - w + 1)
            values.append(sum(x[k:k + n] @ kernel[k] for k in range(w)) + bias)
        return x, values

    def pooled(self, ids: np.ndarray, block: int = 4096) -> np.ndarray:
        """Largest activation of each filter over the whole text, in blocks that overlap by the widest filter less one.

        Silence stands before the first block and after the last one only, so every window of the text is met and no other.
        """
        pad = max(WIDTHS) - 1
        best = np.zeros(sum(k.shape[2] for k in self.kernels), dtype=np.float32)
        for start in range(0, max(1, len(ids)), block):
            begin = max(0, start - pad)
            last = start + block >= len(ids)
            _, values = self._activations(ids[begin:start + block], 0 if start else pad, pad if last else 0)
            np.maximum(best, np.concatenate([v.max(axis=0) if len(v) else np.zeros(v.shape[1], dtype=np.float32) for v in values]), out=best)
        return best

    def score(self, ids: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.pooled(ids) @ self.output + self.intercept, -40, 40))))

    def train(self, samples: list[np.ndarray], labels: np.ndarray, epochs: int = 6, rate: float = 0.05, seed: int = 7) -> list[np.ndarray]:
        """Stochastic gradient steps with Adagrad on the logistic loss, both labels weighing the same; returns the state of `step`."""
        rng = np.random.default_rng(seed)
        weight = {1: len(labels) / max(1, 2 * labels.sum()), 0: len(labels) / max(1, 2 * (len(labels) - labels.sum()))}
        sizes = [*(np.full_like(p, 1e-2) for p in self.parameters()), np.full(1, 1e-2)]
        for _ in range(epochs):
            for i in rng.permutation(len(samples)):
                self.step(samples[i], int(labels[i]), weight[int(labels[i])], sizes, rate)
        return sizes

    def _tops(self, ids: np.ndarray, block: int = 4096) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The place of each filter's largest value, counted with the silence before the text, and the value; in blocks as `pooled`."""
        pad, at, top = max(WIDTHS) - 1, [], []
        for start in range(0, max(1, len(ids)), block):
            begin, last = max(0, start - pad), start + block >= len(ids)
            _, values = self._activations(ids[begin:start + block], 0 if start else pad, pad if last else 0)
            for k, v in enumerate(values):
                if not start:
                    at.append(np.zeros(v.shape[1], dtype=np.int64))
                    top.append(np.full(v.shape[1], -np.inf, dtype=np.float32))
                if len(v):
                    place = v.argmax(axis=0)
                    value = v[place, np.arange(v.shape[1])]
                    better = value > top[k]
                    at[k][better], top[k][better] = place[better] + begin + (pad if start else 0), value[better]
        return at, top

    def step(self, ids: np.ndarray, label: int, weight: float, sizes: list[np.ndarray], rate: float = 0.05) -> float:
        """One step of Adagrad for one text; returns the text's score before it. sizes are the sums of squared gradients, the intercept's last."""
        pad = max(WIDTHS) - 1

        def apply(values: np.ndarray, state: np.ndarray, gradient: np.ndarray, rows=slice(None)) -> None:
            state[rows] += gradient * gradient
            values[rows] -= rate * gradient / np.sqrt(state[rows])

        at, top = self._tops(ids)
        hidden = np.maximum(np.concatenate(top), 0)
        score = 1 / (1 + np.exp(-np.clip(hidden @ self.output + self.intercept, -40, 40)))
        error = (score - label) * weight
        back = (error * self.output * (hidden > 0)).astype(np.float32)
        # the words under all filters' best windows, silence as zeros, and what each of them is pulled by
        places = np.concatenate([at[k] + j for k, w in enumerate(WIDTHS) for j in range(w)])
        inside = (places >= pad) & (places < pad + len(ids))
        x, pulls, begin = np.zeros((len(places), self.words.shape[1]), dtype=np.float32), [], 0
        found = ids[places[inside] - pad]
        x[inside] = self.embed(found)
        for k, (w, kernel) in enumerate(zip(WIDTHS, self.kernels)):
            n = kernel.shape[2]
            g = back[k * n:(k + 1) * n]
            pulls.append((kernel * g).transpose(0, 2, 1).reshape(w * n, -1))
            apply(kernel, sizes[2 + k], x[begin:begin + w * n].reshape(w, n, -1).transpose(0, 2, 1) * g)
            apply(self.biases[k], sizes[2 + len(WIDTHS) + k], g)
            begin += w * n
        apply(self.output, sizes[-2], (error * hidden).astype(np.float32))
        sizes[-1] += error * error
        self.intercept -= float(rate * error / np.sqrt(sizes[-1][0]))
        # one update a place, so a word that stands at several places takes several
        where, which = np.unique(places[inside] - pad, return_inverse=True)
        total = np.zeros((len(where), self.words.shape[1]), dtype=np.float32)
        np.add.at(total, which, np.concatenate(pulls)[inside])
        for row, gradient in zip(ids[where].tolist(), total):
            apply(self.words, sizes[0], gradient, row >> 16)
            apply(self.prefixes, sizes[1], gradient, row & 0xFFFF)
        return float(score)

    def parameters(self) -> list[np.ndarray]:
        return [self.words, self.prefixes, *self.kernels, *self.biases, self.output]

    def flat(self) -> np.ndarray:
        """All parameters in rows of SLOT numbers, copied."""
        values = np.concatenate([*(p.ravel() for p in self.parameters()), [self.intercept]])
        return np.pad(values, (0, -len(values) % SLOT)).reshape(-1, SLOT)

    def moved(self, slots: np.ndarray, change: np.ndarray) -> None:
        """Adds changes to some rows of `flat`."""
        values = self.flat()
        values[slots] += change
        values, start = values.ravel(), 0
        for p in self.parameters():
            p[...] = values[start:start + p.size].reshape(p.shape)
            start += p.size
        self.intercept = float(values[start])

    def copy(self) -> ConvolutionalClassifier:
        fields = (self.words, self.prefixes, self.kernels, self.biases, self.output)
        return ConvolutionalClassifier(*([a.copy() for a in f] if isinstance(f, list) else f.copy() for f in fields), self.intercept)

    def calibrate(self, counts: list[tuple[str, int, int, int]]) -> None:
        """For each language the threshold with fewest errors, of these the one nearest to 0.5, from rows (language, bin, toxic, n); 0.5 where one label is missing."""
        for language in sorted({c[0] for c in counts}):
            table = np.zeros((2, BINS), dtype=np.int64)
            for _, place, toxic, n in (c for c in counts if c[0] == language):
                table[toxic, place] += n
            missed = np.r_[0, np.cumsum(table[1])]  # threshold k / BINS: toxic ones in lower bins are missed
            wrong = table[0].sum() - np.r_[0, np.cumsum(table[0])]
            good = np.flatnonzero(missed + wrong == (missed + wrong).min()) / BINS
            both = table[0].any() and table[1].any()
            self.thresholds[language] = float(good[np.argmin(np.abs(good - 0.5))]) if both else 0.5


#: Parameters in a row of a changes table, bins of scores for thresholds, labelled documents that are learned one after another.
SLOT, BINS, SHARD = 16, 1000, 8000


def learn_all(model: ConvolutionalClassifier, sizes: list[np.ndarray], rows: DataFrame) -> None:
    """Every row (toxic, lang, early, text) takes a step of weight one, so that scores come near the labels' shares, in parallel from
    the same start; Spark averages the changes of each parameter over
    the partitions that changed it. Thresholds are calibrated on the scores that rows had before their own step, but for
    the early ones, which the start has seen."""
    shared = rows.sparkSession.sparkContext.broadcast((model, sizes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, state = shared.value
        mine, state, words, counts = start.copy(), [s.copy() for s in state], WordIds(), Counter()
        for batch in batches:
            for toxic, lang, early, text in zip(*(batch.column(k).to_pylist() for k in range(3)), texts(batch.column(3))):
                score = mine.step(words.of(text), toxic, 1.0, state)
                if not early:
                    counts[lang, min(BINS - 1, int(score * BINS)), toxic] += 1
        change = mine.flat() - start.flat()
        slots = np.flatnonzero(change.any(axis=1))
        names = ["lang", "place", "toxic", "n", *(f"v{k}" for k in range(SLOT))]
        none = lambda rows, kind: pa.nulls(len(rows), kind)
        yield pa.RecordBatch.from_arrays([none(slots, pa.string()), pa.array(slots, pa.int32()), none(slots, pa.int32()), none(slots, pa.int64()), *(pa.array(change[slots, k]) for k in range(SLOT))], names=names)
        lang, place, toxic = (list(c) for c in zip(*counts)) if counts else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(place, pa.int32()), pa.array(toxic, pa.int32()), pa.array(list(counts.values()), pa.int64()), *(none(lang, pa.float64()) for _ in range(SLOT))], names=names)

    made = materialise(rows.mapInArrow(run, "lang string, place int, toxic int, n long, " + ", ".join(f"v{k} double" for k in range(SLOT))))
    changes = made.where("lang IS NULL").groupBy("place").agg(*[F.avg(f"v{k}").alias(f"v{k}") for k in range(SLOT)]).toArrow()
    model.moved(changes.column("place").to_numpy(), np.stack([changes.column(f"v{k}").to_numpy() for k in range(SLOT)], axis=1))
    counted = made.where("lang IS NOT NULL").groupBy("lang", "place", "toxic").agg(F.sum("n").alias("n")).collect()
    model.calibrate([tuple(r) for r in counted])


def fit(documents: DataFrame, labels: DataFrame, per_label: int = 2500, text: str = "text", most_words: int = 20_000) -> ConvolutionalClassifier:
    """Learn from every labelled document, whole.

    The start is trained in several epochs on at most about per_label documents of each label, chosen by a hash of doc_id and of at most most_words
    words, less a fifth; only their hashed words come to the driver. Then all labelled documents take their step, in parallel (`learn_all`).
    """
    marked = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    model = ConvolutionalClassifier.fresh()
    known = marked.join(documents.select("doc_id"), "doc_id", "left_semi")
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not counts:
        model.output[:] = 0
        model.intercept = -40.0
        return model
    total = sum(counts.values())
    fraction = F.lit(0.0)
    for toxic, n in counts.items():
        fraction = F.when(F.col("toxic") == toxic, F.lit(min(1.0, per_label / n))).otherwise(fraction)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds()
        for batch in batches:
            ids = [words.of(t) for t in texts(batch.column(2))]
            made = pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ids, pa.list_(pa.int64()))], names=["order", "toxic", "ids"])
            yield made.filter(pa.array([len(i) <= most_words for i in ids], pa.bool_()))

    def once(some: DataFrame, shards: int | None = None) -> DataFrame:
        """order, toxic, lang, text of the documents of some labels; of rows with one id the first by hash, so that a repeated id counts once."""
        read = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col(text).alias("text"))
        read = read if shards is None else read.repartition(shards, "doc_id")
        rows = read.join(some, "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "lang", "text")).alias("row"))
        return rows.select("doc_id", F.xxhash64("doc_id", "row.text").alias("order"), "toxic", F.coalesce("row.lang", F.lit("")).alias("lang"), "row.text")

    chosen = F.broadcast(bounded_sample(known, "doc_id", fraction))  # about per_label rows of each label
    sample = once(chosen).select("order", "toxic", "text").where("pmod(order, 5) != 0").mapInArrow(hashed, "order long, toxic int, ids array<long>").toArrow().combine_chunks()
    order = np.argsort(sample.column("order").to_numpy(), kind="stable")
    column = sample.column("ids")
    samples, y = [column[int(i)].values.to_numpy() for i in order], sample.column("toxic").to_numpy()[order].astype(np.int64)
    sizes = model.train(samples, y)
    early = (F.pmod("order", F.lit(5)) != 0) & (F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < fraction * 1_000_000)
    rows = once(known, -(-total // SHARD)).sortWithinPartitions("order").select("toxic", "lang", early.alias("early"), "text")
    learn_all(model, sizes, rows)
    return model


def score(df: DataFrame, model: ConvolutionalClassifier, text: str = "text") -> DataFrame:
    """Every column of df but the text, followed by score."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in (text, "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = shared.value, WordIds()
        for batch in batches:
            scores = [model.score(words.of(t)) for t in texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], names=[*kept, "score"])

    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in kept)
    return df.select(text, *kept).mapInArrow(run, f"{fields}score double")


def decide(scored: DataFrame, model: ConvolutionalClassifier, lang: str = "lang") -> DataFrame:
    """Adds predicted (score >= 0.5), the language's threshold, and flagged (score >= that threshold)."""
    threshold = F.lit(0.5)
    for language, value in model.thresholds.items():
        threshold = F.when(F.coalesce(F.col(lang), F.lit("")) == language, F.lit(value)).otherwise(threshold)
    return scored.withColumns({"predicted": (F.col("score") >= 0.5).cast("int"), "threshold": threshold, "flagged": (F.col("score") >= threshold).cast("int")})
