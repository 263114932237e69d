"""Language identification with language-bitmask n-gram filters.

Training counts character n-grams by language, keeps an n-gram for a language where its relative
frequency is at least a share of that in the language using it most, and writes the kept n-grams to
a bit-sliced Bloom filter: slot i holds one 64-bit word for every 64 languages, whose bit l belongs to
the filter of language l, so that AND-ing the words of an n-gram's slots yields every language
containing it at once.
Prediction adds up the bits by language, corrects each count for that filter's false positives and
takes the largest.

Defined cases: a null text, or one without a letter, is `und` with score 0; a text whose n-grams are
in no filter is given the language seen most in training, with score 0; equal estimates go to the
language seen more in training, then to the smaller name. Repeated rows get equal answers. Without
any training row every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cindermill.llm.common import bounded_sample

UNDETERMINED = "und"
SIZES = (2, 3, 4)
PROBES = 3
CHUNK = 1 << 18
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)
_SPACE = np.uint32(32)
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def _codes(text: str) -> np.ndarray:
    """Lower-case code points with every non-letter turned into a space, framed by spaces."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full(len(points) + 2, _SPACE, dtype=np.uint32)
    out[1:-1] = np.where(_letter_table()[points], points, _SPACE)
    return out


def _hashes(codes: np.ndarray, starts: int) -> np.ndarray:
    """64-bit hashes of the n-grams of all sizes at the first `starts` places that have letters inside and spaces at the ends only."""
    letter = codes != _SPACE
    wide = codes.astype(np.uint64)
    found = []
    for n in SIZES:
        last = min(starts, len(codes) - n + 1)
        if last < 1:
            continue
        valid = letter[1:last + 1] | letter[:last] if n == 2 else letter[1:last + 1].copy()
        for j in range(2, n - 1):
            valid &= letter[j:last + j]
        h = np.full(last, n, dtype=np.uint64)
        for j in range(n):
            h += wide[j:last + j] * _MULTIPLIERS[j]
        h = h[valid]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        found.append(h)
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def ngram_hashes(text: str, chunk: int = CHUNK) -> Iterator[np.ndarray]:
    """The n-gram hashes of the whole text, in pieces of bounded size: each n-gram belongs to the piece where it starts."""
    codes = _codes(text)
    for start in range(0, len(codes), chunk):
        yield _hashes(codes[start:start + chunk + max(SIZES) - 1], chunk)


def _slots(hashes: np.ndarray, n_slots: int) -> list[np.ndarray]:
    step = (hashes >> np.uint64(40)) | np.uint64(1)
    mask = np.uint64(n_slots - 1)
    return [((hashes + np.uint64(k) * step) & mask).astype(np.int64) for k in range(PROBES)]


@dataclass
class LanguageFilters:
    """Fitted filters; `slots` has a row for each slot with a bitmask for every 64 languages."""

    languages: list[str]
    slots: np.ndarray
    false_positive: np.ndarray

    def hits(self, text: str) -> tuple[int, np.ndarray]:
        """Number of n-grams and, by language, how many its filter reports."""
        total, hits = 0, np.zeros(len(self.languages), dtype=np.int64)
        for hashes in ngram_hashes(text):
            total += len(hashes)
            places = _slots(hashes, len(self.slots))
            for word in range(self.slots.shape[1]):
                masks, here = self.slots[places[0], word], self.languages[64 * word:64 * word + 64]
                for slot in places[1:]:
                    masks &= self.slots[slot, word]
                if len(here) <= 8:
                    seen = np.bincount(masks.astype(np.int64), minlength=1 << len(here))
                    values = np.arange(len(seen))
                    counts = [seen[(values >> lang) & 1 == 1].sum() for lang in range(len(here))]
                else:
                    counts = [int(((masks >> np.uint64(lang)) & np.uint64(1)).sum()) for lang in range(len(here))]
                hits[64 * word:64 * word + len(here)] += np.array(counts, dtype=np.int64)
        return total, hits

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and the corrected share of the n-grams that the language's filter holds."""
        if text is None or not self.languages:
            return UNDETERMINED, 0.0, 0.0
        total, hits = self.hits(text)
        if not total:
            return UNDETERMINED, 0.0, 0.0
        share = np.clip((hits / total - self.false_positive) / (1 - self.false_positive), 0, 1)
        best = int(np.argmax(share))
        rest = np.delete(share, best).max(initial=0.0)
        score = float(share[best] / (share[best] + rest)) if share[best] > 0 else 0.0
        return self.languages[best], score, float(share[best])


def _count_batches(languages: list[str], most: int = 1 << 22):
    index = {name: k for k, name in enumerate(languages)}

    def counted(lang: int, found: list[np.ndarray]) -> pa.RecordBatch:
        grams, counts = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(np.full(len(grams), lang, dtype=np.int32)), pa.array(counts.astype(np.int64))], names=["gram", "lang", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[np.ndarray]] = {}
        held = 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                for hashes in ngram_hashes(text.as_py() or ""):
                    parts.setdefault(index[lang.as_py()], []).append(hashes)
                    held += len(hashes)
                if held >= most:  # no more n-grams at once, and one text's
                    yield from (counted(lang, found) for lang, found in parts.items())
                    parts, held = {}, 0
        yield from (counted(lang, found) for lang, found in parts.items())

    return run


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", docs_per_language: int = 4000, n_slots: int = 1 << 20, share: float = 0.1, min_count: int = 3) -> LanguageFilters:
    """Learn the filters from labelled rows.

    docs_per_language bounds (in expectation, by a hash of `key`) the rows read for each language.
    The filter has n_slots words for every 64 languages whatever the input, so it can be sent to every task.
    """
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    seen = sorted(((r["count"], r["lang"]) for r in rows.groupBy("lang").count().collect()), key=lambda x: (-x[0], x[1]))
    languages = [name for _, name in seen]
    if not languages:
        return LanguageFilters([], np.zeros((n_slots, 1), dtype=np.uint64), np.zeros(0))
    fraction = F.lit(0.0)
    for n, name in seen:
        fraction = F.when(F.col("lang") == name, F.lit(min(1.0, docs_per_language / n))).otherwise(fraction)
    sample = bounded_sample(rows, "key", fraction).select("text", "lang")
    counts = sample.mapInArrow(_count_batches(languages), "gram long, lang int, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    by_gram = counts.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total")).groupBy("gram").agg(F.collect_list(F.struct("lang", "n", "rate")).alias("uses"), F.max("rate").alias("top"))
    uses = F.filter("uses", lambda u: (u["rate"] >= share * F.col("top")) & (u["n"] >= min_count))
    kept = by_gram.select("gram", F.explode(uses).alias("use")).groupBy("gram", F.floor(F.col("use.lang") / 64).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("use.lang", F.lit(64)))).alias("bits"))

    def to_slots(batches):
        for batch in batches:
            hashes, words, masks = batch.column(0).to_numpy().view(np.uint64), batch.column(1), batch.column(2)
            for slot in _slots(hashes, n_slots):
                yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), words, masks], names=["slot", "word", "bits"])

    filled = kept.mapInArrow(to_slots, "slot int, word int, bits long").groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow()  # n_slots rows at most for every 64 languages
    slots = np.zeros((n_slots, -(-len(languages) // 64)), dtype=np.uint64)
    slots[filled.column("slot").to_numpy(), filled.column("word").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)
    fill = np.array([((slots[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(languages))])
    return LanguageFilters(languages, slots, np.minimum(fill ** PROBES, 0.99))


OUTPUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_share", T.DoubleType())])


def predict(df: DataFrame, filters: LanguageFilters, text: str = "text") -> DataFrame:
    """Every column of df but the text and older ones of those names, followed by lang_pred, score and lang_share."""
    shared = df.sparkSession.sparkContext.broadcast((filters.languages, filters.slots, filters.false_positive))
    kept = [c for c in df.columns if c not in (text, *OUTPUT.names)]
    schema = T.StructType([df.schema[c] for c in kept] + OUTPUT.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageFilters(*shared.value)
        for batch in batches:
            made = [model.predict(value.as_py()) for value in batch.column(0)]
            langs, scores, shares = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.float64())], names=schema.names)

    return df.select(text, *kept).mapInArrow(run, schema)


def keep_identified(df: DataFrame, filters: LanguageFilters, text: str = "text", least_share: float = 0.2) -> DataFrame:
    """The rows of df whose text is in one of the learned languages: it has letters, and the chosen filter holds at least `least_share` of its n-grams."""
    if not filters.languages:  # nothing was learned, so nothing can be rejected
        return df
    shared = df.sparkSession.sparkContext.broadcast((filters.languages, filters.slots, filters.false_positive))
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageFilters(*shared.value)
        for batch in batches:
            keep = [model.predict(value.as_py())[2] >= least_share for value in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)
