"""Spelling variants of words by pivotal grams.

Words at one edit from each other are found through their bigrams. Bigrams have a global order, the rarest
over all words first. A word's prefix is its first three bigrams in that order, with all that tie with the third;
its pivots are two bigrams of the prefix that do not overlap, chosen by dynamic programming along the word so that
they are in the fewest words. One edit touches at most one of two bigrams that do not overlap, so of two near words the one whose
prefix ends earlier has a pivot in the other's prefix. An edit moves what is behind it by at most one place, together with the
length: the five ways in which it can do so are the keys at which pivots meet prefixes, exactly. Pairs that meet are
verified by their edit distance.

Bigrams are of at most two times two letters of the words' alphabet, so their counts are a table of bounded size.

Defined cases: null texts have no words; a null id counts as the empty text; a word without near words, or none
common enough, has no form and is its own root; words of equal count never become each other's form; repeated rows
count again; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import materialise

#: Fixed value: what a run of letters is made of. The lower-cased alphabet has 26 letters less.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX = 3  # one edit times two touched bigrams, and one more
#: Changes of (place, length) of a bigram that one edit elsewhere leaves whole.
MOVES = ((0, 0), (0, 1), (1, 1), (0, -1), (-1, -1))


def runs(documents: DataFrame) -> DataFrame:
    """doc_id as text and run: the lower-cased maximal runs of letters, one row for each occurrence."""
    found = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(f"[{LETTERS}]+"), F.lit(0))
    return documents.where("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(found).alias("run"))


def misspelt(doc: Column, run: Column, modulus: int = 199) -> Column:
    """The run without one code point where the crc32 of `<doc>:<run>` is a multiple of the modulus."""
    h = F.crc32(F.concat(doc, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % modulus == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(words: DataFrame, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """word, n for words long and frequent enough; counted in parts before the shuffle."""
    long = words.where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def grams(counts: DataFrame) -> DataFrame:
    """word, gram, place (from 1), one row for each bigram."""
    places = F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("place")
    return counts.select("word", places).select("word", F.substring(F.col("word"), F.col("place"), F.lit(2)).alias("gram"), "place")


def prefixes(counts: DataFrame) -> DataFrame:
    """word, last (the rank at which the prefix ends), prefix: an array of (place, gram, n, rank) in order of place.

    A bigram's n is the number of words that have it; rank orders bigrams by n, then by name.
    """
    each = grams(counts)
    # at most alphabet squared rows
    order = each.select("word", "gram").distinct().groupBy("gram").agg(F.count("*").alias("n")).withColumn("rank", F.struct("n", "gram"))
    ranked = each.join(F.broadcast(order), "gram").groupBy("word").agg(F.array_sort(F.collect_list(F.struct("rank", "place", "gram", "n"))).alias("grams"))
    last = F.element_at("grams", PREFIX)["rank"].alias("last")
    kept = ranked.select("word", "grams", last)
    return kept.select("word", "last", F.array_sort(F.transform(F.filter("grams", lambda g: g["rank"] <= F.col("last")), lambda g: F.struct(g["place"].alias("place"), g["gram"].alias("gram"), g["n"].alias("n")))).alias("prefix"))


def pivots(prefix: Column) -> Column:
    """Two bigrams (place, gram) of a prefix in order of place that do not overlap, in as few words together as can be.

    Along the word the state is (the rarest bigram two or more places back, those not yet that far, the best pair); ties go to
    the earlier bigram.
    """
    kind = "struct<free:struct<n:bigint,place:int,gram:string>,near:array<struct<n:bigint,place:int,gram:string>>,best:struct<cost:bigint,one:struct<n:bigint,place:int,gram:string>,two:struct<n:bigint,place:int,gram:string>>>"
    start = F.from_json(F.lit('{"near":[]}'), kind)

    def step(state: Column, g: Column) -> Column:
        now = F.struct(g["n"].alias("n"), g["place"].alias("place"), g["gram"].alias("gram"))
        released = F.array_min(F.filter(state["near"], lambda x: x["place"] <= g["place"] - 2))
        free = F.least(state["free"], released)  # least skips nulls
        near = F.concat(F.filter(state["near"], lambda x: x["place"] > g["place"] - 2), F.array(now))
        pair = F.when(free.isNotNull(), F.struct((free["n"] + g["n"]).alias("cost"), free.alias("one"), now.alias("two")))
        return F.struct(free.alias("free"), near.alias("near"), F.least(state["best"], pair).alias("best"))

    best = F.aggregate(prefix, start, lambda state, g: step(state, g).cast(kind), lambda state: state["best"])
    return F.array(best["one"], best["two"])


def near_pairs(counts: DataFrame) -> DataFrame:
    """word, other: both orders of every pair of words at one edit from each other."""
    table = materialise(prefixes(counts))
    size = F.length("word").alias("size")
    held = table.select("word", "last", size, F.explode("prefix").alias("g")).select(F.col("word").alias("other"), F.col("last").alias("other_last"), F.col("g.gram").alias("gram"), F.col("g.place").alias("place"), "size")
    moves = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")) for p, s in MOVES])).alias("m")
    asked = table.select("word", "last", size, F.explode(pivots(F.col("prefix"))).alias("g")).select("word", "last", "size", "g.gram", "g.place", moves).select("word", "last", "gram", (F.col("place") + F.col("m.p")).alias("place"), (F.col("size") + F.col("m.s")).alias("size"))
    met = asked.join(held, ["gram", "place", "size"]).where((F.col("last") <= F.col("other_last")) & (F.col("word") != F.col("other")))
    near = met.where(F.levenshtein("word", "other", 1) == 1).select(F.least("word", "other").alias("word"), F.greatest("word", "other").alias("other")).distinct()
    return near.unionByName(near.select(F.col("other").alias("word"), F.col("word").alias("other")))


def forms(counts: DataFrame, ratio: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n: the near word of the largest count, if that is `ratio` times the word's or more."""
    pairs = near_pairs(counts).join(counts.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    # the largest count, then the smallest word
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other"))).alias("b"))
    joined = counts.join(best, "word", "left")
    common = -F.col("b.minus") >= ratio * F.col("n")
    return joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(common, F.col("b.other")).alias("form"), F.when(common, -F.col("b.minus")).alias("form_n"))


def with_roots(found: DataFrame) -> DataFrame:
    """Adds root: the end of the chain of forms. A form's count is a multiple of its word's, so there are no cycles and
    chains are short; every round doubles what has been followed."""
    found = materialise(found)
    links = materialise(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        doubled = materialise(links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        links = doubled.select("word", "root")
        if doubled.where("moved").isEmpty():
            return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(documents: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5, modulus: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words; a modulus misspells the runs that it chooses first."""
    if least_length < PREFIX + 1:
        raise ValueError(f"words need at least {PREFIX} bigrams")
    found = runs(documents).where(F.length("run") >= least_length)  # a misspelling only shortens
    word = F.col("run") if modulus is None else misspelt(F.col("doc"), F.col("run"), modulus)
    counts = materialise(word_counts(found.select(word.alias("word")), least_length, least_count))
    return with_roots(forms(counts, ratio)).select("word", "form", "root", "n", "n_near", "form_n")
