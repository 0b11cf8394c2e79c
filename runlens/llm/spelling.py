"""Spelling variants of words: pivotal grams and exact verification.

1. Runs of letters are counted over all texts with built-in functions (map-side
   partial sums, so a frequent word is one row of each task).
2. Grams are the bigrams of a word.  Their order is by the number of words that hold
   them, rarest first (a table of at most the alphabet squared).
3. A word's prefix are its three rarest grams, with all places of the last one.  Of
   those, dynamic programming picks the two disjoint ones of the least weight: its
   pivots.  One edit spoils at most one of two disjoint grams, so of two near words, the
   one whose prefix ends first (in the gram order) keeps a pivot that stands in the
   other's prefix.
4. Pivots meet prefixes on the gram and its position limits: an edit behind the gram
   leaves its place and all before it, an edit before it moves it by the difference of
   lengths and leaves all behind it.  So the equality join has, besides gram, place and
   length, a hash of the untouched side of the word.  Where that side is short, many
   words share it; there the rest is cut in two, of which one part is untouched as well
   (the first if the edit is in the second), so the key has that part too.
5. Candidates are verified by their exact distance.  Groups are small, as the words that
   share a key agree on at least half of their letters; the adaptive planner splits a
   skewed one.
6. A word's form is the near word with the largest count, if ten times its own; forms
   are followed to the root by pointer jumping (counts grow tenfold at every step, so
   chains are short).

Defined results: NULL and empty texts have no words; repeated rows count as often as
they stand; a NULL id counts as the empty text in the checksum; an empty table gives no
rows; ties of the form go to the smallest word; only the id and text columns are read,
so others never clash; words of any length are compared, a very long one like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_materialized, materialize

MIN_LENGTH, MIN_COUNT = 7, 2
#: A form stands at least this many times as often as the word.
FORM_RATIO = 10
#: One run in so many (by checksum) loses a letter.
LOSS = 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: letters of a run.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
#: Sides of a word that an edit leaves untouched.
BEHIND, BEFORE = 0, 1
#: Untouched sides up to this length have a part of the rest in their keys.
SHORT = 6


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n).  Shorter runs than ``min_length`` never become words, so they are
    not extracted; built-in functions only."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"({LETTERS}{{{min_length},}})")))
                       .alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.select(F.when(h % LOSS == 0, shorter).otherwise(F.col("run")).alias("word"))
    return (words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_count))


def gram_ranks(words: DataFrame) -> DataFrame:
    """(gram, words that hold it): at most the alphabet squared rows."""
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))
    return words.select(F.explode(F.array_distinct(grams)).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def pivots_and_prefix(word: str, rank: dict[str, int]) -> tuple[list[int], list[int], int]:
    """(places of the two pivots, places of the prefix, rank of the prefix's end)."""
    ranks = [rank[word[i:i + 2]] for i in range(len(word) - 1)]
    places = sorted(range(len(ranks)), key=lambda i: (ranks[i], i))
    end = ranks[places[2]]
    three = sorted(places[:3])
    # least weight of one and of two disjoint grams that end by each place, left to right
    one: tuple[int, list[int]] | None = None
    ready: list[tuple[int, tuple[int, list[int]]]] = []
    best: tuple[int, list[int]] | None = None
    for i in three:
        for j, best_one in ready:
            if j + 2 <= i:
                one = best_one if one is None or best_one < one else one
        if one is not None and (best is None or (one[0] + ranks[i], one[1] + [i]) < best):
            best = (one[0] + ranks[i], one[1] + [i])
        ready.append((i, (ranks[i], [i])))
    return best[1], [i for i in range(len(ranks)) if ranks[i] <= end], end


def _keys(words: DataFrame, rank: dict[str, int]) -> DataFrame:
    """(word, n, len, pivot, place, end): the pivots and prefix grams of each word."""
    shared = words.sparkSession.sparkContext.broadcast(rank)   # the alphabet squared at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pivot, place, ends = [], [], [], []
            for r, word in enumerate(batch.column("word").to_pylist()):
                chosen, prefix, end = pivots_and_prefix(word, shared.value)
                for flag, places in ((True, chosen), (False, prefix)):
                    rows += [r] * len(places)
                    pivot += [flag] * len(places)
                    place += places
                    ends += [end] * len(places)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("word").take(take), batch.column("n").take(take), pa.array(pivot, pa.bool_()),
                 pa.array(place, pa.int32()), pa.array(ends, pa.int32())], ["word", "n", "pivot", "place", "end"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, pivot boolean, place int, end int")


def _key(rest_of_holder: Column) -> Column:
    """Hash of the untouched side (the gram and all before it for an edit behind it, the
    gram and all behind it for one before it) and, by ``half``, of none (0), the first
    (1) or the second (2) part of the rest.  The parts are cut by the length of the
    rest of the word that holds the gram in its prefix, which both words of a pair know."""
    word, u, m = F.col("word"), F.col("u"), F.col("m")
    behind = F.col("side") == BEHIND
    untouched = F.when(behind, F.substring(word, F.lit(1), u)).otherwise(F.substring(word, m + 1, u))
    rest = F.when(behind, F.substring(word, u + 1, m)).otherwise(F.substring(word, F.lit(1), m))
    first = F.greatest(F.lit(1), F.floor(rest_of_holder / 2).cast("int"))
    second = F.greatest(F.lit(0), rest_of_holder - first)
    part = (F.when(F.col("half") == 0, F.lit("")).when(F.col("half") == 1, F.substring(rest, F.lit(1), first))
            .otherwise(F.substring(rest, m - second + 1, second)))
    return F.xxhash64(untouched, part, F.col("half")).alias("key")


def _sides(keys: DataFrame) -> DataFrame:
    """``keys`` once per side (``u``, ``m``: lengths of the untouched side and the rest)
    and part of the rest that its keys have."""
    size = F.length("word")
    both = F.explode(F.array(*[F.lit(side) for side in (BEHIND, BEFORE)])).alias("side")
    u = F.when(F.col("side") == BEHIND, F.col("place") + 2).otherwise(size - F.col("place"))
    parts = F.when(F.col("u") <= SHORT, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    return (keys.select("word", "n", "end", "place", both).select("*", u.alias("u"))
            .select("*", (size - F.col("u")).alias("m"), F.explode(parts).alias("half")))


def near_words(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): all ordered pairs of words at distance one.  ``words``
    (word, n) is read twice: pass a written table."""
    rank = {r["gram"]: k for k, r in enumerate(gram_ranks(words).orderBy("n", "gram").collect())}   # bounded
    keys = materialize(_keys(words, rank), "spelling-keys")
    # A pivot of a word looks for prefixes of words of each length it may have.
    looks = (_sides(keys.filter("pivot")).select("*", F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)])).alias("d"))
             .select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("end").alias("end_a"), "side",
                     (F.length("word") + F.col("d")).alias("len"), _key(F.col("m") + F.col("d"))))
    holds = _sides(keys.filter(~F.col("pivot"))).select(
        F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("end").alias("end_b"), "side",
        F.length("word").alias("len"), _key(F.col("m")))
    found = (looks.join(holds, ["side", "len", "key"])
             .filter((F.col("a") != F.col("b")) & (F.col("end_a") <= F.col("end_b")))
             .filter(F.levenshtein("a", "b", 1) == 1).select("a", "b", "n_a", "n_b"))
    both = F.explode(F.array(F.struct("a", "b", "n_a", "n_b"), F.struct(
        F.col("b").alias("a"), F.col("a").alias("b"), F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b"))))
    return found.select(both.alias("p")).select("p.*").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word with a form, by pointer jumping."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(at.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots")
        drop_materialized(at)
        at = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return at


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                   min_count: int = MIN_COUNT, ratio: int = FORM_RATIO) -> DataFrame:
    """One row per word: word, n, form, form_n, n_near, root."""
    words = materialize(word_counts(docs, id_col, text_col, min_length, min_count), "spelling-words")
    near = near_words(words)
    best = (near.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("minus"), F.col("b").alias("form"))).alias("f"),
        F.first("n_a").alias("n"))
        .select("word", "n_near", F.when(-F.col("f.minus") >= ratio * F.col("n"), F.col("f")).alias("f"))
        .select("word", "n_near", "f.form", (-F.col("f.minus")).alias("form_n")))
    best = materialize(best, "spelling-forms")
    up = roots(best.filter(F.col("form").isNotNull()))
    return (words.join(best, "word", "left").join(up, "word", "left")
            .select("word", "n", "form", "form_n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                    F.coalesce("root", "word").alias("root")))
