"""Spelling variants: words one edit apart, found by pivotal bigrams.

Bigrams are ordered from rare to common. The prefix of a word is its three rarest bigrams (more where
they tie), and its pivots are two of them that do not overlap, the rarest such two by dynamic
programming. One edit changes one of two disjoint bigrams at most and moves the other by one place at
most. So of two words that are one edit apart, the one whose prefix ends earlier in the order has a
pivot that is in the other's prefix too: a common bigram that is not after the end of the shorter
prefix is not after the end of the longer one.

Prefixes are indexed by bigram, its place, and the length of the word. A pivot is looked up in the
five ways in which an edit can leave it: length and place unchanged, a longer or shorter word with the
bigram in its place (the edit is behind it) or one place on or back (the edit is before it).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.rows import scratch, staged

#: Bigrams are counted in this many buckets, whatever the alphabet, so the counts have a fixed size.
BUCKETS = 1 << 16
#: Index entries of one bigram, place and length that one task compares.
HOT_ENTRIES = 20_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: How the length of a word and the place of an unchanged bigram may differ after one edit.
MOVES = [(0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1)]


def spelled_words(docs: DataFrame, every: int = 199) -> Column:
    """The words of a text: maximal runs of A-Z, a-z and U+00C0-U+00FF with A-Z lower-cased.

    Where `every` divides h, the crc32 of "doc_id:word", the word lacks its code point h % length.
    """
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    prefix = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))

    def spelled(run: Column) -> Column:
        h = F.crc32(F.concat(prefix, run))
        at = F.pmod(h, F.length(run)).cast("int")
        short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
        return F.when(h % every == 0, short).otherwise(run)

    runs = F.regexp_extract_all(text, F.lit("([a-z\\u00C0-\\u00FF]+)"), F.lit(0))
    return F.transform(runs, spelled)


def word_counts(docs: DataFrame, least_length: int = 6, least_count: int = 5) -> DataFrame:
    """word, n of all words of at least that length and so many occurrences. Words are counted where
    texts are read, before anything is shuffled."""
    words = docs.select(F.explode(spelled_words(docs)).alias("word"))
    counts = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_count)


def _bucket(gram: str) -> int:
    return zlib.crc32(gram.encode()) % BUCKETS


def bigram_counts(words: DataFrame) -> np.ndarray:
    """Words that have a bigram, by its bucket; `BUCKETS` numbers."""
    grams = F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2))
    )
    each = words.select(F.explode(F.array_distinct(grams)).alias("gram"))
    bucket = F.crc32("gram") % BUCKETS
    found = np.zeros(BUCKETS, np.int64)
    for row in each.groupBy(bucket.alias("bucket")).count().toLocalIterator():
        found[row["bucket"]] = row["count"]
    return found


def prefix_and_pivots(
    word: str, weight: Callable[[str], int]
) -> tuple[list[tuple[int, str, int]], tuple[int, int]]:
    """The prefix as (weight, bigram, place) in the common order, and the places of the pivots."""
    grams = sorted((weight(word[i : i + 2]), word[i : i + 2], i) for i in range(len(word) - 1))
    end = grams[2][:2]
    prefix = [g for g in grams if g[:2] <= end]
    # Least weight of one bigram so far, of those that end before the place, and of two.
    one: list[tuple[int, int]] = []
    two = None
    for w, _, place in sorted(prefix, key=lambda g: g[2]):
        before = [found for found in one if found[1] <= place - 2]
        if before:
            best = min(before)
            if two is None or best[0] + w < two[0]:
                two = (best[0] + w, best[1], place)
        one.append((w, place))
    return prefix, two[1:]


_ENTRY = "gram string, place int, length int, word string, n long, end_weight long, end_gram string, pivot boolean"


def _entries(counts: np.ndarray):
    def run(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered: dict[str, int] = {}

        def weight(gram: str) -> int:
            if gram not in remembered:
                if len(remembered) >= BUCKETS:
                    remembered.clear()
                remembered[gram] = int(counts[_bucket(gram)])
            return remembered[gram]

        for batch in source:
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prefix, pivots = prefix_and_pivots(word, weight)
                end_weight, end_gram, _ = prefix[-1]
                for _, gram, place in prefix:
                    rows.append((gram, place, len(word), word, n, end_weight, end_gram, place in pivots))
            names = [f.split()[0] for f in _ENTRY.split(", ")]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def near_pairs(words: DataFrame, hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """word, near, n_of_near for all ordered pairs of words that are one inserted, deleted or
    replaced code point apart, staged.

    `words` has word (4 code points at least, each word once) and n. Index entries of one key beyond
    `hot_entries` are dealt out over several tasks, and their pivots shown to each.
    """
    entries = staged(
        words.select("word", "n").mapInArrow(_entries(bigram_counts(words)), _ENTRY), "entries"
    )
    key = ["gram", "place", "length"]
    sizes = entries.groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > hot_entries)
    hot = staged(sizes.select(*key, F.ceil(F.col("size") / hot_entries).cast("int").alias("salts")), "hot")
    moved = F.explode(
        F.array(
            *[
                F.struct((F.col("place") + by).alias("place"), (F.col("length") + longer).alias("length"))
                for longer, by in MOVES
            ]
        )
    )
    looked_up = entries.where("pivot").select(
        "gram", moved.alias("to"), F.col("word").alias("a"), F.col("n").alias("n_a"), "end_weight", "end_gram"
    )
    looked_up = looked_up.select("gram", "to.*", "a", "n_a", F.struct("end_weight", "end_gram").alias("end_a"))
    salts = F.coalesce("salts", F.lit(1))
    looked_up = looked_up.join(hot, key, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    index = entries.join(hot, key, "left").select(
        *key,
        F.pmod(F.xxhash64("word"), salts).cast("int").alias("salt"),
        F.col("word").alias("b"),
        F.col("n").alias("n_b"),
        F.struct("end_weight", "end_gram").alias("end_b"),
    )
    found = looked_up.drop("salts").join(index, [*key, "salt"]).where(
        (F.col("end_a") <= F.col("end_b"))
        & (F.col("a") != F.col("b"))
        & (F.levenshtein("a", "b", 1) == 1)
    )
    # Words whose prefixes end alike find each other, and a pair may share both pivots.
    once = found.select(
        F.least("a", "b").alias("x"),
        F.greatest("a", "b").alias("y"),
        F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_x"),
        F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_y"),
    ).distinct()
    once = staged(once, "pairs")
    return once.select(F.col("x").alias("word"), F.col("y").alias("near"), F.col("n_y").alias("n_of_near")).unionByName(
        once.select(F.col("y").alias("word"), F.col("x").alias("near"), F.col("n_x").alias("n_of_near"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms lead in the end, for every word that has a form.

    A form is more frequent than its word by a factor, so there are no circles, and each round
    doubles the steps that are taken. A form has no more words than there are words one edit from it.
    """
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = staged(now.join(on, "root", "left").select("word", "root", "next"), "roots")
        if further.where("next is not null").isEmpty():
            return further.select("word", "root")
        now = further.select("word", F.coalesce("next", "root").alias("root"))


def variants(
    docs: DataFrame, least_length: int = 6, least_count: int = 5, factor: int = 5, hot_entries: int = HOT_ENTRIES
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word (see `word_counts`), staged.

    A word's form is its near word with the largest n (of equal ones the first in code-point order)
    if that is at least `factor` times the word's own; else NULL. `root` is where forms lead in the
    end, the word itself if it has none. NULL and empty texts have no words; a NULL doc_id counts as
    an empty one. Repeated rows count each time. Only doc_id and text are read.
    """
    with scratch(docs.sparkSession) as lasting:
        words = staged(word_counts(docs, least_length, least_count), "words")
        pairs = near_pairs(words, hot_entries)
        best = F.min(F.struct((-F.col("n_of_near")).alias("less"), "near"))
        near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
        formed = words.join(near, "word", "left").withColumn("top", -F.col("best.less"))
        has = F.col("top") >= F.col("n") * factor
        formed = staged(
            formed.select(
                "word",
                "n",
                F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                F.when(has, F.col("best.near")).alias("form"),
                F.when(has, F.col("top")).alias("form_n"),
            ),
            "forms",
        )
        ends = roots(formed.where("form is not null"))
        found = formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
        found = staged(found, "variants")
        lasting.append(found)
    return found
