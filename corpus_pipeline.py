"""From raw documents to tokens: the training-data operators one after the other.

Every stage gets what the one before kept, written and read back, and all but the last return the
columns of `documents`. Stages that drop rows of the same document twice or rows without id decide
by row, never by id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ringtrail.llm import decontaminate, exact_dedup, queries, simhash, toxicity
from ringtrail.llm.rows import release, scratch, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7; the model is learned from the labelled ones among them. NULL and
    empty texts have the score of texts without evidence."""
    model = queries.toxicity_model(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, from_score=0.7)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; NULL and empty texts are equal."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: shingles of three words, three bits. NULL and empty
    texts have fingerprint zero, and one of them stays."""
    return simhash.deduplicate(docs, shingle=3, budget=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items; NULL and empty texts stay."""
    items = decontaminate.indexes(queries.table(spark, sf_dir, "benchmark"))
    return decontaminate.without_leaks(docs, items)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left; NULL and empty texts have no tokens."""
    return queries.bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("byte-level BPE", tokens),
]

#: Nearest neighbours, hashes of shingles and merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage gives. Of the others' tables only the last is left, which it reads."""
    docs = queries.table(spark, sf_dir, "documents")
    read = None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as lasting:
            kept = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            lasting.append(kept)
        if read is not None:
            release(read)
        docs = read = kept
    return STAGES[-1][1](spark, docs, sf_dir)
