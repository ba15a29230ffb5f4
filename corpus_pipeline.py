"""The corpus pipeline: documents go through filters one after the other and are packed at the end.

Each stage reads what its predecessor kept, written as Parquet, and its decision takes
effect: rows that it rejects are gone from then on. All but the last give rows of documents
with all their columns, whatever these are called; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, exact_dedup, language, near_dedup, packing, shared


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language, or between two, go: null and empty texts, and texts without letters, too."""
    return language.known_language(docs, language.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays, one row of it; null ids come last."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, a similarity of 0.8 or more) the one with the smallest id stays; rows without an id stay."""
    return near_dedup.drop_near_copies(docs, 80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go, however long they are; null texts hold none."""
    return decontaminate.drop_contaminated(docs, shared.read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 4096 tokens; a null text is its end token, very long ones are cut."""
    return packing.pack(docs, packing.vocabulary())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("packing", packed),
]

#: Learnt languages, signatures and token ids can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = shared.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
