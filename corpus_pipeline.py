"""The corpus pipeline: documents through five of the operators, each stage written and read again.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the last return the columns
of ``documents``; the last returns the pieces of packed token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelmart.llm.common import stored, table, with_code
from parcelmart.llm.exact_dedup import drop_exact_duplicates
from parcelmart.llm.jaccard_join import keep_one_of_each
from parcelmart.llm.packing import pack
from parcelmart.llm.quality_classifier import keep_good
from parcelmart.llm.quality_rules import apply_quality_rules
from parcelmart.llm.tokens import public_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it is fitted on the labelled ones among the stage's own documents."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, with failing lines taken out of ``text`` and ``n_chars`` following it."""
    return apply_quality_rules(docs, chars="n_chars")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, that with the smallest id."""
    return drop_exact_duplicates(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8) stays."""
    return keep_one_of_each(docs, words=5, percent=80)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack(docs, public_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("packing", packing),
]
# The classifier and the tokenizer have no SQL form; a brute-force version stands in the tests.
ORACLE_SQL = None


@with_code
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
