"""Corpus pipeline: language ID, near-duplicate join, substring dedup, decontamination, BPE encoding and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm.bpe import encode
from pagemill.llm.common import stored, table
from pagemill.llm.decontamination import drop_contaminated
from pagemill.llm.jaccard_join import jaccard_join, keep_first
from pagemill.llm.language_id import held_out, identify, train
from pagemill.llm.paragraph_dedup import drop_repeated_paragraphs, paragraph_clusters
from pagemill.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: without a letter, or between codewords."""
    found = identify(docs, train(docs.where(~held_out())))
    return found.where("not ambiguous").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each component at 0.8 on five-word shingles."""
    return keep_first(docs, jaccard_join(docs, k=5, percent=80))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes later copies of repeated passages out of the texts."""
    return drop_repeated_paragraphs(docs, paragraph_clusters(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of every text and the text that they decode to."""
    return encode(docs, tokenizer_path(), keep_words=False)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: MinHash bands, classifiers and the tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
