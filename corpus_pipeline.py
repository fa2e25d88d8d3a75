"""A training-corpus pipeline of five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigilgraph.llm import decontaminate as leaks
from sigilgraph.llm import line_dedup, ngram_join, packing, toxicity
from sigilgraph.llm.queries import TOXIC_AT, table, train_rows
from sigilgraph.llm.tokenize import tokenizer_path
from sigilgraph.session import make_importable, materialize, small_batches


def _workers(spark: SparkSession) -> None:
    make_importable(spark)
    small_batches(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7. The field learns from labelled rows of ``documents`` as in
    the operator's query; a document is judged by its text."""
    corpus = table(spark, sf_dir, "documents")
    model = toxicity.train(corpus, train_rows(table(spark, sf_dir, "labels")))
    return toxicity.keep_clean(docs, model, TOXIC_AT)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one (Jaccard 0.8 of words, five words at least)."""
    _workers(spark)
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    _workers(spark)
    return ngram_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage similar by 0.8 to a benchmark item."""
    return leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, without the ids themselves."""
    _workers(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]

#: Models, whole-corpus set joins and tokenizers are not expressible in SQL; tests hold stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
