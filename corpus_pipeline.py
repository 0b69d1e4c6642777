"""The corpus pipeline: documents through five operators, each stage stored for the next.

Rows with a null text pass every stage (no words, no lines, no ids of tokens). An empty table
comes out empty. Columns beside those of ``documents`` pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelda.llm import bpe, decontaminate, line_dedup, minhash, toxicity
from kelda.llm.tables import fold, fresh_names, quoted, ship, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's threshold. Labels of the rows held out by operator 5's
    contract are not learned from here either."""
    labels = table(spark, sf_dir, "labels")
    net = toxicity.learn(docs, labels.where(fold("doc_id", 5) != 0))
    return toxicity.drop_toxic(docs, net)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated windows, ``n_chars`` counted anew. A document
    that loses all its lines has nothing of its own and goes."""
    before, removed = fresh_names(docs, "n_lines", "n_removed")
    cut = line_dedup.dedupe_lines(docs, count_cols=(before, removed))
    emptied = (F.col(removed) > 0) & (F.col(removed) == F.col(before))
    shown = [
        F.when(F.col(removed) > 0, F.char_length("text")).otherwise(F.col(c)).cast(kind).alias(c)
        if c == "n_chars"
        else column
        for (c, kind), column in zip(docs.dtypes, quoted(docs.columns))
    ]
    return cut.where(~emptied).select(shown)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship(spark)
    return minhash.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the benchmark makes up less than a twentieth."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of every document, and digests of the ids and of what they decode to."""
    return bpe.digests(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("minhash", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

# A trained classifier, sampled hashes and token ids are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
