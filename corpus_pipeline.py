"""A corpus pipeline: each stage applies one operator of docrel.llm to what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docrel.llm import decontam, linededup, mixing, simhash, toxicity
from docrel.llm.common import read, stage


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Each row is judged by its whole text: null and empty texts score what a text without words does, which is not toxic; equal rows share their fate, and
    null doc_ids matter as little as other columns, which stay as they are. An empty table gives an empty result; without labels of both classes the
    given lexicons decide.
    """
    scorer = toxicity.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, scorer)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; every document stays, with what is left of its whole text.

    Null texts become empty, a document may become empty; the largest doc_id keeps the line, all rows that share it too, and null is less than
    any. Other columns stay as they are, whatever their names. An empty table gives an empty result.
    """
    return linededup.drop_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of like documents stays: the smallest doc_id, null first, ties by a hash of the text.

    Whole texts count. Null and empty texts are one group, and so are equal texts; repeated rows stay once. Columns stay as they are. An empty table gives an empty result.
    """
    return simhash.near_dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Whole texts are searched; null and empty texts hold none and stay. Repeated rows stay or go together; doc_ids, null too, and other columns do not matter and stay as they are.
    Items without id or words match nothing; an empty table gives an empty result.
    """
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the target weights choose, with how often each is taken.

    Null lang and source are the value unknown; documents without words (null, empty) cost nothing and come with any prefix they lie in; rows that tie in the seeded order, as repeated
    ones do, stand or fall together. Only the mixture's columns come out. An empty table gives an empty result.
    """
    return mixing.mix(docs)


STAGES = [("toxicity", toxic), ("line_dedup", lines), ("near_dedup", near_copies), ("decontamination", benchmark), ("mixing", mixture)]

#: The classifier's weights come from an iterative fit, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
