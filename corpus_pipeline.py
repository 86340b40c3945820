"""The corpus pipeline: stages that each take the documents the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.llm import bpe, decontam, linededup, minhash, quality_crf
from spanfolio.llm.labelled import in_training
from spanfolio.llm.queries import table, vocabulary
from spanfolio.sources.workspace import materialise

#: Documents scored below this go.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (5) doesn't reject. Those without a line score 0 and go."""
    field = quality_crf.fit(docs, table(spark, sf_dir, "labels").where(in_training()))
    score = "score"
    while score in docs.columns:
        score += "_"
    return quality_crf.scored(docs, field, name=score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one (4); those of which no word is left go.

    ``n_chars`` is that of the text that is left, where there is such a column.
    """
    out = linededup.deduplicated(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates (6): five words, similarity of 0.8."""
    return minhash.distinct(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item (3)."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every whole text (8), ``token_ids``, and whether they decode to it, beside the columns of the documents."""
    path, pattern = vocabulary()
    out = bpe.encoded(docs, path, pattern)
    return out.withColumn("round_trip", F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", tokens),
]

#: No stage but the fourth can be told in SQL; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
