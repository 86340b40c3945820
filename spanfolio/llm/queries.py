"""Queries over the text tables, one for each operator, and the SQL to check them against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfolio.llm import bpe, collocations, conversation_trie, decontam, linededup, minhash, perplexity, pii, quality_crf, substring, suffix, toxicity, word_bpe
from spanfolio.llm.labelled import in_training
from spanfolio.llm.oracles import ORACLES
from spanfolio.llm.text import numbered


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def vocabulary() -> tuple[str, str]:
    """File of ranks and the pattern that splits texts, of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def sha(column) -> F.Column:
    return F.sha2(column.cast("binary"), 256)


def _judged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", F.coalesce(~in_training(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that each whole text is toxic, learned from the labels that may be learned from."""
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(in_training()))
    out = toxicity.scored(docs, model)
    model.discard()
    return _judged(out, 0.3)


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every whole text that lie in strings of 100 bytes that start earlier too, removed."""
    rows, key = numbered(documents(spark, sf_dir))
    return rows.select("doc_id", key).join(suffix.deduplicated(rows, key, digest=True), key).drop(key)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text that lie in windows of benchmark items."""
    rows, key = numbered(documents(spark, sf_dir))
    found = decontam.hits(rows, table(spark, sf_dir, "benchmark"), key)
    out = found.withColumns(
        {
            "n_items": F.size("items").cast("long"),
            "items_sha256": sha(F.array_join("items", ",")),
            "contaminated": F.col("n_hit") > 0,
        }
    ).drop("items", "spans")
    return rows.drop("text").join(out, key).drop(key)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every whole text that repeat an earlier one or are one word from it, removed."""
    out = linededup.deduplicated(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_removed", sha(F.col("text")).alias("kept_sha256"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that each whole text is good, learned from the labels that may be learned from."""
    docs = documents(spark, sf_dir)
    field = quality_crf.fit(docs, table(spark, sf_dir, "labels").where(in_training()))
    return _judged(quality_crf.scored(docs, field), 0.7)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every whole text, and whether the text is its first."""
    rows, key = numbered(documents(spark, sf_dir))
    found = minhash.grouped(rows, key)
    first = rows.select(F.col(key).alias("component"), F.col("doc_id").alias("component_id"))
    out = rows.select("doc_id", key).join(found, key).join(first, "component")
    return out.select("doc_id", "n_shingles", "component_id", (F.col(key) == F.col("component")).alias("kept"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data of every whole text: counts and digest of the base kinds, and all spans."""
    found = pii.found(documents(spark, sf_dir), name="found")
    joined = lambda where: F.expr(
        f"array_join(transform(filter(found, x -> {where}), x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    )
    counts = [F.expr(f"cast(size(filter(found, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in pii.BASE]
    base = joined("x.kind in (" + ", ".join(f"'{k}'" for k in pii.BASE) + ")")
    return found.select("doc_id", *counts, sha(base).alias("base_sha256"), joined("true").alias("spans"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding of every whole text and the text decoded again, as digests."""
    return bpe.encoded(documents(spark, sf_dir), *vocabulary(), digest=True).drop("text")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text that lie in windows of 20 words that start earlier too, removed."""
    rows, key = numbered(documents(spark, sf_dir))
    return rows.select("doc_id", key).join(substring.deduplicated(rows, key, digest=True), key).drop(key)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain counts of every whole text and the verdict of rules and perplexity band."""
    rows, key = numbered(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return rows.select("doc_id", key).join(perplexity.judged(rows, key), key).drop(key)


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding of every whole text by the vocabulary of words, and the text decoded again, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return word_bpe.encoded(documents(spark, sf_dir), path, digest=True).drop("text")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language by how well their words keep together."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, each rebuilt with the first turns of its block."""
    rows = conversation_trie.turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return conversation_trie.trie(conversation_trie.rebuilt(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_pii": op7_pii,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_word_bpe": op11_word_bpe,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_conversation_trie": op13_conversation_trie,
}

__all__ = ["ORACLES", "QUERIES"]
