"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    embedding_dedup,
    html_text,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    phrases,
    quality,
    sharding,
    spelling,
    token_counts,
    topk_search,
    toxicity,
)
from ledgerline.llm.oracles import ORACLES
from ledgerline.workspace import Workspace

__all__ = ["ORACLES", "QUERIES"]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(Workspace(spark, "op1"), _read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and removed lines of each document, and length and checksum of the text that stays."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    left = line_dedup.dedup_lines(Workspace(spark, "op3"), docs, whole=True)
    text = F.coalesce("text", F.lit(""))
    return left.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.length(text).cast("long").alias("n_chars"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, "op5")
    return ngram_join.ngram_groups(space, _read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.measure(docs).select(
        "doc_id",
        *(f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        "quality.base_failed",
        "quality.kept",
        "quality.lost_words",
        F.length("quality.cleaned").cast("long").alias("n_cleaned"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(Workspace(spark, "op7"), _read(spark, sf_dir, "documents"), with_ids=False)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of each category of the chain, and whether the document is toxic."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, _read(spark, sf_dir, "labels"))
    toxic = F.col("toxicity.toxic") >= toxicity.THRESHOLD
    scores = (F.col(f"toxicity.{n}").alias(f"p_{n}") for n in chain.names)
    return toxicity.score(docs, chain).select("doc_id", *scores, toxic.alias("toxic"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.vector_groups(Workspace(spark, "op9"), _read(spark, sf_dir, "embeddings"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.manifest(Workspace(spark, "op10"), _read(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(Workspace(spark, "op11"), _read(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(Workspace(spark, "op12"), _read(spark, sf_dir, "documents"))


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_inner(Workspace(spark, "op13"), _read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_token_counts": op2_token_counts,
    "op3_line_dedup": op3_line_dedup,
    "op4_html_text": op4_html_text,
    "op5_ngram_join": op5_ngram_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_sharding": op10_sharding,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_topk_search": op13_topk_search,
}
