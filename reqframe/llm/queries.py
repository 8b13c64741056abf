"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from reqframe.llm import (
    conversation_trie,
    decontaminate,
    embedding_dedup,
    language,
    near_dedup,
    packing,
    quality,
    quotation,
    secrets,
    suffix_dedup,
    token_alignment,
    token_files,
    toxicity,
)
from reqframe.llm.common import table


def tokenizer_definition(path: str | None = None) -> str:
    """JSON of a tokenizer file; by default the byte-level BPE of ``public_tokenizers``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return Path(path).read_text("utf-8")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"), tokenizer_definition())


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation.reply_order(table(spark, sf_dir, "conversations"))


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(table(spark, sf_dir, "documents"))


def trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def tokenizer_files(ranks: str | None = None, definition: str | None = None, pieces: str | None = None) -> token_alignment.Definitions:
    """The files of two tokenizers; by default the byte-level BPE and the pieces of ``public_tokenizers``."""
    import public_tokenizers as public

    return token_alignment.Definitions(
        ranks or public.path("byte_bpe_50k.tiktoken"),
        definition or public.path("byte_bpe_50k.json"),
        pieces or public.path("piece_bpe_32k.model"),
        public.PATTERN,
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignments(table(spark, sf_dir, "documents"), tokenizer_files())


QUERIES = {
    "op1_decontaminate": decontamination,
    "op2_token_files": tokens,
    "op3_embedding_dedup": vectors,
    "op4_toxicity": toxic,
    "op5_quotation_links": quotes,
    "op6_quality": good,
    "op7_secrets": scans,
    "op8_language": lang,
    "op9_near_dedup": near,
    "op10_packing": packs,
    "op11_suffix_dedup": passages,
    "op12_conversation_trie": trie,
    "op13_token_alignment": pairs,
}

SQL = {
    "op5_quotation_links": quotation.ORACLE,
    "op12_conversation_trie": conversation_trie.ORACLE,
}
