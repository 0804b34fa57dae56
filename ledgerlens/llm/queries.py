"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import alignment, byte_bpe, embeddings, exact_dedup, hmm, importance, line_chunks, mixing, packing, quality, simhash, token_files, toxicity
from ledgerlens.llm.common import Workspace, fold
from ledgerlens.llm.tokens import vocabulary_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.hmm_scores(_table(spark, sf_dir, "documents"), Workspace(spark, "hmm"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), Workspace(spark, "exact-dedup"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), Workspace(spark, "toxicity"))
    held_out = fold(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT
    return toxicity.toxicity_scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"), Workspace(spark, "simhash"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_links(_table(spark, sf_dir, "embeddings"), Workspace(spark, "embeddings"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.binary_pieces(_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))
    return packing.bucketed_digest(pieces, f"{Workspace(spark, 'packing').root}/buckets")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, "token-files")
    return token_files.token_file_roundtrip(_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), space)


def op8_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_chunks.dedup_lines(_table(spark, sf_dir, "documents"), Workspace(spark, "line-chunks"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return clean.select("doc_id", "n_lines", "removed_lines", "removed_chunks", sha.alias("text_sha256"))


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_chunks.dedup_passages(_table(spark, sf_dir, "documents"), Workspace(spark, "passages"))
    sha = F.sha2(F.col("text").cast("binary"), 256)
    return clean.select("doc_id", "n_lines", "removed_lines", "removed_passages", sha.alias("text_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(_table(spark, sf_dir, "documents"), Workspace(spark, "mixing"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, "quality")
    stats = space.table("stats", quality.document_statistics(_table(spark, sf_dir, "documents")))
    model = quality.train(stats, _table(spark, sf_dir, "labels"), space)
    held_out = fold(F.col("doc_id"), quality.FOLDS) == quality.HELD_OUT
    return quality.quality_scores(stats, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return importance.resample(docs, target, Workspace(spark, "importance"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = vocabulary_path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip_digest(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    figures, _ = alignment.alignment(_table(spark, sf_dir, "documents"), *paths, Workspace(spark, "alignment"))
    return figures


QUERIES: dict[str, Query] = {
    "op1_hmm": op1_hmm,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_embeddings": op5_embeddings,
    "op6_packing": op6_packing,
    "op7_token_files": op7_token_files,
    "op8_line_chunks": op8_line_chunks,
    "op8_passages": op8_passages,
    "op9_mixing": op9_mixing,
    "op10_quality": op10_quality,
    "op11_importance": op11_importance,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_alignment": op13_alignment,
}
