"""Queries of the training-data operators: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, divergence, lang_id, lattice_lm, mixing, packing, progressive_jpeg, resampling, simhash, topk, toxicity, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(_table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progressive_jpeg.digests(progressive_jpeg.stored(_table(spark, sf_dir, "documents")))


def op4_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages"))


def op5_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_dual_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op7_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_language_id, op2_simhash_near_dedup, op3_progressive_jpeg, op4_seekable_warc, op5_cost_balanced_packing, op6_dual_tree_top_k, op7_lattice_likelihood, op8_toxicity, op9_url_cascade, op10_mixing, op11_benchmark_decontamination, op12_source_divergence, op13_importance_resampling)
}

#: SimHash, JPEG, CRC-32, tokenization, fitted models and base-32 digests have no DuckDB form; their tests compare with brute force.
ORACLES: dict[str, str] = {
    "op6_dual_tree_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= 5
""",
    "op9_url_cascade": url_filter.ORACLE,
    "op10_mixing": mixing.ORACLE,
    "op11_benchmark_decontamination": decontamination.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
}
