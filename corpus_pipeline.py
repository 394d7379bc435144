"""A corpus pipeline of five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldweave.llm import lang_id, mixing, packing, simhash, toxicity
from fieldweave.llm.common import WORD, as_table, carried

#: A language is rejected if its probability is not above that of a fair draw among all languages by this factor.
LEAST_LANGUAGE_LEAD = 1.1


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (null and empty ones among them) and those whose language the network cannot tell.

    A text of any length is judged by all its windows. Repeated rows and null ids are judged row by row; without any labelled
    language nothing can be told and nothing stays; an empty table stays empty. Other columns may have any names."""
    network = lang_id.train(docs)
    found, least = lang_id.identifier(network), LEAST_LANGUAGE_LEAD / max(1, len(network.languages))
    judged = carried(docs, found=found(F.col("text")))
    told = (F.col("found.score") >= least) | F.lit(len(network.languages) < 2)
    return judged.where((F.col("found.lang_pred") != lang_id.UNDETERMINED) & told).select("row.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic, by all words of texts of any length. Null and empty texts score low; without labels
    of both kinds all rows stay. Repeated rows and null ids are judged row by row, an empty table stays empty, and other
    columns may have any names."""
    score = toxicity.scorer(toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return carried(docs, score=score(F.col("text"))).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near duplicates, that with the smallest id; repeated rows are one document.

    Null and empty texts are one component, a null id stays only where its component has no other, texts of any length
    count whole, an empty table stays empty, and other columns may have any names."""
    return simhash.representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents as the mix takes them; one that it takes in part stays if at least half of it is taken.

    Documents without words, null texts among them, have no tokens to take and go; texts of any length count whole. Rows that
    share an id, or have none, are repeated as often as the one of them that is taken most. An empty table stays empty, and
    other columns may have any names."""
    copies = mixing.mix(docs).where("size > 0").groupBy("doc_id").agg(F.max(F.round(F.col("taken") / F.col("size"))).cast("int").alias("copies")).where("copies > 0")
    whole = carried(docs, id=F.col("doc_id")).where(F.regexp_count("row.text", F.lit(WORD)) > 0)
    met = whole.join(copies, F.col("id").eqNullSafe(F.col("doc_id")))
    return met.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces and sequences of the documents that are left, texts of any length whole. Null and empty texts are their end
    alone; rows that share an id, or have none, are documents of their own; an empty table gives no piece."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("toxicity", toxic),
    ("near_dedup", near_dedup),
    ("mixing", mixed),
    ("packing", packed),
]

#: Fitted models and tokenization have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents, each on all that the one before it kept; an empty table gives an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = as_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
