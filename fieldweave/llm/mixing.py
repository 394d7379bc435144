"""Mixing sources to target weights, with DataFrame functions only.

Every document gets a hash-random key; within its source the keys define a random order. Prefix sums of the sizes along
that order say where a source's budget is spent. They are computed in two distributed levels: the key's range (its
leading hex digits) is a bucket, buckets are summed before any row moves, the bucket sums give each bucket its offset,
and a window inside (source, bucket) gives the rest. So a source that holds a third of all rows is spread over all
buckets, and the only rows that meet by source alone are the bucket sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, as_table

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its own size.
MOST_EPOCHS = 3
#: Hex digits of the key that make a bucket, at least, and rows of a bucket of the largest source, at most: 16 ** 3 ranges in each source, or more.
BUCKET_DIGITS, BUCKET_ROWS = 3, 1 << 18


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size in words (null text: 0) and the hash-random key."""
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit("")).cast("binary")).alias("key"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row a source: its size, weight and target.

    The targets share the sum of all sizes by weight; none exceeds most_epochs times its source, and what is cut off goes
    to the others by weight. That is least(most * size, level * weight) for the one level at which the targets add up;
    sources in ascending order of most * size / weight are cut until the level of the rest stays under their own limit.
    Both windows run over one row a source."""
    per_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double"))
    cap = (F.col("source_size") * most_epochs).cast("double")
    everything, before = W.partitionBy(), W.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    ranked = weighed.withColumn("ratio", cap / F.col("weight"))
    levels = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))
    level = F.coalesce(F.min_by("level", fits).over(everything), F.lit(0.0))
    return levels.withColumn("target", F.least(cap, level * F.col("weight"))).select("source", "source_size", "weight", "target")


def bucket_digits(rows: int) -> int:
    """Digits of a bucket for so many rows; they change how prefix sums are cut into tasks, not their values."""
    digits = BUCKET_DIGITS
    while rows >> 4 * digits > BUCKET_ROWS:
        digits += 1
    return digits


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken: how many words of each document the mix takes.

    A source's budget is its target rounded to a word. Whole epochs take every document; the rest of the budget is cut at
    the prefix sums, exactly, so that one document a source is taken in part.

    Null text and texts without words have size 0 and nothing taken; a text of any length counts whole; a null source is a
    source of its own, the last; rows with equal ids keep a row each, ordered by size, and meet as counts of equal
    sizes; rows without an id are spread by their texts; an empty table gives an empty result. Other columns are ignored."""
    # Rows that repeat an id, or a text without an id, have one place in the order: they are counted, and told apart at the end.
    same = sized(docs, doc_id, text, source).groupBy("doc_id", "source", "size", "key").agg(F.count(F.lit(1)).alias("copies"))
    rows = as_table(same, "sizes")
    digits = bucket_digits(rows.count())
    rows = rows.withColumn("bucket", F.substring("key", 1, digits))
    goals = targets(rows, weights, most_epochs)
    sums = rows.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("bucket_size"))
    offsets = sums.withColumn(
        "offset", F.coalesce(F.sum("bucket_size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), "offset")
    goals = goals.select(F.col("source").alias("g_source"), "source_size", "target")
    buckets = offsets.join(goals, F.col("b_source").eqNullSafe(F.col("g_source"))).drop("g_source")
    inside = W.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = rows.withColumn("upto", F.sum(F.col("size") * F.col("copies")).over(inside)).join(buckets, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")).cast("long")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    before = F.col("offset") + F.col("upto") - F.col("size") * (F.col("copies") - F.col("copy") + 1)
    taken = epochs * F.col("size") + F.least(F.greatest(rest - before, F.lit(0)), F.col("size"))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


ORACLE = """
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size, md5(doc_id::VARCHAR) AS key FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM per),
ranked AS (SELECT *, (source_size * 3)::DOUBLE AS cap, (source_size * 3)::DOUBLE / weight AS ratio FROM weighed),
levels AS (SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM ranked WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (SELECT source, source_size, least(cap, weight * (SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio)) AS target FROM levels),
placed AS (SELECT doc_id, s.source, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
  (sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM placed)
SELECT doc_id, source, size, source_size, target,
  (epochs * size + least(greatest(budget - epochs * source_size - before, 0), size))::BIGINT AS taken FROM cut
"""
