"""Queries about noise that belongs to keys and about orders of graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import noise
from ..operators import ordering
from ..sources.tables import ship
from ..sources.views import FIELD, field, table
from .registry import query

SEED = 42
#: White noise below this degree, of variance 1.
DEGREES = 12


def _uniform(name: str) -> str:
    return f"((('0x' || substr(md5('{SEED}/' || member || '/' || step || '/' || event_id || '/{name}'), 1, {noise.DIGITS}))::BIGINT + 0.5) / {16**noise.DIGITS}.0)"


@query(f"WITH {FIELD} SELECT event_id, member, step, round(sqrt(-2 * ln({_uniform('radius')})) * cos(2 * pi() * {_uniform('angle')}), 6) + 0.0 AS noise FROM field")
def member_noise(spark, sf_dir):
    key = noise.key_of(SEED, F.col("member"), F.col("step"), F.col("event_id"))
    return field(spark, sf_dir).select("event_id", "member", "step", (F.round(noise.normal(key), 6) + 0.0).alias("noise"))


@query()
def isotropic_noise(spark, sf_dir):
    """One field a member and variable, read at the positions of the events."""
    ship(spark)
    rows, key = field(spark, sf_dir), noise.key_of(SEED, F.col("member"), F.col("variable"))
    return rows.select("event_id", "member", "variable", "lat", "lon", noise.isotropic(F.col("lat"), F.col("lon"), key, [1 / DEGREES] * DEGREES).alias("noise"))


def _supplied(spark, sf_dir):
    """Parts (even numbers) and their suppliers (odd numbers)."""
    return table(spark, sf_dir, "lineitem").select((F.col("l_partkey") * 2).alias("sender"), (F.col("l_suppkey") * 2 + 1).alias("receiver"))


@query()
def banded_nodes(spark, sf_dir):
    return ordering.banded_order(_supplied(spark, sf_dir))


@query()
def banded_edges(spark, sf_dir):
    edges = _supplied(spark, sf_dir)
    # Equal edges are counted where their senders meet, so edges move once for that and for the senders' positions.
    counts = edges.repartition("sender").groupBy("sender", "receiver").agg(F.count(F.lit(1)).alias("rows"))
    return ordering.renumbered(counts, ordering.banded_order(edges)).select("sender_position", "receiver_position", "rows")
