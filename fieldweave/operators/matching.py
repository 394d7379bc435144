"""One-to-one matching of near fixes by auction: bids and prices in rounds of joins, exact in whole metres.

Fixes that may stay alone make the problem one-sided, so each side gets a copy: a fix bids for those near it or for its
own copy, which is worth nothing, and the copies bid the other way round. Everyone is then placed in the end, whatever
prices an earlier and coarser phase has left, and the last phase, whose bids rise by less than a metre for all bidders
together, leaves the least cost. Bidders lie in blocks. In a round each block places its free bidders at the prices
that it knows, by lists of near pairs and never by a matrix; then the highest bid for each object holds, and who was
outbid is free again.

Near pairs are made only as prices ask for them (see `pricing`), so their number grows with the fixes and not with its square.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import kept, ship
from .pricing import Places, best_pairs, missed, nearest
from .spheres import chord, cube, reached_cubes

#: Offers (two a near pair, two a fix) of a block of bidders; by how much a phase is finer than the one before.
BLOCK_OFFERS, FINER = 1 << 18, 8

_BID = "group long, kind int, id long, price long, by_kind int, by_id long"


def _phases(most: int) -> list[int]:
    """The least rises of bids from coarse to 1."""
    out = [1]
    while out[-1] * FINER < most:
        out.append(out[-1] * FINER)
    return out[::-1]


def _place(targets: list[np.ndarray], gains: list[np.ndarray], price: np.ndarray, owner: np.ndarray, free: list[int], rise: int) -> None:
    """Bidders take the object that is worth most to them, at the price at which the second best would do as well, until
    none of this block is free. owner: the bidder, -1 for none and -2 for one of another block."""
    while free:
        i = free.pop()
        worth = gains[i] - price[targets[i]]
        k = int(worth.argmax())
        best = worth[k]
        worth[k] = np.iinfo(np.int64).min
        at = targets[i][k]
        price[at] += rise + (best - worth.max() if len(worth) > 1 else 0)
        if owner[at] >= 0:
            free.append(int(owner[at]))
        owner[at] = i


class _Block:
    """The offers of some bidders as arrays."""

    def __init__(self, offers: pd.DataFrame, scale: int):
        offers = offers.sort_values(["by_kind", "by_id"], ignore_index=True)
        self.bidders = offers[["by_kind", "by_id"]].drop_duplicates(ignore_index=True)
        self.objects = offers[["kind", "id"]].drop_duplicates(ignore_index=True)
        place = pd.MultiIndex.from_frame(self.objects).get_indexer(pd.MultiIndex.from_frame(offers[["kind", "id"]]))
        ends = np.flatnonzero(np.append((offers["by_id"].to_numpy()[1:] != offers["by_id"].to_numpy()[:-1]) | (offers["by_kind"].to_numpy()[1:] != offers["by_kind"].to_numpy()[:-1]), True)) + 1
        self.targets, self.gains = np.split(place, ends[:-1]), np.split(offers["gain"].to_numpy(np.int64) * scale, ends[:-1])


def _alone(scale: int):
    def settled(offers: pd.DataFrame) -> pd.DataFrame:
        """All phases of a group whose offers are one block."""
        block = _Block(offers, scale)
        price = np.zeros(len(block.objects), np.int64)
        for rise in _phases(int(offers["gain"].max()) * scale):
            owner = np.full(len(block.objects), -1)
            _place(block.targets, block.gains, price, owner, list(range(len(block.bidders))), rise)
        taken = owner >= 0
        by = block.bidders.iloc[owner[taken]]
        return block.objects[taken].assign(group=offers["group"].iloc[0], price=price[taken], by_kind=by["by_kind"].to_numpy(), by_id=by["by_id"].to_numpy())[["group", "kind", "id", "price", "by_kind", "by_id"]]

    return settled


def _bidding(rise: int, scale: int):
    def bids(offers: pd.DataFrame, prices: pd.DataFrame) -> pd.DataFrame:
        """One block's bids of a round: what its objects cost now where that changed."""
        block = _Block(offers, scale)
        now = block.objects.merge(prices, on=["kind", "id"], how="left")
        price = now["price"].to_numpy(np.int64).copy()
        own = pd.MultiIndex.from_frame(block.bidders).get_indexer(pd.MultiIndex.from_frame(now[["by_kind", "by_id"]].fillna(-1).astype(np.int64)))
        owner = np.where(now["by_id"].isna(), -1, np.where(own < 0, -2, own))
        before = price.copy()
        _place(block.targets, block.gains, price, owner, sorted(set(range(len(block.bidders))) - set(own.tolist())), rise)
        new = price != before
        by = block.bidders.iloc[owner[new]]
        return block.objects[new].assign(group=offers["group"].iloc[0], price=price[new], by_kind=by["by_kind"].to_numpy(), by_id=by["by_id"].to_numpy())[["group", "kind", "id", "price", "by_kind", "by_id"]]

    return bids


def _in_rounds(offers: DataFrame, most: int, scale: int) -> DataFrame:
    """The phases of groups of many blocks: a round a job, until no block bids."""
    offers = offers.repartition("group", "block").persist(StorageLevel.DISK_ONLY)
    touched = kept(offers.select("group", "block", "kind", "id").distinct())
    objects = ["group", "kind", "id"]
    unknown = {"by_kind": F.lit(None).cast("int"), "by_id": F.lit(None).cast("long")}
    prices = kept(touched.select(*objects).distinct().withColumn("price", F.lit(0).cast("long")).withColumns(unknown))
    for rise in _phases(most * scale):
        prices = prices.withColumns(unknown)
        while True:
            sides = (offers.groupBy("group", "block"), touched.join(prices, objects).groupBy("group", "block"))
            bids = kept(sides[0].cogroup(sides[1]).applyInPandas(_bidding(rise, scale), _BID))
            if bids.isEmpty():
                break
            highest = F.max(F.struct("price", "by_kind", "by_id"))
            prices = kept(prices.unionByName(bids).groupBy(*objects).agg(highest.alias("_b")).select(*objects, "_b.*"))
    offers.unpersist()
    return prices


def _settled(pairs: DataFrame, most_m: int, block_offers: int) -> tuple[DataFrame, int]:
    """Who has which object, at which price, and by how much gains are scaled: above twice the bidders of any group."""
    ship(pairs.sparkSession)
    pairs = kept(pairs.select("group", "left", "right", (most_m - F.col("metres")).cast("long").alias("gain")))
    offer = lambda gain, kind, i, by_kind, by: pairs.select("group", F.lit(kind).alias("kind"), F.col(i).alias("id"), F.lit(by_kind).alias("by_kind"), F.col(by).alias("by_id"), gain.alias("gain"))
    alone = lambda kind, by_kind, i: offer(F.lit(0).cast("long"), kind, i, by_kind, i).distinct()
    # Bidders are lefts (0) and copies of rights (1), objects rights (0) and copies of lefts (1).
    gain = F.col("gain")
    offers = offer(gain, 0, "right", 0, "left").unionByName(offer(gain, 1, "left", 1, "right")).unionByName(alone(1, 0, "left")).unionByName(alone(0, 1, "right"))
    sizes = kept(offers.groupBy("group").agg(F.count(F.lit(1)).alias("offers"), F.count_distinct("by_kind", "by_id").alias("bidders"), F.max("gain").alias("gain")))
    is_large = F.col("offers") > block_offers
    bidders, most = sizes.agg(F.max("bidders"), F.max(F.when(is_large, F.col("gain")))).first()
    scale = 2 * (bidders or 0) + 1
    small = offers.join(sizes.where(~is_large).select("group"), "group", "left_semi")
    settled = small.groupBy("group").applyInPandas(_alone(scale), _BID)
    if most is not None:
        blocks = sizes.where(is_large).select("group", F.ceil(F.col("offers") / block_offers).cast("int").alias("blocks"))
        cut = offers.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("by_kind", "by_id"), F.col("blocks")).cast("int")).drop("blocks")
        settled = settled.unionByName(_in_rounds(cut, most, scale))
    return settled, scale


def _taken(settled: DataFrame) -> DataFrame:
    return settled.where("kind = 0 AND by_kind = 0").select("group", F.col("by_id").alias("left"), F.col("id").alias("right"))


def auction(pairs: DataFrame, most_m: int, block_offers: int = BLOCK_OFFERS) -> DataFrame:
    """group, left, right: one-to-one pairs of each group whose sum of (most_m - metres) is the greatest.

    pairs: group, left, right, metres (whole numbers, below most_m). A group of block_offers offers is settled by one task
    from its lists; larger ones are cut into blocks by hash and settled in rounds."""
    return _taken(_settled(pairs, most_m, block_offers)[0])


def _asking(most_km: float, scale: int | None):
    def pairs(_, here: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        """Of a cube's fixes, the nearest ones (no scale), or those that the prices u and v have missed."""
        i, j, gain = np.empty((3, 0), np.int64)
        if len(here) and len(there):
            left, right = (Places(t["lat"].to_numpy(), t["lon"].to_numpy()) for t in (here, there))
            i, j, gain = nearest(left, right, most_km) if scale is None else missed(left, right, here["u"].to_numpy(), there["v"].to_numpy(), scale, 1, most_km)[:3]
        group = (here if len(here) else there)["group"].iloc[0]
        return pd.DataFrame({"group": group, "left": here["id"].to_numpy()[i], "right": there["id"].to_numpy()[j], "metres": int(most_km * 1000) - gain})

    return pairs


def _asked(lefts: DataFrame, rights: DataFrame, most_km: float, block_offers: int) -> DataFrame:
    """matched_places of groups that no task holds: fixes meet in cubes of space, and the auction is held again with what its
    prices have missed until they have missed nothing."""
    side, by = max(2 * chord(most_km), 1e-3), ["group", "_cx", "_cy", "_cz"]
    here, there = kept(reached_cubes(lefts, side, most_km)), kept(rights.withColumns(cube(F.col("lat"), F.col("lon"), side)))
    met = lambda a, b, scale: a.groupBy(*by).cogroup(b.groupBy(*by)).applyInPandas(_asking(most_km, scale), "group long, left long, right long, metres long")
    pairs = kept(met(here, there, None).distinct())
    most_m = int(most_km * 1000)
    while True:
        settled, scale = _settled(pairs, most_m, block_offers)
        settled = kept(settled)
        price = lambda kind, i: settled.where(F.col("kind") == kind).select("group", F.col("id").alias(i), F.col("price").alias(f"_{i}"))
        gain = (most_m - F.col("metres")) * scale
        priced = pairs.join(price(1, "left"), ["group", "left"]).join(price(0, "right"), ["group", "right"])
        # A bidder's best offer and the price of its copy: never below 0, which is what staying alone is worth.
        dual = lambda i, other, name: priced.groupBy("group", F.col(i).alias("id")).agg(F.greatest(F.lit(0), F.max(gain - F.col(f"_{other}") + F.col(f"_{i}"))).cast("long").alias(name))
        known = lambda rows, i, other, name: rows.join(dual(i, other, name), ["group", "id"], "left").fillna(0, [name])
        more = kept(met(known(here, "left", "right", "u"), known(there, "right", "left", "v"), scale))
        if more.isEmpty():
            return _taken(settled)
        pairs = kept(pairs.unionByName(more).distinct())


def matched_places(lefts: DataFrame, rights: DataFrame, most_km: float, block: int) -> DataFrame:
    """group, left, right: one-to-one pairs of each group's fixes, nearer than most_km, whose sum of (most_km - km), in whole
    metres, is the greatest. lefts, rights: group, id (whole numbers), lat, lon. A group of up to `block` fixes is settled by
    one task, which holds its fixes and the pairs that prices ask for; of larger ones a task holds a cube or a block."""
    spark = lefts.sparkSession
    ship(spark)
    sides = lefts.withColumn("_right", F.lit(False)).unionByName(rights.withColumn("_right", F.lit(True)))
    sizes = kept(sides.groupBy("group").agg(F.count(F.lit(1)).alias("fixes")))
    large = sizes.where(F.col("fixes") > block).select("group")

    def settled(fixes: pd.DataFrame) -> pd.DataFrame:
        fixes = fixes.sort_values("id")  # ties fall the same way in each run
        left, right = fixes[~fixes["_right"]], fixes[fixes["_right"]]
        i, j = best_pairs(*(t[c].to_numpy() for t in (left, right) for c in ("lat", "lon")), most_km)
        return pd.DataFrame({"group": fixes["group"].iloc[0], "left": left["id"].to_numpy()[i], "right": right["id"].to_numpy()[j]})

    # Few bytes, much work: a given number of partitions, as adaptive execution would leave them to few tasks; by range, as hashes
    # would give one task many groups and others none.
    parts = min(sizes.count(), max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism))
    out = sides.join(large, "group", "left_anti").repartitionByRange(max(parts, 1), "group").groupBy("group").applyInPandas(settled, "group long, left long, right long")
    if large.isEmpty():
        return out
    of = lambda rows: rows.join(large, "group", "left_semi")
    return out.unionByName(_asked(of(lefts), of(rights), most_km, block))
