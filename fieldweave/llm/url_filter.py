"""Exact host lists as a Bloom filter cascade, with DataFrame functions only.

The keys in question are known beforehand: the hosts of the corpus. Level 1 is a Bloom filter of the listed keys; level 2
one of the unlisted keys that level 1 lets through; level 3 one of the listed keys that level 2 lets through, and so on
until none is left. A key of the corpus is then listed if and only if the first level that does not contain it is an even
one. Filters are built by bitmap_construct_agg, so that a task sends 4 KiB per bitmap at most, and are applied as binary
literals: judging a url needs no join.

Literals are bounded: keys are dealt into shards by hash, as many as the listed keys need so that a shard's levels take about
SHARD_BITS, and each shard has a cascade of its own. Rows are judged shard by shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_table, fresh_path

#: (verdict, host, path) of the rules; a rule fits its host and all subdomains.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
#: Hosts with one of these in their name are the listed keys of the query.
LISTED_TERMS = ("casino", "bets", "pills", "ads-", "spam", "adult")
BITS_PER_KEY, HASHES = 8, 5
#: Bits of a shard's levels, on average (32 MiB of literals): a level takes BITS_PER_KEY a key, and levels shrink fast.
SHARD_BITS = 1 << 28
_BITMAP = 32768  # bits of one bitmap of bitmap_construct_agg


@dataclass(frozen=True)
class Level:
    seed: int
    bits: int
    data: bytes

    def contains(self, key: Column) -> Column:
        found = F.lit(True)
        for pos in _positions(key, self.seed, self.bits):
            byte = F.conv(F.hex(F.substring(F.lit(self.data), (pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            found = found & (F.getbit(byte, (pos % 8).cast("int")) == 1)
        return found


def _positions(key: Column, seed: int, bits: int) -> list[Column]:
    """Double hashing: HASHES bit positions of a key."""
    first, step = F.pmod(F.xxhash64(F.lit(2 * seed), key), F.lit(bits)), F.pmod(F.xxhash64(F.lit(2 * seed + 1), key), F.lit(bits - 1)) + 1
    return [F.pmod(first + i * step, F.lit(bits)) for i in range(HASHES)]


def _size(keys: int) -> int:
    return max(1, -(-keys * BITS_PER_KEY // _BITMAP)) * _BITMAP


def _level(keys: DataFrame, seed: int, n: int) -> Level:
    bits = _size(n)
    spots = keys.select(F.explode(F.array(*_positions(F.col("key"), seed, bits))).alias("pos"))
    maps = spots.groupBy((F.col("pos") / _BITMAP).cast("long").alias("at")).agg(F.bitmap_construct_agg(F.col("pos") % _BITMAP).alias("bitmap")).collect()
    data = bytearray(bits // 8)
    for row in maps:  # bits / 32768 rows of 4 KiB, as SHARD_BITS bounds them
        data[row["at"] * _BITMAP // 8 : row["at"] * _BITMAP // 8 + len(row["bitmap"])] = row["bitmap"]
    return Level(seed, bits, bytes(data))


def build_cascade(universe: DataFrame) -> list[Level]:
    """Levels for a table of distinct keys (key, listed boolean), a shard's or all."""
    levels: list[Level] = []
    include, exclude = universe.where("listed").select("key"), universe.where("NOT listed").select("key")
    while (n := include.count()) > 0:
        levels.append(level := _level(include, len(levels), n))
        include, exclude = as_table(exclude.where(level.contains(F.col("key"))), f"level{len(levels)}"), include
    return levels


def shards(listed_keys: int, shard_bits: int = SHARD_BITS) -> int:
    return max(1, -(-2 * listed_keys * BITS_PER_KEY // shard_bits))


def shard_of(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(n)).cast("int")


def listed(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    out = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        out = F.when(~levels[i].contains(key), F.lit(i % 2 == 1)).otherwise(out)
    return out


def host_of(url: Column) -> Column:
    raw = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, ties to the first by name; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, is_listed: Column | None = None, rules=RULES, page_id: str = "page_id", url: str = "url", shard_bits: int = SHARD_BITS, hosts: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every url: the longest fitting rule's verdict, else block for listed hosts.

    The listed hosts are a table with a column `host`, or those that meet is_listed, a condition on the column `host`.
    Either is asked once per distinct host of the corpus, and the cascade carries the answers to the rows. A null url or
    one without "://" has an empty host and path, fits no rule, and is judged as the empty host. Urls of any length are
    read whole. Repeated rows keep a row each; an empty table gives an empty result; other columns are ignored, whatever
    their names."""
    if is_listed is None:
        is_listed = F.lit(False)
        for term in LISTED_TERMS:
            is_listed = is_listed | F.contains(F.col("host"), F.lit(term))
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    keys = rows.select("host").distinct()
    if hosts is None:
        keys = keys.select(F.col("host").alias("key"), F.coalesce(is_listed, F.lit(False)).alias("listed"))
    else:
        known = hosts.select(F.col("host").alias("key")).distinct().withColumn("listed", F.lit(True))
        keys = keys.withColumnRenamed("host", "key").join(known, "key", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    universe = as_table(keys, "hosts")
    n = shards(universe.where("listed").count(), shard_bits)
    if n == 1:
        return _judged(rows, build_cascade(universe), rules)
    universe = as_table(universe.withColumn("shard", shard_of(F.col("key"), n)), "sharded_hosts", by="shard")
    dealt = as_table(rows.withColumn("shard", shard_of(F.col("host"), n)), "sharded_rows", by="shard")
    path, spark = fresh_path(pages.sparkSession, "judged"), pages.sparkSession
    for shard in range(n):  # a job's literals are those of one shard, and it reads the rows of this shard alone
        out = _judged(dealt.where(F.col("shard") == shard), build_cascade(universe.where(F.col("shard") == shard)), rules)
        out.write.mode("append").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def _judged(rows: DataFrame, levels: list[Level], rules) -> DataFrame:
    found = rule_of(F.col("host"), F.col("path"), rules)
    otherwise = F.when(listed(levels, F.col("host")), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", found["rule"].alias("rule"), F.coalesce(found["verdict"], otherwise).alias("verdict"))


ORACLE = """
WITH parsed AS (SELECT page_id,
  translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules AS (SELECT * FROM (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')) t(verdict, rhost, rpath)),
judged AS (SELECT page_id, host, path,
  (SELECT max_by({'rule': rhost || rpath, 'verdict': verdict}, length(rhost || rpath)) FROM rules
   WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS r FROM parsed)
SELECT page_id, host, path, r.rule AS rule,
  coalesce(r.verdict, CASE WHEN regexp_matches(host, 'casino|bets|pills|ads-|spam|adult') THEN 'block' ELSE 'allow' END) AS verdict FROM judged
"""
