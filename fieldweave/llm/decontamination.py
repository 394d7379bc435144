"""Benchmark decontamination, with DataFrame functions only.

The n-grams of the benchmark's items (an item of fewer words is one n-gram) are a hash set that is broadcast. Documents
are scanned word by word: each n-gram is entered under its longest word, its anchor, so that only windows around a word
that is some n-gram's anchor are spelled out, looked up and compared with the n-gram's text. A set above SET_BYTES is
dealt into shards by hash, and the scan looks into each of them, so that no broadcast grows with the benchmark.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_table

#: What lies between words of a text whose A-Z are lower-cased, and of one as it is.
BETWEEN, BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Words of a window; bytes of one broadcast shard of n-grams, counted with ROW_BYTES for each.
WINDOW, SET_BYTES, ROW_BYTES = 10, 32 << 20, 64


def words(text: Column) -> Column:
    """The words of a text (null: none), A-Z lower-cased."""
    lower = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lower, f"{BETWEEN}+"), "")


def windows(benchmark: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item, gram, length, anchor, offset: the distinct n-grams of each item, the longest word of each and its place in it."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    placed = items.select("item", "words", length.alias("length"), F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("first"))
    cut = placed.select("item", "length", F.slice("words", "first", "length").alias("cut"))
    sizes = F.transform("cut", F.length)
    at = F.array_position(sizes, F.array_max(sizes)).cast("int")
    return cut.select("item", F.array_join("cut", " ").alias("gram"), "length", F.element_at("cut", at).alias("anchor"), (at - 1).alias("offset")).distinct()


def shards(found: DataFrame, most: int = SET_BYTES) -> int:
    """In how many shards the windows of a benchmark are looked up."""
    size = found.agg(F.sum(F.octet_length("gram") + F.octet_length("item") + F.octet_length("anchor") + ROW_BYTES)).first()[0]
    return -(-(size or 0) // most) or 1


def _scan(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """row, start, length, gram of each place where a text (row, words joined by spaces) holds one of the n-grams."""
    anchors = grams.groupBy("anchor").agg(F.collect_set(F.struct("offset", "length")).alias("probes"))  # a few dozen at most
    spread = texts.select("row", F.split("words", " ").alias("words")).select("row", "words", F.posexplode("words").alias("place", "anchor"))
    near = spread.join(F.broadcast(anchors), "anchor").select("row", "words", "place", F.inline("probes"))
    start = F.col("place") - F.col("offset")
    inside = near.where((start >= 0) & (start + F.col("length") <= F.size("words")))
    spelled = inside.select("row", start.alias("start"), "length", "offset", F.array_join(F.slice("words", start + 1, F.col("length")), " ").alias("gram"))
    return spelled.join(F.broadcast(grams.select("gram", "offset")), ["gram", "offset"]).select("row", "start", "length", "gram")


def hits(texts: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    """The scan of all shards; each occurrence is found once, by the anchor of its own n-gram."""
    grams = found.select("gram", "length", "anchor", "offset").distinct()
    return reduce(DataFrame.unionByName, [_scan(texts, grams.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == k)) for k in range(parts)])


def items_of(places: DataFrame, found: DataFrame, parts: int) -> DataFrame:
    """row and item of each item that has a window in a row's text."""
    met, pairs = places.select("row", "gram").distinct(), found.select("gram", "item")
    some = [met.join(F.broadcast(pairs.where(F.pmod(F.xxhash64("gram", "item"), F.lit(parts)) == k)), "gram") for k in range(parts)]
    return reduce(DataFrame.unionByName, some).select("row", "item").distinct()


def spans(places: DataFrame) -> DataFrame:
    """row, start, end (exclusive) of the words that occurrences cover, overlapping ones made one."""
    ends = places.select("row", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    by = W.partitionBy("row").orderBy("start", "end")
    fresh = F.coalesce(F.col("start") > F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(True))
    island = F.sum(F.col("fresh").cast("int")).over(by.rowsBetween(W.unboundedPreceding, 0))
    return ends.withColumn("fresh", fresh).withColumn("island", island).groupBy("row", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


class Scanned:
    """Documents and a benchmark: a table of the rows with their words, one of the occurrences, and what derives from both.

    Rows get a number of their own when the table is written, so ids may repeat or be null. Null texts have no words."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int, most: int, text: str, item_id: str, item_text: str):
        self.columns = keep
        cut = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), words(F.col(text)).alias("words"))
        self.rows = as_table(cut.select(F.monotonically_increasing_id().alias("row"), "kept", F.size("words").cast("long").alias("n_words"), F.array_join("words", " ").alias("words")), "rows")
        self.found = as_table(windows(benchmark, window, item_id, item_text), "windows")
        self.parts = shards(self.found, most)
        self.places = as_table(hits(self.rows.where("n_words > 0"), self.found, self.parts), "places")


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = SET_BYTES, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document.

    Null, empty and wordless texts have no words and no hits, and such items no windows; texts of any length are scanned
    whole; rows with equal ids keep a row each. Rows of the benchmark that share an id are one item, and those without an
    id are one item whose name is empty. An empty benchmark finds nothing, an empty table gives an empty result; other
    columns are ignored. `most` changes in how many shards n-grams are looked up, not the result."""
    s = Scanned(docs, benchmark, [doc_id], window, most, text, item_id, item_text)
    hit = spans(s.places).groupBy("row").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"))
    names = F.array_join(F.array_sort(F.collect_list("item")), ",")
    items = items_of(s.places, s.found, s.parts).groupBy("row").agg(F.count("item").alias("n_items"), F.sha2(names, 256).alias("items_sha256"))
    out = s.rows.select("row", F.col(f"kept.`{doc_id}`").alias("doc_id"), "n_words").join(hit.join(items, "row"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def without_documents(docs: DataFrame, benchmark: DataFrame, least_share: float = 0.0, window: int = WINDOW, most: int = SET_BYTES, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without those of whose words occurrences cover more than least_share. Columns may have any names; rows that
    repeat are judged alike; awkward rows are as in `report`, and rows without words stay."""
    s = Scanned(docs, benchmark, docs.columns, window, most, text, item_id, item_text)
    hit = spans(s.places).groupBy("row").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"))
    out = s.rows.join(hit, "row", "left")
    return out.where(F.coalesce("n_hit", F.lit(0)) <= F.col("n_words") * least_share).select("kept.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: int = SET_BYTES, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs whose texts lack the words that occurrences cover, and what follows each of them up to the next word.

    Everything else stays as it was, letter by letter. Columns may have any names; awkward rows are as in `report`."""
    s = Scanned(docs, benchmark, docs.columns, window, most, text, item_id, item_text)
    by_row = spans(s.places).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))  # within one text
    whole = F.col(f"kept.`{text}`")
    pieces = F.regexp_extract_all(whole, F.lit(f"[^{BETWEEN_ANY_CASE[1:-1]}]+{BETWEEN_ANY_CASE}*"), F.lit(0))
    gaps = F.arrays_zip(F.concat(F.array(F.lit(0)), F.col("spans.end")).alias("from"), F.concat(F.col("spans.start"), F.array(F.size("pieces"))).alias("upto"))
    rest = F.array_join(F.transform("gaps", lambda g: F.array_join(F.slice("pieces", g["from"] + 1, g["upto"] - g["from"]), "")), "")
    cut = s.rows.select("row", "kept").join(by_row, "row", "left")
    cut = cut.withColumn("pieces", F.when(F.col("spans").isNotNull(), pieces)).withColumn("gaps", gaps)
    clean = F.when(F.col("spans").isNull(), whole).otherwise(F.concat(F.regexp_extract(whole, f"^{BETWEEN_ANY_CASE}*", 0), rest))
    return cut.select(*[(clean if c == text else F.col(f"kept.`{c}`")).alias(c) for c in docs.columns])


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (SELECT DISTINCT item, least(len(w), 10) AS length, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT length FROM grams),
places AS (SELECT row, length, unnest(range(1, len(w) - length + 2)) AS i, w FROM d, lengths WHERE len(w) >= length),
met AS (SELECT row, i, p.length, item FROM (SELECT row, i, length, array_to_string(w[i:i + length - 1], ' ') AS gram FROM places) p JOIN grams g ON p.gram = g.gram AND p.length = g.length),
hit AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + length)) AS j FROM met) GROUP BY row),
items AS (SELECT row, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT row, item FROM met) GROUP BY row)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row) LEFT JOIN items USING (row)
"""
