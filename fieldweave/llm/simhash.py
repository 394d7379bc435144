"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints that link differ in `radius` bits at most. Cut into radius + 2 pieces of bits, at least two pieces of such a
pair are equal; so every pair of pieces is a table of buckets, and a link shows in at least one of them. Exact copies are
one fingerprint before any comparison. Inside a task, blocks of fingerprints are held as bit planes (plane p: bit p of
each of them, 64 a word); one step per plane adds the mismatches of a block against many queries to carry-save counters,
and a block is abandoned as soon as all its counters are beyond the radius. Tasks return spanning forests, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import as_table, carried, ship_package

RADIUS, SHINGLE, SEED = 3, 3, 42
#: Rows of a bucket that are compared in one task; larger buckets are cut into chunks and each pair of chunks is a cell.
CELL_ROWS = 4096
_BLOCK = 256


def fingerprint(text: str | None, width: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text's word shingles, repeats included; 0 if it has no word."""
    words = (text or "").encode().lower().split()  # for bytes both touch ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(width, len(words))
    pairs = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in pairs), np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: Column | None = None) -> DataFrame:
    """doc_id and fp, the fingerprint as a long; with a column `digest` if one is given."""
    ship_package(docs.sparkSession)
    more = [] if digest is None else [digest.alias("digest")]
    return docs.select(F.col(doc_id).alias("doc_id"), F.pandas_udf(_fingerprints, "long").asNondeterministic()(F.col(text)).alias("fp"), *more)


def planes(fps: np.ndarray) -> np.ndarray:
    """[64, words] bit planes of a block; lanes beyond the block are 0."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    padded = np.zeros((64, -(-len(fps) // 64) * 64), np.uint8)
    padded[:, : len(fps)] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def within(queries: np.ndarray, block: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """[queries, block] boolean: which fingerprints (uint64) differ in `radius` bits at most."""
    lanes = planes(block)
    flips = np.where(np.unpackbits(queries.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T.astype(bool), np.uint64(2**64 - 1), np.uint64(0))
    alive_rows, width = np.arange(len(queries)), max(1, int(radius).bit_length())
    # Counters start so that the carry out of the last one is the first count beyond the radius.
    start = (1 << width) - 1 - radius
    shape = (len(queries), lanes.shape[1])
    counters = [np.full(shape, np.uint64(2**64 - 1) if start >> i & 1 else np.uint64(0)) for i in range(width)]
    beyond = np.zeros(shape, np.uint64)
    for p in range(64):
        carry = lanes[p][None, :] ^ flips[p][alive_rows][:, None]
        for i in range(width):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        beyond |= carry
        if p % 8 == 7:
            near = (~beyond).any(axis=1)
            if not near.any():
                return np.zeros((len(queries), len(block)), bool)
            if near.sum() * 2 < len(near):
                alive_rows, beyond, counters = alive_rows[near], beyond[near], [c[near] for c in counters]
    out = np.zeros((len(queries), len(block)), bool)
    out[alive_rows] = np.unpackbits((~beyond).view(np.uint8), axis=1, bitorder="little")[:, : len(block)].astype(bool)
    return out


def _forest(near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Tree links of the bipartite graph of a block pair: rows are 0.., columns follow them."""
    m, n = near.shape
    rows, cols, big = np.arange(m), np.arange(m, m + n), m + n
    while True:
        r = np.minimum(rows, np.where(near, cols[None, :], big).min(axis=1))
        c = np.minimum(cols, np.where(near, r[:, None], big).min(axis=0))
        if (r == rows).all() and (c == cols).all():
            break
        rows, cols = r, c
    labels = np.concatenate([rows, cols])
    for i in np.flatnonzero(labels != np.arange(m + n)).tolist():
        yield i, int(labels[i])


def _link_partition(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by cell; links as (fp, smaller fp of its tree)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    def link(cells: np.ndarray, fps: np.ndarray) -> None:
        same = cells[1:] == cells[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        cells, fps = cells[shared], fps[shared]
        for i in range(0, len(fps), _BLOCK):
            for j in range(i, len(fps), _BLOCK):
                if j > i and cells[j] != cells[min(i + _BLOCK, len(fps)) - 1]:
                    break
                a, b = fps[i : i + _BLOCK], fps[j : j + _BLOCK]
                near = within(a.view(np.uint64), b.view(np.uint64), radius)
                if i == j:
                    np.fill_diagonal(near, False)
                if near.any():
                    both = np.concatenate([a, b])
                    for x, y in _forest(near):
                        u, v = root(int(both[x])), root(int(both[y]))
                        if u != v:
                            parent[max(u, v)] = min(u, v)

    held_cells, held_fps = [], []
    for pdf in batches:
        cells, fps = pdf["cell"].to_numpy(), pdf["fp"].to_numpy()
        if not len(cells):
            continue
        cut = int(np.flatnonzero(cells == cells[-1])[0])
        if cut or (held_cells and held_cells[-1][-1] != cells[0]):
            link(np.concatenate([*held_cells, cells[:cut]]), np.concatenate([*held_fps, fps[:cut]]))
            held_cells, held_fps = [], []
        held_cells.append(cells[cut:])
        held_fps.append(fps[cut:])
    if held_cells:
        link(np.concatenate(held_cells), np.concatenate(held_fps))
    nodes = [x for x in parent if root(x) != x]
    yield pd.DataFrame({"u": np.array(nodes, np.int64), "v": np.array([root(x) for x in nodes], np.int64)})


def bucket_keys(fp: Column, radius: int = RADIUS) -> Column:
    """Array of the bucket keys of a fingerprint: one for each pair of its radius + 2 pieces."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    pieces = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.struct(F.lit(t).cast("int").alias("t"), F.shiftleft(pieces[i], edges[j + 1] - edges[j]).bitwiseOR(pieces[j]).alias("bits")) for t, (i, j) in enumerate(combinations(range(radius + 2), 2))])


def links(distinct_fps: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (u, v), u > v, whose components are those of all pairs of distinct fingerprints within the radius.

    Buckets over cell_rows rows are dealt into chunks by hash, and each pair of chunks is compared in a cell of its own:
    a row of a bucket of n rows is sent n / cell_rows times, so that no task ever holds more than two chunks."""
    rows = distinct_fps.select("fp", F.explode(bucket_keys(F.col("fp"), radius)).alias("k")).select("fp", "k.t", "k.bits")
    large = rows.groupBy("t", "bits").count().where(F.col("count") > cell_rows).select("t", "bits", F.ceil(F.col("count") / cell_rows).cast("int").alias("chunks"))
    dealt = rows.join(large, ["t", "bits"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.col("chunks")).cast("int")
    cells = dealt.withColumn("own", own).select(
        "fp", "t", "bits", "own", F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))).alias("other")
    )
    cells = cells.select(F.xxhash64("t", "bits", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "fp")
    dealt_out = cells.repartition("cell").sortWithinPartitions("cell")
    return dealt_out.mapInPandas(lambda batches: _link_partition(batches, radius), "u long, v long")


def _rooted(rows: DataFrame, radius: int, cell_rows: int) -> DataFrame:
    """fp, root (a fingerprint that names the component) and component_id of each fingerprint of a table with doc_id and fp."""
    reps = as_table(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct")
    roots = components(links(reps, radius, cell_rows))
    rooted = reps.join(roots, reps["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable over links).

    Null and empty texts and texts of white space have fingerprint 0 and are linked like any other; rows with equal ids
    keep a row each; a null id gets the component of its fingerprint, which no null id names unless it has no other. An
    empty table gives an empty result. A text of any length counts with all its shingles. Other columns are ignored."""
    rows = as_table(fingerprints(docs, doc_id, text), "fingerprints")
    return rows.join(_rooted(rows, radius, cell_rows), "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, all columns, one of each component of near_duplicates(): that with the smallest id.

    Of rows with this id the one whose text has the smallest hash stays, and of rows that repeat id and text a single one.
    A null id stays only where its component has no other. Null and empty texts are one component; an empty table gives
    an empty result. Other columns may have any names."""
    digest = lambda: F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = as_table(fingerprints(docs, doc_id, text, digest()), "fingerprints")
    own = rows.join(_rooted(rows, radius, cell_rows), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    least = own.groupBy("root", "doc_id", "digest").count().groupBy("root", "doc_id").agg(F.min(F.struct("digest", "count")).alias("least"))
    kept = as_table(least.select("doc_id", "least.*"), "representatives")
    whole = carried(docs, id=F.col(doc_id), digest=digest()).alias("d")
    out = whole.join(kept.drop("count").alias("k"), F.col("d.id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.digest") == F.col("k.digest")), "left_semi").select("row.*")
    return out.dropDuplicates([doc_id, text]) if kept.where("count > 1").limit(1).count() else out
