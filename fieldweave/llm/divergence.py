"""How the sources of a language differ in their words.

bytes.translate lowers letters and turns whatever separates terms into spaces in one pass, bytes.split gives the terms
and a Counter a document their frequencies. A task sums them by language, source and term and sends one row a term with
the sources it met, so the shuffle carries sums alone. Shares of terms are compared in blocks of terms that are dealt by
hash: a block holds a bounded part of a language's vocabulary, and only sums a pair of sources and the ten first terms
a source leave it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_table, ship_package

LEAST_DOCS, MOST_TERMS = 10, 10
#: Shares are in units of one in SCALE.
SCALE = 1_000_000_000
#: Counts that a task holds before it sends them; counts of a block of terms; sources that are compared with the others at once; cells of a dense matrix.
HELD, BLOCK_COUNTS, BLOCK_SOURCES, CELLS = 600_000, 1 << 19, 1000, 1 << 20
#: Blocks of a language at least, so that tasks stay even.
LEAST_BLOCKS = 16

#: A task's count of a term: occurrences, and this for each document.
_DOCUMENT = 1 << 36
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LETTERS).split()


def _sums(counts: dict[tuple[str, str], dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
    """One row a (language, term): the sources that hold it, occurrences and documents there."""
    by_lang: dict[str, list] = {}
    for (lang, source), found in counts.items():
        by_lang.setdefault(lang, []).append((source, found))
    for lang, groups in by_lang.items():
        terms = pa.array([t for _, found in groups for t in found], pa.binary()).dictionary_encode()
        packed = np.fromiter((n for _, found in groups for n in found.values()), np.int64, len(terms))
        source = np.repeat(np.arange(len(groups)), [len(found) for _, found in groups])
        order = np.argsort(terms.indices.to_numpy(), kind="stable")
        offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(terms.indices.to_numpy(), minlength=len(terms.dictionary)))]).astype(np.int32))
        parts = (pa.array([s for s, _ in groups], pa.string()).take(pa.array(source[order])), pa.array(packed[order] % _DOCUMENT), pa.array(packed[order] // _DOCUMENT))
        names = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(terms.dictionary), np.int64)))
        yield pa.RecordBatch.from_arrays([names, terms.dictionary.cast(pa.string()), *[pa.ListArray.from_arrays(offsets, p) for p in parts]], ["lang", "term", "sources", "ns", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], dict[bytes, int]] = {}
    held = 0
    for batch in batches:
        for lang, source, text in zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "text")], strict=True):
            found = counts.setdefault((lang, source), {})
            held -= len(found)
            seen = found.get
            for term, n in Counter(terms_of(text)).items():
                found[term] = seen(term, 0) + n + _DOCUMENT
            held += len(found)
            if held > HELD:
                yield from _sums(counts)
                counts, held = {}, 0
    yield from _sums(counts)


def vocabulary(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, term, source, n, lang_n of the terms that at least least_docs documents of a language hold: occurrences in the
    source (above 0) and in the language. Terms are grouped where they land; nothing is shuffled twice."""
    sent = docs.select("lang", "source", "text").mapInArrow(_counted, "lang string, term string, sources array<string>, ns array<long>, docs array<long>")
    apart = sent.repartition("lang", "term").select("lang", "term", F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("ns").alias("n"), F.col("docs").alias("docs"))))
    per = apart.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_lang = W.partitionBy("lang", "term")
    whole = per.select("lang", "term", "source", "n", F.sum("n").over(of_lang).alias("lang_n"), F.sum("docs").over(of_lang).alias("lang_docs"))
    return whole.where(F.col("lang_docs") >= least_docs).drop("lang_docs")


def _shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), exactly."""
    if counts.size and int(counts.max()) + 2 > (2**63 - 1) // SCALE:
        return (1 + SCALE * (counts.astype(object) + 2) // totals.astype(object)).astype(np.int64)
    return 1 + SCALE * (counts + 2) // totals


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _compared(key: tuple, terms: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums a pair of sources and the first terms a source, of one block of terms and one block of sources."""
    lang, _, some = key
    groups = groups.sort_values("source", ignore_index=True)
    names, n = groups["source"], len(groups)
    own = np.arange(n)[some * BLOCK_SOURCES : (some + 1) * BLOCK_SOURCES]
    totals = groups["total"].to_numpy() + 2 * groups["v"].to_numpy()
    sums = np.zeros((len(own), n), np.int64)
    first = []
    if len(terms):
        place = pd.Series(np.arange(n), names)[terms["source"]].to_numpy()
        count = terms["n"].to_numpy()
        share = _shares(count, totals[place])
        rest = _shares(np.zeros(n, np.int64), totals)  # of a term that a source lacks
        term, spelled = pd.factorize(terms["term"])
        lang_total = np.full(len(terms), groups["lang_total"].iloc[0] + 2 * groups["v"].iloc[0])
        q = _shares(terms["lang_n"].to_numpy(), lang_total)
        order = np.argsort(term, kind="stable")
        step = max(1, CELLS // n)
        bounds = np.searchsorted(term[order], np.arange(0, len(spelled) + step, step))
        for block, (a, b) in enumerate(zip(bounds, bounds[1:])):
            rows = order[a:b]
            dense = np.broadcast_to(rest, (min(step, len(spelled) - block * step), n)).copy()
            dense[term[rows] - block * step, place[rows]] = share[rows]
            for i, source in enumerate(own):
                sums[i] += _gap(dense, dense[:, source : source + 1]).sum(axis=0)
        above = (share > q) & (place // BLOCK_SOURCES == some)
        over = terms.loc[above, ["source", "term"]].assign(value=_gap(share, q)[above], spelled=[t.encode() for t in terms.loc[above, "term"]])
        first = over.sort_values(["value", "spelled"], ascending=[False, True]).groupby("source").head(MOST_TERMS)
    a, b = np.nonzero(own[:, None] != np.arange(n)[None, :])
    pairs = pd.DataFrame({"source": names.to_numpy()[own[a]], "part": "pair", "item": names.to_numpy()[b], "value": sums[a, b]})
    out = pd.concat([pairs, first.rename(columns={"term": "item"}).assign(part="term")[list(pairs)]]) if len(first) else pairs
    return out.assign(lang=lang)[["lang", "source", "part", "item", "value"]]


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, block_counts: int = BLOCK_COUNTS, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: how far each other source of the language is (`pair`), and the terms that a
    source has more often than its language (`term`, ten at most).

    Null lang, source and text are ''. A group without terms has every kept term zero times; a language that keeps no term
    has pairs of value 0 and no terms; one of a single source has no pairs. Texts of any length are counted whole; repeated
    rows count as often as they stand there; ties go to the smaller name in UTF-8; an empty table gives an empty result;
    other columns are ignored. block_counts changes how terms are dealt to tasks, not the result."""
    ship_package(docs.sparkSession)
    plain = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    counts = as_table(vocabulary(plain, least_docs), "counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count("term").alias("v"))
    of_lang = W.partitionBy("lang")
    groups = plain.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total"])
    groups = groups.withColumn("lang_total", F.sum("total").over(of_lang)).join(sizes, "lang", "left").fillna(0, ["v"])
    groups = as_table(groups.withColumn("sources", F.count("source").over(of_lang)), "groups")
    blocks = max(LEAST_BLOCKS, -(-counts.count() // block_counts))
    parts = -(-(groups.agg(F.max("sources")).first()[0] or 0) // BLOCK_SOURCES) or 1
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spread = groups.drop("sources").withColumn("block", upto(blocks)).withColumn("some", upto(parts))
    placed = counts.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")).withColumn("some", upto(parts))
    by = ["lang", "block", "some"]
    found = placed.groupBy(*by).cogroup(spread.groupBy(*by)).applyInPandas(_compared, "lang string, source string, part string, item string, value long")
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return summed.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= MOST_TERMS))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
counts AS (SELECT t.lang, t.source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT g.lang, g.source, coalesce(any_value(c.total), 0) AS total, (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v, (SELECT coalesce(sum(n), 0) FROM kept k WHERE k.lang = g.lang) AS lang_total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)::HUGEINT) // (g.total + 2 * g.v) AS p,
    1 + (1000000000 * (k.n + 2)::HUGEINT) // (g.lang_total + 2 * g.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM rows
QUALIFY part = 'pair' OR rank <= 10
"""
