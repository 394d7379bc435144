"""Importance resampling towards a target: hashed word and word-pair features, gains of buckets, and draws without replacement.

A feature's bucket is its CRC-32. The head of the vocabulary is broadcast: frequent words with the states of their CRC,
from which the CRC of a pair goes on, and frequent pairs with their buckets. What the head does not hold takes its CRC
directly, so the head decides where a feature is looked up and never its bucket. Buckets of all features of all
documents are counted exactly; noise that belongs to the id turns weights into scores, and the highest are drawn.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import as_table, ship_package

BUCKETS, LEAST_WORDS, SHARE = 10_000, 20, 25
#: Words and pairs of the head, at most, and the bytes of such a word.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 1 << 16, 1 << 17, 64
#: Pairs that a task counts before it sends its most frequent words and pairs, and how many of them; words whose features are computed at once.
HELD, SENT_WORDS, SENT_PAIRS, TOGETHER = 400_000, 8_000, 16_000, 200_000

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SLOT_BITS = 20


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


def _frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words, pairs = Counter(), Counter()

    def sent() -> pd.DataFrame:
        rows = [(w, None, n) for w, n in words.most_common(SENT_WORDS)] + [(a, b, n) for (a, b), n in pairs.most_common(SENT_PAIRS)]
        words.clear()
        pairs.clear()
        return pd.DataFrame([r for r in rows if len(r[0]) <= HEAD_BYTES and len(r[1] or b"") <= HEAD_BYTES], columns=["word", "next", "n"])

    for pdf in batches:
        for text in pdf["text"]:
            here = words_of(text)
            words.update(here)
            pairs.update(zip(here, here[1:]))
            if len(pairs) > HELD:
                yield sent()
    yield sent()


class Head:
    """Frequent words with the states of their CRC, and frequent pairs of them with their buckets.

    Pairs lie in a table of slots, the more frequent one where two meet."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int = BUCKETS):
        self.buckets = buckets
        self.place = {w: i for i, w in enumerate(words)}
        self.states = np.array([crc32(w) for w in words] + [0], np.int64)
        self.keys = np.full(1 << _SLOT_BITS, -1)
        self.found = np.zeros(1 << _SLOT_BITS, np.uint16)
        both = [(self.place[a], self.place[b], crc32(a + b" " + b) % buckets) for a, b in reversed(pairs) if a in self.place and b in self.place]
        if both:
            first, second, bucket = np.array(both).T
            key = first * len(words) + second
            at = self._slots(key)
            self.keys[at], self.found[at] = key, bucket

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def features(self, documents: list[list[bytes]]) -> list[np.ndarray]:
        """The buckets of each document's words and pairs."""
        words = [w for d in documents for w in d]
        if not words:
            return [np.zeros(0, np.uint16) for _ in documents]
        place = np.fromiter((self.place.get(w, -1) for w in words), np.int64, len(words))
        states = self.states[place]
        for i in np.flatnonzero(place < 0).tolist():
            states[i] = crc32(words[i])
        sizes = np.fromiter(map(len, documents), np.int64, len(documents))
        ends = np.cumsum(sizes)
        own = np.ones(len(words), bool)  # a word goes on to the next one of its document
        own[ends[sizes > 0] - 1] = False
        left = np.flatnonzero(own)
        key = place[left] * (len(self.states) - 1) + place[left + 1]
        slot = self._slots(key)
        known = (place[left] >= 0) & (place[left + 1] >= 0) & (self.keys[slot] == key)
        of_pair = self.found[slot].astype(np.int64)
        rest = np.flatnonzero(~known)
        for j, i, state in zip(rest.tolist(), left[rest].tolist(), states[left[rest]].tolist(), strict=True):
            of_pair[j] = crc32(b" " + words[i + 1], state) % self.buckets
        of_word = (states % self.buckets).astype(np.uint16)
        of_pair = of_pair.astype(np.uint16)
        pair_ends = np.searchsorted(left, ends)
        return [np.concatenate([of_word[e - n : e], of_pair[p - max(0, n - 1) : p]]) for e, n, p in zip(ends.tolist(), sizes.tolist(), pair_ends.tolist(), strict=True)]


def head(texts: DataFrame, most_words: int = HEAD_WORDS, most_pairs: int = HEAD_PAIRS, buckets: int = BUCKETS) -> Head:
    """The head of the vocabulary of `text`, by what all tasks found most frequent; it has a fixed size."""
    sums = as_table(texts.mapInPandas(_frequent, "word binary, next binary, n long").groupBy("word", "next").agg(F.sum("n").alias("n")), "frequent")
    order = [F.desc("n"), "word", "next"]
    words = [bytes(r["word"]) for r in sums.where("next IS NULL").orderBy(*order).limit(most_words).collect()]
    pairs = [(bytes(r["word"]), bytes(r["next"])) for r in sums.where("next IS NOT NULL").orderBy(*order).limit(most_pairs).collect()]
    return Head(words, pairs, buckets)


def features(texts: DataFrame, known: Head) -> DataFrame:
    """Column `id` with n_words and the buckets of all features of `text`, 16 bits each, of every row."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(held: list) -> pd.DataFrame:
            documents = [d for _, d in held]
            return pd.DataFrame({"id": [i for i, _ in held], "n_words": [len(d) for d in documents], "buckets": [b.tobytes() for b in shared.value.features(documents)]})

        for pdf in batches:
            held, n = [], 0
            for i, text in zip(pdf["id"], pdf["text"], strict=True):
                held.append((i, words_of(text)))
                n += len(held[-1][1])
                if n > TOGETHER:
                    yield found(held)
                    held, n = [], 0
            if held:
                yield found(held)

    return texts.select("id", "text").mapInPandas(rows, "id string, n_words long, buckets binary")


def totals(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall into each bucket; a task sends a row a bucket."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(buckets, np.int64)
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                counts += np.bincount(np.frombuffer(b"".join(pdf["buckets"].iloc[at : at + 500]), np.uint16), minlength=buckets)
        yield pd.DataFrame({"bucket": np.flatnonzero(counts), "n": counts[counts > 0]})

    out = np.zeros(buckets, object)
    for row in found.select("buckets").mapInPandas(sums, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of how much likelier the target has a bucket), counts raised by one."""
    smooth = len(corpus)
    all_corpus, all_target = float(int(corpus.sum()) + smooth), float(int(target.sum()) + smooth)
    ratio = np.array([float(t + 1) * all_corpus / (float(s + 1) * all_target) for s, t in zip(corpus, target, strict=True)])
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def noise(doc_id: Column) -> Column:
    """Gumbel noise of an id, in thousandths; a null id is the empty string."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit("7:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """id, n_words, n_features and the floored mean gain of each row's features."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = [np.frombuffer(b, np.uint16) for b in pdf["buckets"]]
            n = np.fromiter(map(len, parts), np.int64, len(parts))
            sums = np.fromiter((gain[p].sum() for p in parts), np.int64, len(parts))
            yield pd.DataFrame({"id": pdf["id"], "n_words": pdf["n_words"], "n_features": n, "weight": sums // np.maximum(n, 1)})

    return found.mapInPandas(rows, "id string, n_words long, n_features long, weight long")


def ranked(scores: DataFrame, share: int, least_words: int) -> DataFrame:
    """The scores with the rank of those drawn. Equal rows are counted as one and told apart at the end; rows of one score
    are sorted together, and the noise of ids spreads even equal texts over scores; counts a score, some hundred thousand
    whole numbers at most, meet in one task."""
    able = scores.where(F.col("n_words") >= least_words)
    most = share * able.count() // 100
    same = able.groupBy("doc_id", "n_features", "weight", "score").agg(F.count(F.lit(1)).alias("copies"))
    running = F.sum("here").over(W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)) - F.col("here")
    starts = able.groupBy("score").agg(F.count(F.lit(1)).alias("here")).select("score", running.alias("before"))
    inside = W.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight").rowsBetween(W.unboundedPreceding, 0)
    placed = same.withColumn("upto", F.sum("copies").over(inside)).join(F.broadcast(starts), "score")
    first = F.col("before") + F.col("upto") - F.col("copies")
    apart = placed.select("doc_id", "n_features", "weight", "score", F.explode(F.sequence(first + 1, first + F.col("copies"))).alias("rank"))
    out = apart.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = scores.where(F.col("n_words") < least_words)
    return out.unionByName(rest.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS, doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; those that are not drawn have no rank.

    Null and empty texts have no features and weight 0 and are too short to be drawn; texts of any length count whole;
    equal texts weigh the same; a null id draws its noise as the empty string and comes last in a tie; rows that share an
    id also share its noise and are ranked one by one; an empty table gives an empty result and an empty target all
    features the gains of its smoothing. Other columns are ignored. head_words and head_pairs change where features are
    looked up, not the result; buckets are 65,536 at most."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    known = head(texts.select("text"), head_words, head_pairs, buckets)
    found = as_table(features(texts, known), "features")
    wanted = features(target.select(F.lit(None).cast("string").alias("id"), F.col(target_text).alias("text")), known)
    gain = gains(totals(found, buckets), totals(wanted, buckets))
    rows = weighed(found, gain).withColumn("doc_id", F.col("id").cast(docs.schema[doc_id].dataType))
    scores = as_table(rows.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise(F.col("id"))).alias("score")), "scores")
    return ranked(scores, share, least_words)


def drawn(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", **how) -> DataFrame:
    """The rows of docs that are drawn, with all their columns; where rows share an id they go together."""
    chosen = resample(docs, target, doc_id=doc_id, **how).where("rank IS NOT NULL").select(F.col("doc_id").alias("drawn_id")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"))
    return rows.join(chosen, F.col("kept")[doc_id].eqNullSafe(F.col("drawn_id")), "left_semi").select("kept.*")
