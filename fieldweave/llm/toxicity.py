"""Toxicity by class-conditional Kneser-Ney models.

Two models of the letters of words, of the toxic and of the ordinary training documents, give each word two
log-likelihoods. A class's counts of the highest order are discounted and back off to those of both classes together,
which back off to shared continuation counts of the lower orders; so an expression that is rare in both classes gets
about the same likelihood from both, and only what one class repeats in many documents tells them apart. A document's
evidence is the sum over its words of the difference of the two, beyond a margin for chance, divided by the number of
words; a logistic curve fitted on training documents that the counts have not seen turns it into a score.

The training documents are a bounded sample; a class has MOST_DOCUMENTS of them at most.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, ship_package

FOLDS, HELD_OUT_FOLD = 3, 1
#: Labelled documents of each class that the models learn from, at most: (ordinary, toxic). Two thirds give counts, one third the curve.
MOST_DOCUMENTS = (3000, 1500)
#: Bytes of an n-gram; the discount of shared and of class counts; the difference of log-likelihoods that counts as chance.
ORDER, DISCOUNT, CLASS_DISCOUNT, MARGIN = 5, 0.75, 3.0, 3.0
THRESHOLD = 0.7
_REMEMBERED = 400_000

_known: dict[str, dict[bytes, float]] = {}


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # for bytes both touch ASCII alone


def _grams(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram of each word, packed into a number, and the place of its word. Words are padded before and end in a space."""
    blob = np.frombuffer(b"".join(bytes(order - 1) + w + b" " for w in words), np.uint8)
    n = np.fromiter(map(len, words), np.int64, len(words)) + 1
    word = np.repeat(np.arange(len(words)), n)
    first = np.arange(n.sum()) + word * (order - 1)
    key = np.zeros(len(first), np.uint64)
    for k in range(order):
        key = (key << np.uint64(8)) | blob[first + k].astype(np.uint64)
    return key, word


class _Counts:
    """Counts of n-grams and, by their contexts, the totals and the mass that discounts free."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, discount: float):
        self.keys, self.counts, self.discount = keys, counts, discount
        self.contexts, at = np.unique(keys >> np.uint64(8), return_inverse=True)
        self.totals = np.bincount(at, counts, len(self.contexts))
        self.freed = np.bincount(at, np.minimum(counts, discount), len(self.contexts))

    @staticmethod
    def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        return np.where(keys[at] == wanted, values[at], 0.0) if len(keys) else np.zeros(len(wanted))

    def over(self, wanted: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities of n-grams, given those of the next lower order."""
        context = wanted >> np.uint64(8)
        total = self._find(self.contexts, self.totals, context)
        count, freed = self._find(self.keys, self.counts, wanted), self._find(self.contexts, self.freed, context)
        return np.where(total > 0, (np.maximum(count - self.discount, 0) + freed * lower) / np.maximum(total, 1), lower)


class Model:
    def __init__(self, ordinary: Counter, toxic: Counter, order: int = ORDER):
        """Counters: in how many documents of a class a word stands."""
        self.order = order
        found = []
        for counter in (ordinary, toxic):
            words = list(counter)
            keys, word = _grams(words, order) if words else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            own, at = np.unique(keys, return_inverse=True)
            found.append((own, np.bincount(at, np.array([counter[w] for w in words], float)[word] if words else [], len(own))))
        keys = np.union1d(found[0][0], found[1][0])
        self.classes, pooled = [], np.zeros(len(keys))
        for own, counts in found:
            whole = np.zeros(len(keys))
            whole[np.searchsorted(keys, own)] = counts
            self.classes.append(_Counts(keys, whole, CLASS_DISCOUNT))
            pooled += whole
        self.shared = [_Counts(keys, pooled, DISCOUNT)]
        for k in range(order - 1, 0, -1):
            keys, counts = np.unique(keys & np.uint64((1 << 8 * k) - 1), return_counts=True)
            self.shared.insert(0, _Counts(keys, counts.astype(float), DISCOUNT))
        self.token, self.slope, self.place = uuid.uuid4().hex, 1.0, 0.0

    def differences(self, words: list[bytes]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary), beyond the margin."""
        keys, word = _grams(words, self.order)
        p = np.full(len(keys), 1 / 256)
        for k, counts in enumerate(self.shared, 1):
            p = counts.over(keys & np.uint64((1 << 8 * k) - 1), p)
        ordinary, toxic = (np.log(c.over(keys, p)) for c in self.classes)
        x = np.bincount(word, toxic - ordinary, len(words))
        return np.sign(x) * np.maximum(np.abs(x) - MARGIN, 0)

    def evidence(self, documents: list[list[bytes]]) -> np.ndarray:
        if self.token not in _known:
            _known.clear()  # a worker that is used again keeps the words of one model
        known = _known.setdefault(self.token, {})
        if new := set().union(*documents).difference(known):
            if len(known) + len(new) > _REMEMBERED:
                known.clear()
                new = set().union(*documents)
            order = list(new)
            for at in range(0, len(order), 50_000):
                some = order[at : at + 50_000]
                known.update(zip(some, self.differences(some).tolist(), strict=True))
        return np.array([sum(map(known.__getitem__, d)) / max(1, len(d)) for d in documents])

    def calibrate(self, evidence: np.ndarray, toxic: np.ndarray, penalty: float = 0.01) -> None:
        """Logistic regression by Newton's method; classes weigh the same."""
        x = np.column_stack([self._scaled(evidence), np.ones(len(evidence))])
        weight, w = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum())) * len(toxic), np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ w))
            step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + penalty * np.eye(2), x.T @ (weight * (p - toxic)) + penalty * w)
            w -= np.clip(step, -2, 2)
        self.slope, self.place = float(w[0]), float(w[1])

    @staticmethod
    def _scaled(evidence: np.ndarray) -> np.ndarray:
        return np.clip(evidence, -0.05, 0.05) * 100

    def scores(self, documents: list[list[bytes]]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self._scaled(self.evidence(documents)) * self.slope + self.place)))


def _distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"toxic": pdf["toxic"], "counts": pdf["counts"], "words": [b" ".join(_words(t)) if not c else b" ".join(sorted(set(_words(t)))) for t, c in zip(pdf["text"], pdf["counts"], strict=True)]})


def train(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST_DOCUMENTS, doc_id: str = "doc_id", text: str = "text") -> Model | None:
    """The model, or None if a class has no training document."""
    ship_package(docs.sparkSession)
    kinds = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    kinds = kinds.where(fold("doc_id", FOLDS) != HELD_OUT_FOLD).withColumn("place", F.xxhash64(F.lit("toxicity"), "doc_id"))
    chosen = None
    for kind in (0, 1):
        some = kinds.where(F.col("toxic") == kind).orderBy("place", "doc_id").limit(most[kind])
        chosen = some if chosen is None else chosen.unionByName(some)
    chosen = chosen.select(F.col("doc_id").alias("l_id"), "toxic", (F.pmod("place", F.lit(3)) != 0).alias("counts"))
    found = docs.select(F.col(doc_id).alias("l_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "l_id")  # a chosen id may repeat
    least = F.min_by(F.struct("toxic", "counts", "text"), F.struct(F.xxhash64("text"), "text"))
    found = found.groupBy("l_id").agg(least.alias("row")).select("row.*")  # sum(most) rows at most
    rows = found.select("toxic", "counts", "text").mapInPandas(_distinct, "toxic int, counts boolean, words binary").toPandas()
    sums = (Counter(), Counter())
    for toxic, words in zip(rows["toxic"][rows["counts"]], rows["words"][rows["counts"]], strict=True):
        sums[toxic].update(bytes(words).split())
    if not sums[0] or not sums[1]:
        return None
    model = Model(*sums)
    unseen = rows[~rows["counts"]]
    if not len(unseen):
        unseen = rows
    model.calibrate(model.evidence([bytes(w).split() for w in unseen["words"]]), unseen["toxic"].to_numpy() == 1)
    _known.pop(model.token, None)
    return model


def scorer(model: Model | None):
    """A column function: text to score."""

    @F.pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            if model is None:
                yield pd.Series(np.zeros(len(texts)))
                continue
            yield pd.Series(np.concatenate([model.scores([_words(t) for t in texts.iloc[at : at + 300]]) for at in range(0, len(texts), 300)] or [np.zeros(0)]))

    return scores.asNondeterministic()  # evaluated once, however often its result is used


def judge(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST_DOCUMENTS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Null, empty and white texts have no evidence, which scores low; a text of any length is scored by all its words;
    without training documents of both classes every score is 0. Labels other than 0 and 1 are ignored, and a document labelled both is toxic. A null id is never held
    out; repeated rows keep a row each; an empty table gives an empty result; other columns are ignored."""
    score = scorer(train(docs, labels, most, doc_id, text))
    out = docs.select(F.col(doc_id).alias("doc_id"), (fold(doc_id, FOLDS) == HELD_OUT_FOLD).alias("held_out"), score(F.col(text)).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
