"""Language ID by a byte convolutional network, trained and applied in numpy.

A text is cut into windows of fixed length. Bytes are embedded, filters of several widths slide over them, each filter's
maximum over a window goes through a softmax layer. A document's language is the one with the largest mean log
probability over all its windows, weighed by their letters. The network is fitted on a bounded sample: one window each of
MOST_ROWS labelled documents a language, of fewer where there are so many languages that all together would pass
MOST_WINDOWS. Every language that a training document names is learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table, fold, ship_package, unit_hash

FOLDS, HELD_OUT_FOLD = 4, 2
UNDETERMINED = "und"
#: Labelled documents that give a training window: of a language, and of all languages together (one of each, at least).
MOST_ROWS, MOST_WINDOWS = 1500, 120_000
WINDOW, DEPTH, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 16
EPOCHS, BATCH, RATE = 6, 128, 0.01
#: Small samples are gone through more often, for so many steps at least.
LEAST_STEPS = 150

_SPACE = b"".join(bytes([b]) if chr(b).isalpha() or b >= 128 else b" " for b in range(256)).lower()


def normal(text: str | None) -> bytes:
    """UTF-8 with ASCII letters in lower case and every other ASCII byte a space."""
    return (text or "").encode().translate(_SPACE)


def windows(data: bytes) -> np.ndarray:
    """All bytes as rows of WINDOW bytes, the last filled up with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


class Network:
    def __init__(self, languages: list[str], seed: int = 7):
        draw = np.random.default_rng(seed)
        self.languages, widest = languages, max(WIDTHS)
        self.embedding = draw.normal(0, 0.3, (256, DEPTH)).astype(np.float32)
        self.embedding[0] = 0
        self.reach = np.zeros((widest, DEPTH, FILTERS * len(WIDTHS)), np.float32)
        for k, width in enumerate(WIDTHS):
            self.reach[:width, :, k * FILTERS : (k + 1) * FILTERS] = 1
        self.reach = self.reach.reshape(widest * DEPTH, -1)
        self.filters = draw.normal(0, 0.25, self.reach.shape).astype(np.float32) * self.reach
        self.weights = draw.normal(0, 0.1, (self.filters.shape[1], len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def _patches(self, x: np.ndarray) -> np.ndarray:
        """[windows, positions, bytes of the widest filter * DEPTH]."""
        widest = max(WIDTHS)
        embedded = self.embedding[np.pad(x, ((0, 0), (0, widest - 1)))]
        rows = np.lib.stride_tricks.as_strided(embedded, (len(x), WINDOW, widest * DEPTH), (embedded.strides[0], embedded.strides[1], embedded.strides[2]))
        return np.ascontiguousarray(rows)

    def pooled(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((self._patches(x).reshape(-1, self.filters.shape[0]) @ self.filters).reshape(len(x), WINDOW, -1).max(axis=1), 0)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(x), 64):
            z = self.pooled(x[at : at + 64]) @ self.weights + self.bias
            z -= z.max(axis=1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
        return np.concatenate(out)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> "Network":
        """Adam on the cross entropy; the gradient of a maximum flows to the bytes under it. Classes weigh the same."""
        draw, names = np.random.default_rng(seed), ("embedding", "filters", "weights", "bias")
        mean, square, step = {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
        share = len(y) / np.maximum(1, np.bincount(y, minlength=len(self.languages))) / len(self.languages)
        widest = max(WIDTHS)
        epochs = max(epochs, -(-LEAST_STEPS // -(-len(x) // BATCH)))
        for epoch in range(epochs):
            order = draw.permutation(len(x))
            for at in range(0, len(order), BATCH):
                some = order[at : at + BATCH]
                patches = self._patches(x[some])
                maps = (patches.reshape(-1, patches.shape[2]) @ self.filters).reshape(len(some), WINDOW, -1)
                best = maps.argmax(axis=1)
                top = np.take_along_axis(maps, best[:, None, :], axis=1)[:, 0]
                hidden = np.maximum(top, 0)
                z = hidden @ self.weights + self.bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(some)), y[some]] -= 1
                p *= (share[y[some]] / len(some))[:, None].astype(np.float32)
                back = (p @ self.weights.T) * (top > 0)
                under = patches[np.arange(len(some))[:, None], best]  # [batch, filter, bytes * DEPTH]
                to_bytes = (back[:, :, None] * self.filters.T[None]).reshape(len(some), -1, widest, DEPTH)
                padded = np.pad(x[some], ((0, 0), (0, widest - 1)))
                at_bytes = padded[np.arange(len(some))[:, None, None], best[:, :, None] + np.arange(widest)]
                embedding = np.stack([np.bincount(at_bytes.ravel(), to_bytes[..., d].ravel(), 256) for d in range(DEPTH)], axis=1)
                embedding[0] = 0
                gradients = {"embedding": embedding, "filters": np.einsum("bf,bfk->kf", back, under) * self.reach, "weights": hidden.T @ p, "bias": p.sum(axis=0)}
                step += 1
                for n, g in gradients.items():
                    mean[n], square[n] = 0.9 * mean[n] + 0.1 * g, 0.99 * square[n] + 0.01 * g * g
                    rate = RATE * (1 - epoch / epochs)
                    setattr(self, n, (getattr(self, n) - rate * (mean[n] / (1 - 0.9**step)) / (np.sqrt(square[n] / (1 - 0.99**step)) + 1e-8)).astype(np.float32))
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and their probabilities, from every window of every text."""
        kept = [i for i, t in enumerate(texts) if t and any(c.isalpha() for c in t)]
        names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if kept and self.languages:
            parts = [windows(normal(texts[i])) for i in kept]
            x = np.concatenate(parts)
            letters = (x > 32).sum(axis=1).astype(np.float64)
            counts = [len(p) for p in parts]
            starts = np.cumsum([0, *counts[:-1]])
            sums = np.add.reduceat(self.log_probabilities(x) * letters[:, None], starts) / np.maximum(1, np.add.reduceat(letters, starts))[:, None]
            p = np.exp(sums - sums.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            scores[kept] = p.max(axis=1)
            for i, k in zip(kept, p.argmax(axis=1), strict=True):
                names[i] = self.languages[k]
        return names, scores


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most_rows: int = MOST_ROWS) -> Network:
    """A network of the languages named in rows outside the held-out fold; one without languages if there is none."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT_FOLD))
    sizes = as_table(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    languages = sorted(r["lang"] for r in sizes.select("lang").collect())  # a row a language
    if not languages:
        return Network([])
    most = max(1, min(most_rows, MOST_WINDOWS // len(languages)))
    place = unit_hash(F.lit("language"), "doc_id", "text")
    middle = F.pmod(F.xxhash64(F.lit("window"), "doc_id"), F.greatest(F.length("text") - WINDOW + 1, F.lit(1))).cast("int") + 1
    # A share of each language that gives `most` rows on average and so many that none is left without; a language of few rows gives all.
    some = rows.join(F.broadcast(sizes), "lang").where(place < (most + 4 * most**0.5) / F.col("rows"))
    sample = some.select("lang", F.substring("text", middle, F.lit(WINDOW)).alias("part"), place.alias("place"))
    found = sample.orderBy("place", "lang", "part").limit(2 * (most + 6) * len(languages)).collect()
    draw, x, y = np.random.default_rng(7), [], []
    for row in found:
        data = normal(row["part"])[:WINDOW]
        if not any(c.isalpha() for c in row["part"] or ""):
            continue
        short = int(draw.integers(4, WINDOW)) if draw.random() < 0.4 else WINDOW  # short texts are to be told apart, too
        x.append(windows(data[:short])[0])
        y.append(languages.index(row["lang"]))
    return Network(languages).fit(np.array(x), np.array(y)) if x else Network([])


def identifier(network: Network):
    """A column function: text to struct<lang_pred, score>."""

    @F.pandas_udf("lang_pred string, score double")
    def identify(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            found = [network.predict(texts.iloc[at : at + 100].tolist()) for at in range(0, len(texts), 100)]
            yield pd.DataFrame({"lang_pred": [n for names, _ in found for n in names], "score": np.concatenate([s for _, s in found] or [np.zeros(0)])})

    return identify.asNondeterministic()  # evaluated once, however often its result is used


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most_rows: int = MOST_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document.

    A text that is null or has no letter is `und` with score 0, and so is every text if no row names a language. A text of
    any length is judged by all its windows. Ids may be of any type; a null id is never held out; repeated rows keep a row each; an empty table gives an empty result; other columns are
    ignored, and lang is read from training rows alone."""
    found = identifier(train(docs, doc_id, text, lang, most_rows))
    out = docs.select(F.col(doc_id).alias("doc_id"), (fold(doc_id, FOLDS) == HELD_OUT_FOLD).alias("held_out"), found(F.col(text)).alias("found"))
    return out.select("doc_id", "held_out", "found.lang_pred", "found.score")
