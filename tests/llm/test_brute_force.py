"""Toxicity and language ID against plain loops over bytes."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from fieldweave.llm import lang_id, toxicity

SF = "/root/testdata/sf0.001"


class PlainTable:
    """Counts of n-grams of bytes, smoothed by absolute discounts."""

    def __init__(self, counts, discount):
        self.counts, self.discount, self.total, self.freed = counts, discount, defaultdict(float), defaultdict(float)
        for gram, c in counts.items():
            self.total[gram[:-1]] += c
            self.freed[gram[:-1]] += min(c, discount)

    def over(self, gram, lower):
        total = self.total.get(gram[:-1], 0)
        return (max(self.counts.get(gram, 0) - self.discount, 0) + self.freed[gram[:-1]] * lower) / total if total > 0 else lower


def grams(word, order):
    padded = bytes(order - 1) + word + b" "
    return [padded[i : i + order] for i in range(len(word) + 1)]


def plain_differences(ordinary, toxic, words, order):
    """By the definition: class counts over pooled counts over continuation counts of each lower order over a fair byte."""
    classes = [Counter(), Counter()]
    for counts, of in zip(classes, (ordinary, toxic), strict=True):
        for word, n in of.items():
            for g in grams(word, order):
                counts[g] += n
    tables, lower = [], set(classes[0]) | set(classes[1])
    tables.append(PlainTable(classes[0] + classes[1], toxicity.DISCOUNT))
    for _ in range(order - 1):
        continuations = Counter(g[1:] for g in lower)
        tables.append(PlainTable(continuations, toxicity.DISCOUNT))
        lower = set(continuations)
    tops = [PlainTable(c, toxicity.CLASS_DISCOUNT) for c in classes]
    out = {}
    for word in words:
        x = 0.0
        for g in grams(word, order):
            p = 1 / 256
            for k, t in enumerate(reversed(tables), 1):
                p = t.over(g[-k:], p)
            x += math.log(tops[1].over(g, p)) - math.log(tops[0].over(g, p))
        out[word] = math.copysign(max(abs(x) - toxicity.MARGIN, 0), x)
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_class_models(monkeypatch, order):
    monkeypatch.setattr(toxicity, "MARGIN", 0.01 * order)
    draw = np.random.default_rng(order)
    word = lambda: bytes(draw.choice(list(b"abc\xc3"), draw.integers(1, 7)).tolist())
    ordinary, toxic = (Counter({word(): int(draw.integers(1, 40)) for _ in range(60)}) for _ in range(2))
    words = sorted({word() for _ in range(80)} | set(ordinary) | {b"zz", b"\xff"})
    want = plain_differences(ordinary, toxic, words, order)
    got = toxicity.Model(ordinary, toxic, order).differences(words)
    assert np.allclose(got, [want[w] for w in words], atol=1e-9) and (got != 0).any()


def test_scores_of_whole_documents(spark, monkeypatch):
    learned, model = [], toxicity.Model

    class Seen(model):
        def __init__(self, ordinary, toxic, *more):
            learned.extend([ordinary, toxic])
            super().__init__(ordinary, toxic, *more)

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    monkeypatch.setattr(toxicity, "Model", Seen)
    fitted = toxicity.train(docs, labels)
    monkeypatch.undo()
    fitted.__class__ = model  # workers know that class alone
    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() for r in docs.collect()}
    known = plain_differences(*learned, set().union(*texts.values()), toxicity.ORDER)
    rows = docs.select("doc_id", toxicity.scorer(fitted)("text").alias("score")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = texts[r["doc_id"]]
        evidence = sum(known[w] for w in words) / max(1, len(words))
        z = min(max(evidence, -0.05), 0.05) * 100 * fitted.slope + fitted.place
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


def plain_language(network, text):
    """Every filter at every place of every window, one by one."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    data = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    total, letters = np.zeros(len(network.languages)), 0
    for at in range(0, len(data), lang_id.WINDOW):
        window = data[at : at + lang_id.WINDOW]
        padded = window.ljust(lang_id.WINDOW + max(lang_id.WIDTHS), b"\0")
        pooled = []
        for k in range(lang_id.FILTERS * len(lang_id.WIDTHS)):
            width = lang_id.WIDTHS[k // lang_id.FILTERS]
            taps = network.filters[:, k].reshape(-1, lang_id.DEPTH)
            assert not taps[width:].any()
            sums = np.array([sum(float(network.embedding[padded[p + j]] @ taps[j]) for j in range(width)) for p in range(lang_id.WINDOW)])
            pooled.append(max(0.0, sums.max()))
        z = np.array(pooled) @ network.weights + network.bias
        weight = sum(b > 32 for b in window)
        total += (z - z.max() - np.log(np.exp(z - z.max()).sum())) * weight
        letters += weight
    p = np.exp(total / letters - (total / letters).max())
    return network.languages[int(p.argmax())], float(p.max() / p.sum())


def test_network_over_whole_texts():
    network = lang_id.Network(["a", "b", "c"])
    draw = np.random.default_rng(4)
    network.weights = draw.normal(0, 1, network.weights.shape).astype(np.float32)
    texts = [None, "", "12 34", "Ein kurzer Text", "Łódź — ünïcode, ÀÉ! " * 3, "x" * lang_id.WINDOW, "Wort für Wort " * (2 * lang_id.WINDOW // 14 + 3), "1" * 300 + " z"]
    names, scores = network.predict(texts)
    for text, name, score in zip(texts, names, scores, strict=True):
        want = plain_language(network, text)
        assert name == want[0] and score == pytest.approx(want[1], abs=1e-4)
