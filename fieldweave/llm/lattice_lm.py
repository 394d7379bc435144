"""Subword lattice likelihood.

The pieces of an existing vocabulary are the edges of a lattice over a word's bytes; a piece never crosses a white space,
so the lattice of a text is the chain of the lattices of its words, and the probability of a text, summed over all its
segmentations, is the product of those of its words and of the end. Piece probabilities start from the order of the
vocabulary and are then fitted to all training words by expectation maximisation; expected counts are summed by Spark and
only one number a piece of the vocabulary file comes back to the driver.

Each distinct word of the corpus is scored once. The FREQUENT most frequent words, a bounded table, are sent to all tasks,
which sum them where the document lies; only a document's other words leave it, one row each, and meet the scores by an
ordinary join. What is left is rare by construction, so no word is a key that gathers rows, and the join's partitions grow
in number with the data.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table, fold, ship_package

FOLDS, HELD_OUT_FOLD = 5, 1
ITERATIONS = 3
#: Words that documents look up where they lie, and their bytes, at most.
FREQUENT, FREQUENT_BYTES = 1 << 17, 64
#: Distinct words that a task counts before it sends them on, and words that go through the lattice together.
_COUNTED, _TOGETHER = 400_000, 100_000
#: Pseudo-count of each piece.
SMOOTHING = 0.1

_lattices: dict[str, "Lattice"] = {}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Lattice:
    """A trie of the vocabulary's pieces over bytes; the piece's word start is a space. Single bytes are pieces, too."""

    def __init__(self, pieces: list[bytes]):
        single = {bytes([b]) for b in range(256)}
        ordered = [p for p in dict.fromkeys(pieces) if p]
        self.pieces = ordered + sorted(single - set(ordered))
        kids: list[dict[int, int]] = [{}]
        self.piece_at = [-1]
        for number, piece in enumerate(self.pieces):
            node = 0
            for b in piece:
                if b not in kids[node]:
                    kids[node][b] = len(kids)
                    kids.append({})
                    self.piece_at.append(-1)
                node = kids[node][b]
            self.piece_at[node] = number
        used = sorted({b for k in kids for b in k})
        self.columns = np.zeros(256, np.int64)
        self.columns[used] = np.arange(len(used))
        self.next = np.zeros((len(kids), len(used)), np.int32)  # 0: no such node
        for node, k in enumerate(kids):
            for b, to in k.items():
                self.next[node, self.columns[b]] = to
        self.piece_at = np.array(self.piece_at, np.int32)
        self.longest = max(map(len, self.pieces))

    @classmethod
    def of(cls, path: str) -> "Lattice":
        """The lattice of a sentencepiece file, in the file's order; kept by the worker."""
        if path not in _lattices:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            normal = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
            normal.sort(key=lambda i: -model.get_score(i))
            _lattices[path] = cls([model.id_to_piece(i).replace("▁", " ").encode() for i in normal])
        return _lattices[path]

    def by_rank(self) -> np.ndarray:
        """Log probabilities of the pieces by their place in the vocabulary."""
        p = 1.0 / (np.arange(len(self.pieces)) + 10.0)
        return np.log(p / p.sum())

    def _edges(self, text: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of words of one length, [words, bytes]."""
        out = []
        columns = self.columns[text]
        for i in range(text.shape[1]):
            rows, nodes = np.arange(len(text)), np.zeros(len(text), np.int32)
            for j in range(i, min(text.shape[1], i + self.longest)):
                nodes = self.next[nodes, columns[rows, j]]
                if not (live := nodes > 0).all():
                    rows, nodes = rows[live], nodes[live]
                    if not len(rows):
                        break
                piece = self.piece_at[nodes]
                if (is_piece := piece >= 0).any():
                    out.append((i, j + 1, rows[is_piece], piece[is_piece]))
        return out

    def forward(self, text: np.ndarray, logp: np.ndarray, expected: np.ndarray | None = None, counts: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word, over all segmentations; adds expected counts of the pieces if asked to."""
        edges, width = self._edges(text), text.shape[1]
        ahead = np.full((width + 1, len(text)), -np.inf)
        ahead[0] = 0
        for i, j, rows, piece in edges:  # in order of i: ahead[i] is complete
            ahead[j, rows] = np.logaddexp(ahead[j, rows], ahead[i, rows] + logp[piece])
        if expected is not None:
            back = np.full((width + 1, len(text)), -np.inf)
            back[width] = 0
            used, weights = [], []
            for i, j, rows, piece in reversed(edges):
                through = logp[piece] + back[j, rows]
                back[i, rows] = np.logaddexp(back[i, rows], through)
                used.append(piece)
                weights.append(np.exp(ahead[i, rows] + through - ahead[width, rows]) * counts[rows])
            expected += np.bincount(np.concatenate(used), np.concatenate(weights), len(expected))
        return ahead[width]

    def words(self, words: list[bytes], logp: np.ndarray, expected: np.ndarray | None = None, counts: np.ndarray | None = None) -> np.ndarray:
        """Log probabilities of words of any lengths."""
        out, by_length = np.empty(len(words)), defaultdict(list)
        for at, w in enumerate(words):
            by_length[len(w)].append(at)
        for n, places in by_length.items():
            step = max(1, 400_000 // (n + 1))
            for some in (places[k : k + step] for k in range(0, len(places), step)):
                text = np.frombuffer(b"".join(b" " + words[k] for k in some), np.uint8).reshape(len(some), n + 1)
                out[some] = self.forward(text, logp, expected, None if counts is None else counts[some])
        return out


def _tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # for bytes both touch ASCII alone


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    kinds: tuple[Counter[bytes], Counter[bytes]] = Counter(), Counter()  # of held-out and of training texts

    def counted() -> pd.DataFrame:
        out = pd.DataFrame({"word": [*kinds[0], *kinds[1]], "n": [0] * len(kinds[0]) + [*kinds[1].values()], "all": [*kinds[0].values(), *kinds[1].values()]})
        for kind in kinds:
            kind.clear()
        return out.astype({"n": "int64", "all": "int64"})

    for pdf in batches:
        for text, learned in zip(pdf["text"], pdf["learned"], strict=True):
            kinds[bool(learned)].update(_tokens(text))
            if len(kinds[0]) + len(kinds[1]) > _COUNTED:
                yield counted()
    yield counted()


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary), n (in rows whose `learned` is true) and all (in all rows) of the column `text`."""
    return texts.mapInPandas(_count, "word binary, n long, all long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("all").alias("all"))


def _together(batches: Iterator[pd.DataFrame], rows: int = _TOGETHER) -> Iterator[pd.DataFrame]:
    """Arrow batches joined to frames of about `rows` rows, for arrays of words that are worth a call."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def _expect(batches: Iterator[pd.DataFrame], path: str, logp: np.ndarray) -> Iterator[pd.DataFrame]:
    lattice = Lattice.of(path)
    expected = np.zeros(len(lattice.pieces))
    for pdf in _together(batches):
        lattice.words([bytes(w) for w in pdf["word"]], logp, expected, pdf["n"].to_numpy(np.float64))
    found = np.flatnonzero(expected)
    yield pd.DataFrame({"piece": found, "expected": expected[found]})


def fit(words: DataFrame, ends: int, path: str, iterations: int = ITERATIONS) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces and of the end, which share one distribution, from counted words."""
    logp = Lattice.of(path).by_rank()
    end = 0.0
    for _ in range(iterations):
        sums = words.mapInPandas(lambda batches, p=logp: _expect(batches, path, p), "piece int, expected double").groupBy("piece").agg(F.sum("expected").alias("expected"))
        expected = np.full(len(logp), SMOOTHING)
        for row in sums.collect():  # one row a piece of the vocabulary file at most
            expected[row["piece"]] += round(row["expected"], 6)
        total = expected.sum() + ends + SMOOTHING
        logp, end = np.log(expected / total), float(np.log((ends + SMOOTHING) / total))
    return logp, end


def _word_scores(batches: Iterator[pd.DataFrame], path: str, logp: np.ndarray) -> Iterator[pd.DataFrame]:
    lattice = Lattice.of(path)
    for pdf in _together(batches):
        yield pdf.assign(logp=lattice.words([bytes(w) for w in pdf["word"]], logp))


def scored_words(words: DataFrame, path: str, logp: np.ndarray) -> DataFrame:
    """The counted words with logp, their log probability over all segmentations."""
    return words.mapInPandas(lambda batches: _word_scores(batches, path, logp), "word binary, n long, all long, logp double")


_ROW = "word binary, doc long, text_hash long, copies long, n long, n_known long, base double, score double"


def _document_rows(batches: Iterator[pd.DataFrame], words: list[bytes], facts: np.ndarray) -> Iterator[pd.DataFrame]:
    """A row with the sums of each document's frequent words, and a row for each of its other words.

    The first kind has a key that is no word (it starts with a space) and is spread by it."""
    known = {w: i for i, w in enumerate(words)}
    names = [c.split()[0] for c in _ROW.split(", ")]
    for pdf in batches:
        for at in range(0, len(pdf), 500):
            part = pdf.iloc[at : at + 500]
            keys, docs, hashes, counts, sums = [], [], [], [], []
            for doc, text_hash, text in zip(part["doc"].tolist(), part["text_hash"].tolist(), part["text"], strict=True):
                here = Counter(_tokens(text))
                places = [known.get(w if len(w) <= FREQUENT_BYTES else b" " + hashlib.md5(w).digest(), -1) for w in here]
                found, n = np.array(places, np.int64), np.fromiter(here.values(), np.int64, len(here))
                own = found >= 0
                sums.append((n[own].sum(), *(n[own] @ facts[found[own]])))
                rare = [w for w, i in zip(here, places, strict=True) if i < 0]
                keys += [b" " + struct.pack("<qq", doc, text_hash), *rare]
                docs += [doc] * (len(rare) + 1)
                hashes += [text_hash] * (len(rare) + 1)
                counts += [0, *n[~own].tolist()]
            out = pd.DataFrame({"word": keys, "doc": docs, "text_hash": hashes, "copies": 0, "n": counts, "n_known": 0, "base": 0.0, "score": 0.0})
            first = np.flatnonzero(out["n"].to_numpy() == 0)  # the documents' own rows, in order: a word's count is above 0
            total, seen, base, score = np.array(sums, float).reshape(-1, 4).T
            for column, values in (("copies", np.ones(len(first), np.int64)), ("n", total.astype(np.int64)), ("n_known", seen.round().astype(np.int64)), ("base", base), ("score", score)):
                whole = out[column].to_numpy().copy()
                whole[first] = values
                out[column] = whole
            yield out[names]


def most_frequent(scored: DataFrame, most: int) -> DataFrame:
    """Up to `most` of the words with the highest counts, those of more than FREQUENT_BYTES bytes as a space and their MD5, from a threshold that a histogram of the counts' logarithms gives."""
    key = F.when(F.length("word") <= FREQUENT_BYTES, F.col("word")).otherwise(F.concat(F.lit(b" "), F.unhex(F.md5("word"))))
    short = scored.withColumn("word", key)
    step = F.floor(F.log2(F.col("all").cast("double")) * 8)
    sizes = sorted(((r["step"], r["count"]) for r in short.groupBy(step.alias("step")).count().collect()), reverse=True)  # 8 * 63 rows at most
    upto = np.cumsum([n for _, n in sizes])
    least = [at for (at, _), n in zip(sizes, upto, strict=True) if n <= most]
    return short.where(step >= least[-1]) if least else short.limit(0)


def score(docs: DataFrame, vocabulary: str | None = None, iterations: int = ITERATIONS, frequent: int = FREQUENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    score is log10 of the text's probability over all segmentations, its end included; base_score is the add-half word
    model of the same training documents. Learns from all documents outside the held-out fold; `frequent` changes where
    words are looked up, not the result. Null, empty and white texts are the end alone. Texts of any length are read
    whole, and so is a word of any length, in time that grows with its bytes. Ids may be of any type; a null id is never
    held out; rows with equal ids are scored one by one, and equal rows alike. An empty table gives an empty result;
    other columns are ignored."""
    spark = docs.sparkSession
    ship_package(spark)
    path = vocabulary or vocabulary_path()
    learned = fold("doc_id", FOLDS) != HELD_OUT_FOLD
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("learned", learned)
    words = as_table(word_counts(rows.select("text", "learned")), "words")
    ends = rows.where("learned").count()
    v, n = words.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    train, distinct = n + ends, v + (ends > 0)
    logp, end = fit(words.where("n > 0"), ends, path, iterations)
    scored = as_table(scored_words(words, path, logp), "scored_words")
    total = float(train + 0.5 * (distinct + 1))
    top = most_frequent(scored, frequent).collect()  # `frequent` words of FREQUENT_BYTES bytes at most
    facts = np.array([(r["n"] > 0, np.log10((r["n"] + 0.5) / total), r["logp"]) for r in top], float).reshape(-1, 3)
    shared = spark.sparkContext.broadcast(([bytes(r["word"]) for r in top], facts))
    # Rows that share an id are told apart by their texts; equal rows have equal scores.
    key = ("doc", "text_hash")
    keyed = rows.withColumns({"doc": F.xxhash64(F.lit("id"), F.col("doc_id").cast("string")), "text_hash": F.xxhash64("text")})
    sent = keyed.select(*key, "text").mapInPandas(lambda batches: _document_rows(batches, *shared.value), _ROW)
    met = sent.join(scored.select("word", F.col("n").alias("c"), "logp"), "word", "left")
    rare = lambda c: F.when(F.col("c").isNull(), F.lit(0.0)).otherwise(F.col("n") * c)
    sums = met.groupBy(*key).agg(
        F.sum("copies").alias("copies"), F.sum("n").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0))).alias("n_known"),
        F.sum(F.col("base") + rare(F.log10((F.col("c") + 0.5) / total))).alias("base"), F.sum(F.col("score") + rare(F.col("logp"))).alias("score"),
    )
    end_base = float(np.log10((ends + 0.5) / total))
    share = lambda c: F.col(c) / F.col("copies")
    scores = sums.select(
        *key,
        (share("n_tokens") + 1).cast("long").alias("n_tokens"),
        (share("n_known") + (1 if ends else 0)).cast("long").alias("n_known"),
        (share("base") + end_base).alias("base_score"),
        ((share("score") + end) / float(np.log(10))).alias("score"),
    )
    ids = keyed.select("doc_id", *key)
    out = ids.join(scores, [*key])
    return out.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT_FOLD).alias("held_out"), "n_tokens", "n_known", F.lit(train).cast("long").alias("train_tokens"), "base_score", "score")
