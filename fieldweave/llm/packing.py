"""Packing documents into fixed-length training sequences, balanced by attention cost.

One pass over the rows where they lie, without a shuffle: a task tokenizes its documents and packs them group by group.
A document first fills whole sequences of its own. The remainders of a group are assigned in descending cost: each goes
to the sequence that has cost the least so far among those with room for it, where a piece of n tokens costs
LINEAR * n + QUADRATIC * n * n (attention does not cross pieces). If no sequence has room for the whole piece, the
cheapest open one takes as much of it as fits. A group has as many sequences as its tokens fill; what is over makes
sequences of powers of two, so that nothing is padded.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import ship_package

LENGTH, END_ID = 2048, 1
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
#: Remainders are packed together in groups of about so many tokens.
GROUP_TOKENS = 1 << 20
#: A worker remembers the ids of so many words; then it forgets them all.
_REMEMBERED = 1_000_000
_MARK, _PARTING = b"\x01", b" \x01 "

_workers: dict[str, "_Tokenizer"] = {}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Tokenizer:
    """A vocabulary file and the ids of the words that a worker has seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        plan = json.loads(self.whole.to_str())
        self.special = [t["content"].encode().lower() for t in plan["added_tokens"]]
        # Words of small ASCII letters are what normalization would leave of them, and each is one unit that ends in an id with the suffix.
        self.letters = Tokenizer.from_str(json.dumps(plan | {"normalizer": None}))
        suffix = plan["model"]["end_of_word_suffix"]
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        (self.mark,) = self.whole.encode(_MARK.decode(), add_special_tokens=False).ids
        self.known: dict[bytes, bytes] = {}

    def ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _cut(self, tokenizer, text: str, is_end: Callable[[np.ndarray], np.ndarray], over: int) -> list[bytes]:
        """The ids of a text, cut after each id that ends a part; `over` ids go at the end of each part."""
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        stops = ((np.flatnonzero(is_end(ids)) + 1) * 4).tolist()
        data = ids.tobytes()
        return [data[a : b - 4 * over] for a, b in zip([0, *stops], stops, strict=False)]

    def _letters(self, words: list[bytes]) -> None:
        """Learns words of ASCII letters, many in one call: they are cut by their last ids."""
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            self.known.update(zip(some, self._cut(self.letters, b" ".join(some).decode(), lambda ids: self.ends[ids], 0), strict=True))

    def _others(self, words: list[bytes]) -> None:
        """Learns words without white space, many in one call, parted by a control character that stands alone and is one id."""
        for at in range(0, len(words), 256):
            some = words[at : at + 256]
            if any(_MARK in w for w in some):
                found = [self.ids(w.decode()) for w in some]
            else:
                found = self._cut(self.whole, (_PARTING.join(some) + _PARTING).decode(), lambda ids: ids == self.mark, 1)
            self.known.update(zip(some, found, strict=True))

    def learn(self, new: set[bytes]) -> None:
        """Adds the ids of new words. A word that ends in an ASCII letter and the stops after it are tokenized apart, as the
        vocabulary does; beyond ASCII, lower case may end in a mark that joins the stops."""
        known, letters, others, split = self.known, [w for w in new if w.isalpha()], set(), []  # of bytes: ASCII letters alone
        stems = set()
        for word in new.difference(letters):
            stem = word.rstrip(b".,")
            if len(stem) < len(word) and stem[-1:].isalpha():
                stops = word[len(stem) :]
                split.append((word, stem, stops))
                (stems if stem.isalpha() else others).add(stem)
                others.add(stops)
            else:
                others.add(word)
        stems.difference_update(letters)
        self._letters([*letters, *(w for w in stems if w not in known)])
        self._others([w for w in others if w not in known])
        known.update((word, known[stem] + known[stops]) for word, stem, stops in split)


def _tokenizer(path: str) -> _Tokenizer:
    if path not in _workers:
        _workers[path] = _Tokenizer(path)
    return _workers[path]


def token_bytes(texts: list[str | None], path: str) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers, without the end id: those of the file's tokenizer.

    The vocabulary knows lower case only, drops white space and never joins across it, so a text's ids are those of its
    parts between ASCII white space, in lower case; parts seen before are looked up. A text that holds the string of a
    special token, in any case, goes through the tokenizer as a whole, which knows those strings before it lowers a text."""
    made = _tokenizer(path)
    low = [(t or "").encode().lower() for t in texts]
    whole = {i for i, data in enumerate(low) if any(x in data for x in made.special)}
    parts = [[] if i in whole else data.split() for i, data in enumerate(low)]
    new = set().union(*parts).difference(made.known)
    if new:
        if len(made.known) + len(new) > _REMEMBERED:
            made.known.clear()
            new = set().union(*parts)
        made.learn(new)
    return [made.ids(texts[i]) if i in whole else b"".join(map(made.known.__getitem__, p)) for i, p in enumerate(parts)]


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def capacities(tokens: int, length: int = LENGTH) -> list[int]:
    """Full sequences, then powers of two that add up to the rest."""
    rest = tokens % length
    return [length] * (tokens // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(item, start in it, tokens, sequence, offset) for items of at most `length` tokens; every sequence is filled.

    Items go in descending cost, ties in their order; among sequences of equal cost the first takes the item."""
    room = np.array(capacities(sum(lengths), length), np.int64)
    full = room.copy()
    spent = np.zeros(len(room))
    out = []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        start, left = 0, lengths[item]
        while left:
            open_ = room >= left
            if not open_.any():
                open_ = room > 0
            at = int(np.argmin(np.where(open_, spent, np.inf)))
            n = min(left, int(room[at]))
            out.append((item, start, n, at, int(full[at] - room[at])))
            room[at] -= n
            spent[at] += cost(n)
            start, left = start + n, left - n
    return out


def _pack(batches: Iterator[pd.DataFrame], path: str, length: int, group_tokens: int, numbers: bool) -> Iterator[pd.DataFrame]:
    task = TaskContext.get()
    base, made = (task.partitionId() if task else 0) << 33, 0
    end = np.array([END_ID], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    group: list[tuple] = []  # doc_id, start of the remainder, its ids, tokens of the document
    held = 0

    def packed() -> pd.DataFrame:
        nonlocal made, group, held
        lengths = [len(g[2]) // 4 for g in group]
        rows = []
        for item, start, n, sequence, offset in assign(lengths, length):
            doc, at, ids, total = group[item]
            rows.append((doc, at + start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), total, base + made + sequence, offset))
        made += len(capacities(sum(lengths), length))
        group, held = [], 0
        return frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=names)
        return out.astype({"doc_id": "Int64" if numbers else object})

    for pdf in batches:
        for at in range(0, len(pdf), 500):
            part = pdf.iloc[at : at + 500]
            whole = []
            for doc, ids in zip(part["doc_id"], token_bytes(part["text"].tolist(), path), strict=True):
                ids, doc = ids + end, None if pd.isna(doc) else int(doc) if numbers else doc
                total = len(ids) // 4
                for start in range(0, total - length + 1, length):
                    whole.append((doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, base + made, 0))
                    made += 1
                if rest := total % length:
                    group.append((doc, total - rest, ids[4 * (total - rest) :], total))
                    held += rest
            if whole:
                yield frame(whole)
            if held >= group_tokens:
                yield packed()
    if group:
        yield packed()


def pack(docs: DataFrame, tokenizer_path: str | None = None, length: int = LENGTH, group_tokens: int = GROUP_TOKENS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are followed by END_ID; each id lies in exactly one piece. Null and empty texts are that id alone; a
    text of any length is cut into whole sequences and a remainder. Whole-number ids come as longs, others as they are.
    Rows with equal ids, or null ids, are packed as documents of their own. Sequence ids hold the partition's number, so
    a task that runs again gives the same rows. An empty table gives an empty result; other columns are ignored."""
    ship_package(docs.sparkSession)
    path, kind = tokenizer_path or vocabulary_path(), docs.schema[doc_id].dataType
    as_id = "long" if isinstance(kind, IntegralType) else kind.simpleString()
    schema = f"doc_id {as_id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    rows = docs.select(F.col(doc_id).cast(as_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(lambda batches: _pack(batches, path, length, group_tokens, as_id == "long"), schema)
