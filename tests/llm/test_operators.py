"""The training-data operators against brute force, round trips and held-out accuracy, and on awkward rows."""

import base64
import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldweave.llm import lang_id, lattice_lm, mixing, packing, progressive_jpeg, simhash, topk, toxicity, url_filter, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, size int, n string, key string"


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, white, letterless, repeated, tied and very long texts, null ids, and columns whose names clash."""
    long = "the of and tion " * 20000
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "123 !!", "de", "b"), (5, "the of and to in", "en", "b"), (6, "the of and to in", "en", "b"), (6, "the of and to in", "en", "b"), (None, "der die und", "de", None), (7, long, "en", "c"), (8, "w" * 100_000, "fr", "c")]
    return spark.createDataFrame([(i, t, lang, s, 0, 0.5, "x", 1, "y", "z") for i, t, lang, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark, docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return (text or "").encode().lower().split()


def brute_fingerprint(text):
    w = words(text)
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_language(spark, real, docs, nothing):
    found = {r["doc_id"]: r for r in lang_id.identify(real).collect()}
    truth = {r["doc_id"]: r["lang"] for r in real.collect()}
    held = [i for i, r in found.items() if r["held_out"]]
    assert held and np.mean([found[i]["lang_pred"] == truth[i] for i in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in found.values())
    odd = [(r["doc_id"], r["lang_pred"], r["score"]) for r in lang_id.identify(docs).collect()]
    assert len(odd) == 10 and {(i, p) for i, p, _ in odd if i in (1, 2, 3, 4)} == {(i, "und") for i in (1, 2, 3, 4)}
    assert lang_id.identify(nothing).count() == 0


def test_every_language_is_learned(spark):
    """More than 200 languages, each of its own letters, some named by few documents."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [a + b for a in letters for b in letters][:230]
    rows = [(k * 1000 + i, f"{n}{n} " * 30, n) for k, n in enumerate(names) for i in range(3 if k % 10 else 30)]
    network = lang_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    held = {n for i, _, n in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    assert network.languages == sorted(held) and len(held) > 200


def test_windows_hold_every_byte():
    data = bytes(range(1, 256)) * 5
    assert lang_id.windows(data).ravel().tobytes().rstrip(b"\0") == data


def test_bit_sliced_comparison():
    draw = np.random.default_rng(3)
    a = draw.integers(0, 2**63, 300, np.uint64)
    b = np.concatenate([a[:150] ^ (np.uint64(1) << draw.integers(0, 64, 150).astype(np.uint64)), draw.integers(0, 2**63, 170, np.uint64)])
    for radius in (0, 1, 3, 5, 8, 30):
        assert (simhash.within(a, b, radius) == (np.bitwise_count(a[:, None] ^ b[None, :]) <= radius)).all()


@pytest.mark.parametrize("cell_rows", [4096, 2])
def test_near_duplicates(spark, real, docs, nothing, cell_rows):
    for table in (real, docs):
        rows = [(r["doc_id"], r["text"]) for r in table.collect()]
        prints = [brute_fingerprint(t) if len(t or "") < 50_000 else simhash.fingerprint(t) for _, t in rows]
        group = list(range(len(rows)))

        def root(x):
            while group[x] != x:
                x = group[x]
            return x

        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 3:
                    group[root(i)] = root(j)
        least = {}
        for i, (doc, _) in enumerate(rows):
            if doc is not None:
                least[root(i)] = min(least.get(root(i), doc), doc)
        want = sorted((str(doc), f"{prints[i]:016x}", str(least.get(root(i)))) for i, (doc, _) in enumerate(rows))
        assert sorted(tuple(map(str, r)) for r in simhash.near_duplicates(table, cell_rows=cell_rows).collect()) == want
    assert simhash.near_duplicates(nothing).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(1, 30)] + [(-5, 200)]
    found = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert all(found[i] == 0 for i in range(61)) and all(found[100 + k] == 100 for k in range(30)) and found[200] == -5


def test_media(spark, real, docs, nothing):
    for table in (real, docs):
        texts = collections.Counter()
        for r in table.collect():
            data = (r["text"] or "").encode()
            payload = data.ljust(max(1, -(-len(data) // 576)) * 576, b"\xff")
            texts[(r["doc_id"], len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))] += 1
        found = progressive_jpeg.digests(progressive_jpeg.stored(table)).collect()
        assert collections.Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in found) == texts
    assert progressive_jpeg.digests(progressive_jpeg.media(nothing)).count() == 0
    shapes = progressive_jpeg.tensors(progressive_jpeg.media(docs)).collect()
    assert all(len(r["rgb"]) == 3 * r["height"] * r["width"] for r in shapes)


def test_jpeg_scans_symbol_by_symbol():
    data = progressive_jpeg.encode(np.random.default_rng(1).integers(0, 256, 576 * 3, np.uint8).tobytes())
    quick, slow = progressive_jpeg.coefficients(data), progressive_jpeg.coefficients(data, quick=False)
    for a, b in zip(quick[2], slow[2], strict=True):
        assert (a.blocks == b.blocks).all()


def test_jpeg_runs_zeros_and_dc():
    """A grey block pair, coded by hand: DC with a low bit to follow, a run of zeros, an end of band, a new coefficient in a refining scan."""
    j = progressive_jpeg
    out = [b"\xff\xd8", j._segment(0xDB, bytes([0]) + bytes([1] * 64)), j._segment(0xC2, bytes([8, 0, 8, 0, 16, 1, 1, 0x11, 0]))]
    out.append(j._segment(0xC4, j._table(0, 0, [(2, [0, 3])]) + j._table(1, 0, [(2, [0x00, 0x22, 0x11])])))
    bits = lambda s: j._pack(np.array([int(c) for c in s], np.uint8))
    out += [j._segment(0xDA, bytes([1, 1, 0, 0, 0, 0x01])), bits("01" + "101" + "00")]  # differences 5 and 0, times 2
    out += [j._segment(0xDA, bytes([1, 1, 0, 0, 0, 0x10])), bits("10")]
    out += [j._segment(0xDA, bytes([1, 1, 0, 1, 63, 0x01])), bits("01" + "11" + "00" + "00")]  # two zeros, then 3; both bands end
    out += [j._segment(0xDA, bytes([1, 1, 0, 1, 63, 0x10])), bits("10" + "0" + "00" + "1" + "00")]  # one zero and a new -1; the band ends, and the 6 after it gains 1
    height, width, parts, quant, _ = j.coefficients(b"".join([*out, b"\xff\xd9"]))
    assert (height, width) == (8, 16) and parts[0].blocks[:, 0].tolist() == [11, 10]
    assert parts[0].blocks[0, 1:5].tolist() == [0, -1, 7, 0] and not parts[0].blocks[1, 1:].any()
    exact = (parts[0].blocks * quant[0]).astype(float) @ j.BASIS / 8192 + 128
    assert np.abs(j.tensor(height, width, parts, quant)[:, :8, 0].ravel() - exact[0]).max() <= 0.51


def test_warc(spark, nothing):
    rows = [(5, "http://a/\r\nx y", "<p>a</p>"), (3, None, "<p>a</p>"), (3, "u", "<p>a</p>"), (9, "u", None), (8, "u", ""), (None, "u", "b"), (None, "u", "<p>a</p>"), (11, "u", "é" * 300_000)]
    pages = spark.createDataFrame([(i, u, h, 7) for i, u, h in rows], "page_id long, url string, html string, digest int")
    found = sorted(tuple(map(str, r)) for r in warc.archive(pages, frame_bytes=200).collect())
    firsts = {"<p>a</p>": 3, "": 8, "é" * 300_000: 11}
    want = []
    for i, _, h in rows:
        data, first = (h or "").encode(), firsts.get(h or "")
        again = first is not None and first != i
        want.append(tuple(map(str, (i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first if again else None))))
    assert found == sorted(want)
    assert warc.archive(pages.where("false")).count() == 0


def test_one_record_by_its_page(spark):
    """A record is found through the index and the seek table alone, at its place in its frame."""
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i % 40}</p>" * (i % 7 + 1)) for i in range(300)], "page_id long, url string, html string")
    index = warc.write(pages.repartition(3), warc.fresh_path(spark, "warc"), frame_bytes=2000)
    for i in (0, 45, 299):
        (found,) = warc.lookup(index, i).collect()
        (row,) = index.where(f"page_id = {i}").collect()
        files, inner = warc.filesystem(row["bundle"])
        with files.open_input_file(inner) as source:
            place, packed, whole = warc.seek_table(source, source.size())[row["frame"]]
            assert (place, packed) == (row["frame_place"], row["frame_bytes"]) and packed < source.size() / 2
            source.seek(place)
            data = __import__("zstandard").ZstdDecompressor().decompress(source.read(packed), max_output_size=whole)
        headers, _, end = warc.parse(data, row["record_offset"])
        digest = warc.base32(hashlib.sha1(f"<p>{i % 40}</p>".encode() * (i % 7 + 1)).digest())
        assert headers["warc-record-id"] == warc.identifier(i, digest) and end == row["record_offset"] + row["record_bytes"]
        assert found["page_id"] == i and found["payload_digest"] == digest
        assert found["payload"] == (f"<p>{i % 40}</p>".encode() * (i % 7 + 1) if found["record_type"] == "response" else None)
        assert (found["record_type"] == "response") == (i < 280)


def test_packing(spark, real, docs, nothing):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    for table in (real, docs):
        ids = {(r["doc_id"], r["text"]): [*t.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in table.collect()}
        rows = packing.pack(table, group_tokens=5000).collect()
        by_id, texts = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            by_id[r["doc_id"]].append(r)
        for r in table.collect():
            texts[r["doc_id"]].append(ids[r["doc_id"], r["text"]])
        assert by_id.keys() == texts.keys()
        for i, own in texts.items():
            assert sum(r["length"] for r in by_id[i]) == sum(map(len, own))
            for r in by_id[i]:  # rows that share an id have the same text here
                piece = np.array(own[0][r["start"] : r["start"] + r["length"]], "<u4")
                assert len(piece) == r["length"] and zlib.crc32(piece.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(own[0])
            assert collections.Counter(x for r in by_id[i] for x in range(r["start"], r["start"] + r["length"])) == collections.Counter({x: len(own) for x in range(len(own[0]))})
        sequences = collections.defaultdict(list)
        for r in rows:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in sequences.values():
            end = 0
            for offset, n in sorted(parts):
                assert offset == end
                end += n
            assert end == 2048 or end & (end - 1) == 0
    assert packing.pack(nothing).count() == 0
    named = spark.createDataFrame([("a", "the of"), ("b", None), (None, "x")], "doc_id string, text string")
    assert {(str(r["doc_id"]), r["doc_tokens"]) for r in packing.pack(named).collect()} == {("None", 2), ("a", 3), ("b", 1)}


def test_ids_are_the_tokenizers():
    """Strings drawn from parts that are hard for words looked up one by one, against the untouched tokenizer."""
    from tokenizers import Tokenizer

    t, draw = Tokenizer.from_file(packing.vocabulary_path()), np.random.default_rng(5)
    parts = [*"abcdnorstéÉßİıΣσςñ.,;'’-0123 \t\n\u00a0\u2009\x01\x1c\x85", "\u0301", "\u0307", "\u0327", "\u1e9e", "İ.", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "thing", "Tion", "漢字", "🙂", "ﬁ", "e\u0301,", "..", ".,", "١٢", "Don't"]
    texts = ["".join(parts[k] for k in draw.integers(0, len(parts), draw.integers(1, 25))) for _ in range(4000)]
    texts += ["Don't STOP!.. İ ΣΣ café., a.b 12.5, <|endoftext|> \x01 x\x01y  z", "<|endoftext|>", "İ.", "", "a" * 5000]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        found = [np.frombuffer(x, "<u4").tolist() for x in packing.token_bytes(some, packing.vocabulary_path())]
        wrong = [x for x, ids in zip(some, found, strict=True) if ids != t.encode(x, add_special_tokens=False).ids]
        assert not wrong, wrong[:5]


def test_assignment_by_cost():
    """Pieces in descending order, each to the sequence of least cost with room, by a plain search."""
    draw = np.random.default_rng(6)
    for _ in range(30):
        lengths = draw.integers(1, 2048, draw.integers(1, 40)).tolist()
        found = packing.assign(lengths)
        room, spent = packing.capacities(sum(lengths)), [0.0] * len(packing.capacities(sum(lengths)))
        full, want = list(room), []
        for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            start, left = 0, lengths[item]
            while left:
                open_ = [k for k in range(len(room)) if room[k] >= left] or [k for k in range(len(room)) if room[k]]
                at = min(open_, key=lambda k: (spent[k], k))
                n = min(left, room[at])
                want.append((item, start, n, at, full[at] - room[at]))
                room[at], spent[at], start, left = room[at] - n, spent[at] + packing.cost(n), start + n, left - n
        assert found == want and not any(room)


def test_top_k(spark):
    draw = np.random.default_rng(2)
    v = draw.normal(0, 0.2, (400, 16)).astype(np.float32)
    v[50:60] = v[0]
    # Repeated ids: a candidate's with another vector, a query's with the same and with another vector.
    again = [(7, v[7] * 3), (7, v[7] * 3), (13, -v[13]), (150, v[150]), (200, v[201] * 2)]
    odd = [(1000, None, 1), (1050, [None] * 16, 1), (1100, [float("nan")] * 16, 1), (None, v[1].tolist(), 1), (2000, [0.5], 1), (2050, [], 1), (2100, [float("inf")] * 16, 1)]
    every = [*enumerate(v), *again]
    table = spark.createDataFrame([(i, x.tolist(), 1) for i, x in every] + odd, "vec_id long, embedding array<float>, score int")
    whole = [(i, np.floor(256 * x.astype(np.float64)).astype(np.int64)) for i, x in every]
    want = []
    for i, x in {(i, tuple(x)): (i, x) for i, x in whole if i % 50 == 0}.values():
        scores = sorted((-int(x @ y), j) for j, y in whole if j != i)[:5]
        want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scores)]
    for candidate_rows, query_rows in ((100, 3), (10_000, 1000)):
        assert sorted(tuple(r) for r in topk.top_k(table, candidate_rows=candidate_rows, query_rows=query_rows).collect()) == sorted(want)
    assert topk.top_k(table.where("false")).count() == 0
    # Two far groups: cells of the other group are left out of the search of a query tree, and the result is the same.
    far = [(i, (x + (40 if i % 2 else -40)).tolist(), 1) for i, x in enumerate(v)]
    got = topk.top_k(spark.createDataFrame(far, "vec_id long, embedding array<float>, score int"), candidate_rows=50, query_rows=10)
    both = [np.floor(256 * np.array(x, np.float32).astype(np.float64)).astype(np.int64) for _, x, _ in far]
    want = [(i, r + 1, j, -s) for i in range(0, 400, 50) for r, (s, j) in enumerate(sorted((-int(both[i] @ both[j]), j) for j in range(400) if j != i)[:5])]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    pivots, radii = [both[0].astype(float), both[1].astype(float)], {0: 2000.0, 1: 2000.0}
    q, c = topk.Tree(np.array([0]), both[0][None]), topk.Tree(np.arange(2, 20, 2), np.stack(both[2:20:2]))
    row = {"dim": 16, "q_cell": 0, "q_part": 0, "q_tree": topk.pickle.dumps(q), "c_tree": topk.pickle.dumps(c)}
    (told,) = topk._first(iter([topk.pd.DataFrame([row])]), 5, pivots, radii)
    assert told["cells"][0] == [-1, 0] and len(told["floor"][0]) == 1
    with pytest.raises(ValueError, match="exact"):
        topk.top_k(spark.createDataFrame([(0, [1e20, 1.0], 1), (1, [1.0, 2.0], 1)], "vec_id long, embedding array<double>, score int"))


def brute_words(word, logp):
    """Log probability of a word by adding up all segmentations."""
    text = b" " + word
    ways = [0.0] * (len(text) + 1)
    ways[0] = 1.0
    for j in range(1, len(text) + 1):
        ways[j] = sum(ways[i] * logp.get(text[i:j], 0.0) for i in range(j))
    return math.log(ways[-1])


def brute_fit(lattice, counts, ends, passes=3):
    """Piece probabilities and the log probability of the end after some passes over counted words, from expected counts."""
    logp = lattice.by_rank()
    for _ in range(passes):
        expected = np.full(len(logp), lattice_lm.SMOOTHING)
        lattice.words(list(counts), logp, expected, np.array(list(counts.values()), float))
        total = expected.sum() + ends + lattice_lm.SMOOTHING
        logp = np.log(expected / total)
    return dict(zip(lattice.pieces, np.exp(logp), strict=True)), math.log((ends + lattice_lm.SMOOTHING) / total)


def test_lattice(spark, real, docs, nothing):
    path = lattice_lm.vocabulary_path()
    lattice = lattice_lm.Lattice.of(path)
    logp = lattice.by_rank()
    p = dict(zip(lattice.pieces, np.exp(logp), strict=True))
    some = [b"the", b"oferinwhea", "ción".encode(), b"\xff\x00x", b"a"]
    expected = np.zeros(len(logp))
    assert np.allclose(lattice.words(some, logp, expected, np.ones(len(some))), [brute_words(w, p) for w in some])
    assert sum(len(lattice.pieces[i]) * expected[i] for i in np.flatnonzero(expected)) == pytest.approx(sum(len(w) + 1 for w in some))
    for table in (real, docs):
        rows = [(r["doc_id"], r["text"]) for r in table.collect()]
        counts, ends = collections.Counter(), 0
        for i, t in rows:
            if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
                counts.update(words(t))
                ends += 1
        n, v = sum(counts.values()) + ends, len(counts) + 1
        base = lambda t: sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*(counts[w] for w in words(t)), ends])
        found = lattice_lm.score(table, frequent=50).collect()
        assert collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 3)) for r in found) == collections.Counter((i, len(words(t)) + 1, 1 + sum(w in counts for w in words(t)), n, round(base(t), 3)) for i, t in rows)
        p_end = brute_fit(lattice, counts, ends)
        chance = {w: brute_words(w, p_end[0]) for w in {x for _, t in rows for x in words(t)} if len(w) < 200}
        sure = [(i, t) for i, t in rows if all(w in chance for w in words(t))]
        order = lambda x: (str(x[0]), x[1])
        want = sorted(((i, (sum(chance[w] for w in words(t)) + p_end[1]) / math.log(10)) for i, t in sure), key=order)
        got = sorted(((r["doc_id"], r["score"]) for r in found if r["doc_id"] in {i for i, _ in sure}), key=order)
        assert [i for i, _ in got] == [i for i, _ in want] and np.allclose([x for _, x in got], [x for _, x in want], rtol=1e-6)
        every = [{tuple(r) for r in lattice_lm.score(table, frequent=k).select("doc_id", "n_known", F.round("score", 6), F.round("base_score", 6)).collect()} for k in (0, 1 << 17)]
        assert every[0] == every[1]
    assert lattice_lm.score(nothing).count() == 0
    named = spark.createDataFrame([("a", "the of"), ("b", None), (None, "x")], "doc_id string, text string")
    assert collections.Counter(r["doc_id"] for r in lattice_lm.score(named).collect()) == collections.Counter(["a", "b", None])


def test_lattice_is_fitted_by_three_passes(spark):
    path, some, n = lattice_lm.vocabulary_path(), [b"the", b"thence", b"oferinwhea", b"x"], [5, 2, 1, 3]
    lattice, ends = lattice_lm.Lattice.of(path), 4
    want = lattice.by_rank()
    for _ in range(3):
        expected = np.full(len(want), lattice_lm.SMOOTHING)
        lattice.words(some, want, expected, np.array(n, float))
        want = np.log(expected / (expected.sum() + ends + lattice_lm.SMOOTHING))
    table = spark.createDataFrame(list(zip(map(bytearray, some), n)), "word binary, n long")
    assert np.allclose(lattice_lm.fit(table, ends, path)[0], want, atol=1e-4)


def test_toxicity(spark, real, docs, nothing):
    larger = SF.replace("0.001", "0.01")  # the smallest table has 11 toxic labels, too few to learn from
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    found = toxicity.judge(spark.read.parquet(f"{larger}/documents.parquet"), labels).collect()
    assert len(found) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    held = {k: [r["predicted"] for r in found if r["held_out"] and truth.get(r["doc_id"]) == k] for k in (0, 1)}
    assert np.mean(held[0]) < 0.05 and np.mean(held[1]) > 0.6
    odd = toxicity.judge(docs, labels).collect()
    assert len(odd) == 10 and all(r["predicted"] == 0 for r in odd if r["doc_id"] in (1, 2, 3))
    assert toxicity.judge(nothing, labels.where("false")).count() == 0
    assert {r["score"] for r in toxicity.judge(docs, labels.where("false")).collect()} == {0.0}


def test_a_repeated_id_is_learned_once(spark, monkeypatch):
    train = [i for i in range(60) if zlib.crc32(str(i).encode()) % toxicity.FOLDS != toxicity.HELD_OUT_FOLD]
    once = [(i, "good plain words" if i % 2 else "bad vile words") for i in train]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in train], "doc_id long, toxic int")
    learned, model = [], toxicity.Model

    class Seen(model):
        def __init__(self, *sums):
            learned.append(sums)
            super().__init__(*sums)

    monkeypatch.setattr(toxicity, "Model", Seen)
    for rows in (once, once + [once[0]] * 500 + [once[1]] * 500):
        toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert learned[0] == learned[1]


def test_class_models_are_distributions():
    model = toxicity.Model(collections.Counter({b"ab": 5, b"abc": 2}), collections.Counter({b"ab": 1, b"xy": 7}))
    context = int.from_bytes(b"\0\0\0a", "big") << 8
    keys = np.array([context | b for b in range(256)], np.uint64)
    p = np.full(256, 1 / 256)
    for k, counts in enumerate(model.shared, 1):
        p = counts.over(keys & np.uint64((1 << 8 * k) - 1), p)
    for c in model.classes:
        assert c.over(keys, p).sum() == pytest.approx(1)


def test_url_cascade(spark):
    hosts = [f"h{i}.example.{t}" for i in range(20000) for t in ("com", "net")]
    listed = {h for i, h in enumerate(hosts) if i % 7 == 0}
    universe = spark.createDataFrame([(h, h in listed) for h in hosts], "key string, listed boolean")
    levels = url_filter.build_cascade(universe)
    assert len(levels) > 1
    assert {r["key"] for r in universe.where(url_filter.listed(levels, F.col("key"))).collect()} == listed
    urls = [None, "no scheme", "HTTP://A.Com/en/1", "https://x.example.com/en/7?q", "http://net/de/#x", "http://a.example.net/de/8", "http://m.casino-win.example.org", "http://É.org/es/", "http://É.org/es/", "http://q/" + "x" * 100_000]
    pages = spark.createDataFrame([(i, u, 3, True) for i, u in enumerate(urls)], "page_id int, url string, host int, listed boolean")
    want = [(0, "", "", None, "allow"), (1, "", "", None, "allow"), (2, "a.com", "/en/1", "com/en/", "block"), (3, "x.example.com", "/en/7", "example.com/en/7", "allow"), (4, "net", "/de/", "net/de/", "allow"), (5, "a.example.net", "/de/8", "example.net/de/8", "block"), (6, "m.casino-win.example.org", "", None, "block"), (7, "É.org", "/es/", "org/es/", "block"), (8, "É.org", "/es/", "org/es/", "block"), (9, "q", "/" + "x" * 100_000, None, "allow")]
    for bits in (url_filter.SHARD_BITS, 10):
        assert sorted(tuple(r) for r in url_filter.judge(pages, shard_bits=bits).collect()) == want
    assert url_filter.judge(pages.where("false")).count() == 0


def test_shards_of_a_list(spark):
    """A list given as a table and dealt into several shards, each with a cascade of its own."""
    hosts = [f"h{i}.example.test" for i in range(3000)]
    pages = spark.createDataFrame([(i, f"http://{h}/p") for i, h in enumerate(hosts)], "page_id int, url string")
    table = spark.createDataFrame([(h,) for i, h in enumerate(hosts) if i % 3 == 0] + [("elsewhere.test",), (hosts[0],)], "host string")
    for bits in (url_filter.SHARD_BITS, 4000):
        assert (url_filter.shards(1000, bits) > 1) == (bits == 4000)
        found = {r["page_id"] for r in url_filter.judge(pages, shard_bits=bits, hosts=table).collect() if r["verdict"] == "block"}
        assert found == set(range(0, 3000, 3))


def test_buckets_follow_the_rows():
    assert [mixing.bucket_digits(n) for n in (0, 1 << 30, (1 << 30) + (1 << 12), 1 << 40)] == [3, 3, 4, 6]


def test_mixing(spark, docs, real, nothing):
    for table in (docs, real):
        rows = [r.asDict() for r in mixing.mix(table).collect()]
        assert len(rows) == table.count()
        by = collections.defaultdict(list)
        for r in rows:
            by[r["source"]].append(r)
        total = sum(r["size"] for r in rows)
        names = sorted((s for s in by if s is not None)) + [None] * (None in by)
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        cap, target = {s: 3 * sum(r["size"] for r in by[s]) for s in names}, {}
        free = set(names)
        while True:
            left = total - sum(target.values())
            over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > cap[s]]
            if not over:
                target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
                break
            target |= {s: cap[s] for s in over}
            free -= set(over)
        for s in names:
            assert by[s][0]["target"] == pytest.approx(target[s])
            assert abs(sum(r["taken"] for r in by[s]) - target[s]) <= 0.5
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(nothing).count() == 0


def test_pipeline(spark, real):
    import corpus_pipeline as c

    docs = real
    seen = [docs.count()]
    for name, stage in c.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns == real.columns
        docs = c.as_table(docs, name)
        seen.append(docs.count())
        ids, was = {r["doc_id"] for r in docs.collect()}, {r["doc_id"] for r in before.collect()}
        assert ids <= was
        if name == "near_dedup":
            group = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(before).collect()}
            assert ids == set(group.values())
    assert seen[0] >= seen[1] >= seen[2] >= seen[3] > 0
    assert {r["doc_id"] for r in c.STAGES[-1][1](spark, docs, SF).collect()} == ids


def test_pipeline_stages_on_awkward_rows(spark, docs, nothing):
    """Null ids, repeated rows, texts without words and clashing column names; each stage keeps the columns and whole rows."""
    import corpus_pipeline as c

    stages, rows = dict(c.STAGES), collections.Counter(map(tuple, docs.collect()))
    for name in ("language", "toxicity", "near_dedup", "mixing"):
        assert stages[name](spark, nothing, SF).count() == 0
        kept = stages[name](spark, docs, SF)
        assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= set(rows)
    one = collections.Counter(tuple(r)[0] for r in stages["near_dedup"](spark, docs, SF).collect())
    groups = collections.defaultdict(list)
    for r in simhash.near_duplicates(docs).collect():
        groups[r["component_id"]].append(r["doc_id"])
    assert one == collections.Counter(list(groups))
    repeated = docs.where("doc_id = 6")
    assert repeated.count() == 2 and stages["near_dedup"](spark, repeated, SF).count() == 1
    alone = docs.where("doc_id is null")
    for name in ("language", "toxicity", "near_dedup", "mixing"):
        assert stages[name](spark, alone, SF).count() >= (name != "language")


def test_pipeline_of_nothing(spark, real, tmp_path):
    import corpus_pipeline as c

    real.where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert c.run(spark, str(tmp_path)).count() == 0


def test_pipeline_decisions(spark, real):
    """Each stage's decision against its operator's own verdict, document by document."""
    import corpus_pipeline as c

    stages, ids = dict(c.STAGES), lambda df: collections.Counter(r["doc_id"] for r in df.select("doc_id").collect())
    languages = {r["doc_id"]: r for r in lang_id.identify(real).collect()}
    least = c.LEAST_LANGUAGE_LEAD / len({r["lang_pred"] for r in languages.values()} - {"und"})
    assert ids(stages["language"](spark, real, SF)) == collections.Counter(i for i, r in languages.items() if r["lang_pred"] != "und" and r["score"] >= least)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(stages["toxicity"](spark, real, SF)) == collections.Counter(r["doc_id"] for r in toxicity.judge(real, labels).collect() if not r["predicted"])
    want = collections.Counter({r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in mixing.mix(real).collect() if r["size"]})
    assert ids(stages["mixing"](spark, real, SF)) == +want
