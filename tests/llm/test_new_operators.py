"""Decontamination, source divergence and importance resampling against brute force, and on awkward rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from fieldweave.llm import decontamination, divergence, mixing, resampling, warc

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, row long, words string, kept int, score double, start int"


@pytest.fixture(scope="module")
def docs(spark):
    """Null, empty, white, wordless, repeated, tied and very long texts, null ids, and columns whose names clash."""
    long = "the of and tion " * 20000
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "-- !!", "de", "b"), (5, "The of-and to in", "en", "b"), (6, "the of and to in", "en", "b"), (6, "the of and to in", "en", "b"), (None, "der die und", "de", None), (7, long, "en", "c"), (8, "É" * 50_000, "fr", "c")]
    return spark.createDataFrame([(*r, 1, "x", 2, 0.5, 3) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[0-9a-z\x80-\U0010ffff]+", lower)


def brute_hits(text, benchmark, window=10):
    w, hit, met = words(text), set(), set()
    for item, t in benchmark:
        b = words(t)
        n = min(window, len(b))
        grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if b else set()
        for i in range(len(w) - n + 1) if b else ():
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                met.add("" if item is None else str(item))
    return w, hit, met


@pytest.fixture(scope="module")
def planted(spark):
    """A passage, one twice in a row, one at both ends, a short item, a near passage, and a common long word around."""
    filler = [f"w{i}" for i in range(30)]
    p = [f"passage{i}" for i in range(14)]
    bench = [(1, " ".join(p)), (2, "short Item, here"), (3, "the the the the the the the the the the the"), (None, " ".join(reversed(p))), (None, "Unknown one"), (2, "second text of two"), (5, None), (6, "?!"), (7, " ".join(p[2:14]))]
    texts = [" ".join(filler + p + filler), " ".join(p + p), "!! " + "; ".join(p).upper() + " end. Tail", " ".join(p[:9] + filler + p[5:]), "a short item; HERE it is", "the " * 25, " ".join(filler[:3] + ["passage9"] * 40), " ".join(p[:10]), " ".join(reversed(p)) + " unknown ONE second", None, "", "--"]
    return spark.createDataFrame([(i, t, "l", "s", 1, "x", 2, 0.5, 3) for i, t in enumerate(texts)], SCHEMA), spark.createDataFrame(bench, "item_id long, text string")


@pytest.mark.parametrize("sharded", [False, True])
def test_decontamination(spark, real, docs, items, planted, sharded):
    for table, benchmark in ((real, items), (docs, planted[1]), planted):
        most = max(1, decontamination.SET_BYTES // (1 if not sharded else 300 if table is real else 16000))
        bench = [(r["item_id"], r["text"]) for r in benchmark.collect()]
        want = []
        for r in table.collect():
            w, hit, met = brute_hits(r["text"], bench)
            want.append((r["doc_id"], len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
        got = [tuple(r) for r in decontamination.report(table, benchmark, most=most).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
        if table is not docs:
            assert sum(r[2] > 0 for r in want) > 2
    assert not sharded or decontamination.shards(decontamination.windows(planted[1]), most) > 1
    assert decontamination.report(docs, items.where("false")).where("contaminated").count() == 0
    assert decontamination.report(docs.where("false"), items).count() == 0


def test_decontaminated_texts(planted, docs, items):
    table, benchmark = planted
    bench = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    cut = {r["doc_id"]: r for r in decontamination.without_spans(table, benchmark).collect()}
    assert decontamination.without_spans(table, benchmark).columns == table.columns
    for r in table.collect():
        w, hit, _ = brute_hits(r["text"], bench)
        assert words(cut[r["doc_id"]]["text"]) == [x for i, x in enumerate(w) if i not in hit]
        assert cut[r["doc_id"]]["kept"] == 2 and (hit or cut[r["doc_id"]]["text"] == r["text"])
    assert cut[2]["text"] == "!! end. Tail" and cut[4]["text"] == "a it is"
    left = {r["doc_id"] for r in decontamination.without_documents(table, benchmark).collect()}
    assert left == {r["doc_id"] for r in table.collect() if not brute_hits(r["text"], bench)[1]}
    assert {0} == {r["doc_id"] for r in decontamination.without_documents(table, benchmark, least_share=0.2).collect()} - left
    assert decontamination.without_documents(docs, items).count() == docs.count()


def letters(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[a-z\x80-\U0010ffff]+", lower)


def brute_divergence(rows, least):
    per, seen, groups = collections.Counter(), collections.Counter(), set()
    for lang, source, text in rows:
        here = collections.Counter(letters(text))
        groups.add((lang, source))
        for t, n in here.items():
            per[lang, source, t] += n
            seen[lang, t] += 1
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (at, t), n in seen.items() if at == lang and n >= least]
        sources = [s for at, s in groups if at == lang]
        total = {s: sum(per[lang, s, t] for t in kept) for s in sources}
        share = lambda c, n: 1 + 10**9 * (c + 2) // (n + 2 * len(kept))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        p = {(s, t): share(per[lang, s, t], total[s]) for s in sources for t in kept}
        q = {t: share(sum(per[lang, s, t] for s in sources), sum(total.values())) for t in kept}
        for s in sources:
            pairs = [(-sum(f(p[s, t], p[o, t]) for t in kept), o) for o in sources if o != s]
            first = [(-f(p[s, t], q[t]), t.encode()) for t in kept if per[lang, s, t] and p[s, t] > q[t]]
            out += [(lang, s, "pair", o, -v, i) for i, (v, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(sorted(first)[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("least, block, held, sources", [(10, divergence.BLOCK_COUNTS, divergence.HELD, 1000), (2, 4000, 500, 3)])
def test_divergence(spark, monkeypatch, real, docs, least, block, held, sources):
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", sources)
    for table in (real, docs):
        rows = [tuple(x or "" for x in (r["lang"], r["source"], r["text"])) for r in table.collect()]
        got = sorted(tuple(r) for r in divergence.audit(table, least, block).collect())
        assert got == brute_divergence(rows, least)
    assert divergence.audit(docs.where("false")).count() == 0


def test_large_counts_are_exact():
    counts, totals = np.array([0, 5, 10**10, 9 * 10**15]), np.array([7, 11, 3 * 10**10, 10**16])
    assert divergence._shares(counts, totals).tolist() == [1 + 10**9 * (int(c) + 2) // int(t) for c, t in zip(counts, totals, strict=True)]
    assert divergence._shares(counts[:2], totals[:2]).tolist() == [1 + 10**9 * (int(c) + 2) // int(t) for c, t in zip(counts[:2], totals[:2], strict=True)]


def brute_resample(rows, target, share=25, least=20, buckets=10_000):
    def features(text):
        w = [x.encode() for x in words(text)]
        return w, [zlib.crc32(f) % buckets for f in w + [a + b" " + b for a, b in zip(w, w[1:])]]

    s, t = collections.Counter(), collections.Counter()
    found = [(i, *features(text)) for i, text in rows]
    for _, _, f in found:
        s.update(f)
    for text in target:
        t.update(features(text)[1])
    every, wanted = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (every + buckets) / ((s[b] + 1) * (wanted + buckets)))) for b in range(buckets)]
    scored = []
    for i, w, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((len(w) >= least, i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in scored if r[0]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    most = share * len(able) // 100
    return [(*r[1:], i if i <= most else None) for i, r in enumerate(able, 1)] + [(*r[1:], None) for r in scored if not r[0]]


@pytest.mark.parametrize("head_words, head_pairs", [(resampling.HEAD_WORDS, resampling.HEAD_PAIRS), (50, 100), (0, 0)])
def test_resampling(spark, monkeypatch, real, docs, items, head_words, head_pairs):
    monkeypatch.setattr(resampling, "HELD", 2000)
    monkeypatch.setattr(resampling, "TOGETHER", 3000)
    target = [r["text"] for r in items.collect()]
    same = spark.createDataFrame([(5, "one two three " * 10)] * 7 + [(None, "four " * 30)] * 3 + [(6, "five " * 20)] * 2, "doc_id long, text string")
    for table in (real, docs, same):
        want = brute_resample([(r["doc_id"], r["text"]) for r in table.collect()], target)
        got = [tuple(r) for r in resampling.resample(table, items, head_words=head_words, head_pairs=head_pairs).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert resampling.resample(docs.where("false"), items).count() == 0


def test_drawn_rows(spark, real, docs, items):
    chosen = {r["doc_id"] for r in resampling.resample(real, items).where("rank IS NOT NULL").collect()}
    able = sum(len(words(r["text"])) >= 20 for r in real.collect())
    rows = resampling.drawn(real, items)
    assert len(chosen) == able // 4 and rows.columns == real.columns and {r["doc_id"] for r in rows.collect()} == chosen
    assert resampling.drawn(docs, items, share=100).columns == docs.columns
    assert resampling.resample(docs, items.where("false")).count() == docs.count()


def test_stages_keep_columns_of_any_name(spark):
    import corpus_pipeline as c

    names = ["_language_found", "_toxic_score", "_kept_id", "_mix_id", "_mix_copy", "row", "id", "found", "score", "digest", "copies", "component_id", "fp"]
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    wide = rows.selectExpr("*", *[f"{i} AS `{n}`" for i, n in enumerate(names)])
    for name, stage in c.STAGES[:-1]:
        plain = sorted(map(tuple, stage(spark, rows, SF).collect()))
        out = stage(spark, wide, SF)
        assert out.columns == wide.columns
        assert sorted(tuple(r)[: len(rows.columns)] for r in out.collect()) == plain and all(tuple(r)[len(rows.columns) :] == tuple(range(len(names))) for r in out.collect()), name


@pytest.mark.parametrize("hot", [1 << 14, 1])
def test_archive_keeps_the_number_of_rows(spark, monkeypatch, hot):
    """A missing page beside the least number, and payloads of many pages."""
    monkeypatch.setattr(warc, "HOT_PAGES", hot)
    monkeypatch.setattr(warc, "HOT_PAYLOADS", 10**9)
    rows = [(None, "same"), (-(1 << 62), "same"), *[(i, "many" if i % 3 else "") for i in range(30)]]
    pages = spark.createDataFrame([(i, "http://a/", h) for i, h in rows], "page_id long, url string, html string")
    found = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.archive(pages).collect()}
    firsts = {"same": -(1 << 62), "many": 1, "": 0}
    assert len(found) == len(rows)
    assert found == {(i, "response" if i == firsts[h] else "revisit", None if i == firsts[h] else firsts[h]) for i, h in rows}


def test_a_repeated_id_is_mixed_in_its_place(spark):
    """One id on a third of all rows, in a source that is cut within it: as sums along the order of the keys."""
    rows = [(7, "a b c" if i % 2 else "a b", "s") for i in range(300)] + [(i, "x " * (i % 9 + 1), "s" if i % 3 else "t") for i in range(100, 700)] + [(None, "n n", "t")] * 5
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = []
    for source in "st":
        own = sorted((hashlib.md5((str(i) if i is not None else t).encode()).hexdigest(), i or 0, len(t.split()), i) for i, t, s in rows if s == source)
        (target,) = {r["target"] for r in found if r["source"] == source}
        total, at = sum(r[2] for r in own), 0
        epochs, rest = divmod(int(target + 0.5), total)
        for _, _, size, i in own:
            want.append((str(i), source, size, epochs * size + min(max(rest - at, 0), size)))
            at += size
    assert sorted((str(r["doc_id"]), r["source"], r["size"], r["taken"]) for r in found) == sorted(want)
