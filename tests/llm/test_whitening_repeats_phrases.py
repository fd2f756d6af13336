"""Whitening, repeated byte strings and phrases against brute force, and defined results for odd input."""

import hashlib
import itertools
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.llm import collocations, suffix_sort, whitening
from formline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


# Whitening


def exact_fit(rows):
    """n, S and the covariance of the distinct quantised vectors, as fractions."""
    distinct = sorted({tuple(x) for x in rows})
    n, size = len(distinct), len(distinct[0])
    sums = [sum(x[d] for x in distinct) for d in range(size)]
    mean = [Fraction(s, n) for s in sums]
    cov = [[sum((x[i] - mean[i]) * (x[j] - mean[j]) for x in distinct) / n for j in range(size)] for i in range(size)]
    return n, sums, cov


def quantise(v):
    return [int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v]


def check_whitened(rows, found, components=16):
    n, sums, cov = exact_fit([quantise(v) for _, v in rows])
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(sum(cov[i][i] for i in range(len(cov))))
    by_row = {(r.vec_id, r.component): r for r in found}
    assert len(by_row) == len(found) == len(rows) * min(components, len(values))
    for (i, v), k in itertools.product(rows, range(min(components, len(values)))):
        r = by_row[i, k + 1]
        x = quantise(v)
        assert r.n == n and r.deviation == r.deviation_exact == sum((n * a - s) ** 2 for a, s in zip(x, sums))
        centred = np.array([float(a - Fraction(s, n)) for a, s in zip(x, sums)])
        assert abs(abs(r.whitened) - abs(centred @ vectors[:, k]) / np.sqrt(values[k])) < 1e-8
        assert abs(r.explained - values[k] / trace) < 1e-10 and r.identity_error < 1e-8


def vectors(seed=0, count=300, size=20):
    random = np.random.default_rng(seed)
    mix = random.normal(size=(size, size))
    rows = [(i, [float(np.float32(c)) for c in mix @ random.normal(size=size) / 8]) for i in range(count)]
    return rows + [(count + i, rows[i % 3][1]) for i in range(40)]


def test_whitening_equals_exact_fractions(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5).withColumn("_x", F.lit(1))
    check_whitened(rows, whitening.whiten(frame.withColumn("component", F.lit("c"))).collect())


def test_whitening_of_the_table(spark):
    out = QUERIES["op11_bit_sliced_whitening"](spark, SMALL)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect() if r.embedding]
    check_whitened(rows, out.collect())


def test_bit_planes_count_products():
    random = np.random.default_rng(1)
    y = random.integers(0, 300, (130, 3)).astype(np.uint64)
    words = whitening.bit_planes(y, [9, 9, 9])
    total = sum(int(np.bitwise_count(words[a] & words[9 + b]).sum()) << (a + b) for a in range(9) for b in range(9))
    assert total == int((y[:, 0] * y[:, 1]).sum())


def test_whitening_odd_input(spark):
    rows = vectors(2, 60, 4)
    odd = [(None, rows[0][1]), (900, None), (901, []), (902, [float("nan")] * 4), (903, [None] * 4), (904, [1.0] * 5)]
    odd += [(905, [float("inf"), 0.0, 0.0, 0.0]), (5, rows[5][1])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    found = whitening.whiten(frame).collect()
    assert len(found) == (len(rows) + 2) * 4 and {r.vec_id for r in found} == {i for i, _ in rows} | {None}
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(frame.where("vec_id = 1")).count() == 0  # no variance
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], "vec_id long, embedding array<float>")
    found = whitening.whiten(flat).collect()
    assert {r.component for r in found} == {1} and len(found) == 9 and found[0].identity_error < 1e-9


def test_whitening_of_huge_entries_is_exact(spark):
    rows = [(i, [float(np.float32(c)) for c in (i * 1e12, (i * i % 17) * 3e14, i % 5)]) for i in range(40)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    n, sums, _ = exact_fit([quantise(v) for _, v in rows])
    for r in found:
        exact = sum((n * a - s) ** 2 for a, s in zip(quantise(rows[r.vec_id][1]), sums))
        assert int(r.deviation_exact) == exact and r.deviation == (exact if exact < 2**63 else None)
    far = spark.createDataFrame([(i, [float(i), 3e38 * (i % 2), -3e38]) for i in range(6)], "vec_id long, embedding array<float>")
    assert {r.vec_id for r in whitening.whiten(far).collect()} == set(range(6))


# Repeated byte strings


def brute_repeats(rows):
    order = lambda i: 2**63 - 1 if i is None else i
    first: dict[bytes, int] = {}
    for i, t in rows:
        b = (t or "").encode()
        for a in range(len(b) - 49):
            first[b[a : a + 50]] = min(first.get(b[a : a + 50], order(i)), order(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - 49):
            if first[b[a : a + 50]] < order(i):
                gone[a : a + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest(frame):
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    rows = frame.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect()
    return sorted(map(tuple, rows), key=str)


def repeats():
    random = np.random.default_rng(4)
    text = lambda n: "".join(random.choice(list("ab é\n"), n))
    shared = [text(n) for n in (49, 50, 51, 90, 400)]
    rows = [(i, text(30) + shared[i % 5] + text(20) + shared[i % 3]) for i in range(60)]
    rows += [(100 + i, "a" * n) for i, n in enumerate((49, 50, 60, 500, 500))]
    rows += [(110, "ab" * 200), (111, "ba" * 100), (112, shared[4]), (112, shared[4]), (112, shared[3] + shared[4])]
    rows += [(None, shared[4]), (None, shared[2] + "x"), (113, None), (114, ""), (115, shared[4][:80] + shared[4][40:])]
    common = "\nSubscribe to our newsletter now\n"
    return rows + [(200 + i, text(40) + common + text(40) + common) for i in range(50)]


@pytest.mark.parametrize("hot", [suffix_sort.HOT, 1])
def test_repeats_equal_brute_force(spark, hot):
    rows = repeats()
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("_chunk", F.lit(2))
    assert digest(suffix_sort.remove_repeats(frame.repartition(7), hot=hot)) == brute_repeats(rows)


def test_repeats_across_segments(spark, monkeypatch):
    random = np.random.default_rng(5)
    long = "".join(random.choice(list("abcdefgh "), 5000))
    data, starts = np.frombuffer((long * 2).encode(), np.uint8), np.array([0, 5000, 10000])
    whole = suffix_sort.digit_runs(data, starts)
    monkeypatch.setattr(suffix_sort, "SEGMENT", 700)
    cut = suffix_sort.digit_runs(data, starts)
    spread = lambda runs: [(d, b + k) for d, b, n, _ in zip(*runs) for k in range(n)]
    assert spread(whole) == spread(cut) and len(spread(whole)) == 2 * (5000 - 49)


def test_digits_are_functions_of_the_window():
    random = np.random.default_rng(6)
    data = random.integers(97, 100, 3000, dtype=np.uint8)
    data[1000:1400] = data[2000:2400]
    hashes = suffix_sort.piece_hashes(data)
    pieces = [data[a : a + suffix_sort.PIECE].tobytes() for a in range(len(data) - suffix_sort.PIECE + 1)]
    assert len(hashes) == len(pieces) and len(dict(zip(pieces, hashes.tolist()))) == len(set(zip(pieces, hashes.tolist())))
    assert len(set(hashes.tolist())) == len(set(pieces))
    digits, begin, count, owner = suffix_sort.digit_runs(data, np.array([0, 1500, 1500, 1520, 3000]))
    spread = {b + k: d for d, b, n in zip(digits.tolist(), begin.tolist(), count.tolist()) for k in range(n)}
    assert [spread[a] for a in range(1000, 1351)] == [spread[a] for a in range(2000, 2351)]
    assert set(spread) == {*range(1451), *range(1520, 2951)} and owner.tolist() == [0 if b < 1500 else 3 for b in begin.tolist()]
    assert all(len(x) == 0 for x in suffix_sort.digit_runs(data[:0], np.array([0, 0])))
    label, digit = random.integers(0, 200_000, 5000), random.integers(0, 3, 5000, dtype=np.uint64)
    order = suffix_sort.sorted_pairs(label, digit)
    assert sorted(zip(label.tolist(), digit.tolist())) == list(zip(label[order].tolist(), digit[order].tolist()))


def test_repeats_odd_input(spark):
    rows = repeats()
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert suffix_sort.remove_repeats(empty).collect() == []
    short = spark.createDataFrame([(1, "x"), (2, None), (None, "x" * 49)], "doc_id int, text string")
    assert digest(suffix_sort.remove_repeats(short)) == brute_repeats([(1, "x"), (2, None), (None, "x" * 49)])
    long = [(1, " ".join(f"wort{i}" for i in range(300_000))), (2, " ".join(f"wort{i}" for i in range(150_000, 160_000)))]
    out = {r.doc_id: r for r in suffix_sort.remove_repeats(spark.createDataFrame(long, "doc_id long, text string")).collect()}
    assert out[2].spans[0].end == len(long[1][1]) and out[2].kept == b"" and out[1].spans == []
    with pytest.raises(TypeError):
        suffix_sort.remove_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
    assert len(rows) == len({id(r) for r in rows})


def test_repeats_of_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = QUERIES["op12_suffix_sort"](spark, SMALL).collect()
    assert sorted(map(tuple, found), key=str) == brute_repeats([(r.doc_id, r.text) for r in docs.collect()])


# Phrases


def brute_phrases(rows, least, top, longest=4):
    import re
    from collections import Counter

    counts: dict[str, Counter] = {}
    for lang, t in rows:
        held = counts.setdefault("und" if lang is None else lang, Counter())
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                held.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, held in counts.items():
        n = sum(c for p, c in held.items() if len(p) == 1)
        candidates = {p: c for p, c in held.items() if len(p) > 1 and c >= least}
        rows = []
        for p, a in candidates.items():
            score, k = min((2_000_000 * a // (held[p[:k]] + held[p[k:]]), k) for k in range(1, len(p)))
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if not any(len(q) > len(p) and 100 * c >= 80 * a and inside(q) for q, c in candidates.items()):
                rows.append((-score, -a, " ".join(p).encode(), held[p[:k]], held[p[k:]]))
        for rank, (score, a, phrase, low, high) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, low, high, n, -score))
    return sorted(out)


def spoken():
    random = np.random.default_rng(6)
    pool = [*"abcdefgh", "É", "ß", "日本", "x\x85y", "Foo", "foo"]
    rows = []
    for i in range(400):
        words = random.choice(pool, random.integers(0, 40))
        text = "".join(w + random.choice([" ", " ", " ", "  \t", ". ", "\n", ",", "!?"]) for w in words)
        rows.append(([None, "en", "und", "d\ne"][i % 4], text + " the quick Brown fox " * int(random.integers(0, 3))))
    return rows + [("en", None), ("fr", ""), ("en", "...,,"), (None, None), ("en", "w" * 100_000)]


@pytest.mark.parametrize("least,top", [(3, 2000), (30, 5)])
def test_phrases_equal_brute_force(spark, least, top):
    rows = spoken()
    frame = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("_body", F.lit(2))
    found = collocations.collocations(frame.repartition(5), least=least, top=top)
    assert sorted(map(tuple, found.collect())) == brute_phrases(rows, least, top)


def test_colliding_fingerprints_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(collocations, "_mixed", lambda keys: keys & np.uint64(0xFF))
    chunk = collocations.ch.Chunk(0, [["en"]], np.frombuffer(b"a b c d " * 9 + b"e f g h " * 5, np.uint8), np.array([0, 112]))
    grams = collocations.grams_of(chunk, 2)
    assert len(set(collocations.word_numbers(grams).tolist())) == 8
    chunk.replies = [{0: collocations.ch.compressed(b"\1" * len(np.unique(grams.prints)))}]
    sums: dict[bytes, int] = {}
    for _, blob in collocations.ask_phrases(chunk, 6, 2):
        raw = collocations.ch.plain(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        ends = 8 + 16 * n + np.cumsum(np.frombuffer(raw, np.int64, n, 8))
        for a, b, t in zip([8 + 16 * n, *ends[:-1].tolist()], ends.tolist(), np.frombuffer(raw, np.int64, n, 8 + 8 * n).tolist()):
            sums[raw[a:b]] = sums.get(raw[a:b], 0) + t
    words = (b"a b c d " * 9 + b"e f g h " * 5).split()
    pairs = list(zip(words, words[1:]))
    assert sums == {
        b"\nen": len(words),
        **{w + b"\nen": words.count(w) for w in set(words)},
        **{b" ".join(p) + b"\nen": pairs.count(p) for p in set(pairs)},
    }


def test_phrases_odd_input(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(empty).count() == 0
    nothing = spark.createDataFrame([(None, None), ("", "en"), (" . \n", "en")], "text string, lang string")
    assert collocations.collocations(nothing).count() == 0
    exact = spark.createDataFrame([("a b",)] * 30 + [("c d",)] * 29, "text string").withColumn("lang", F.lit(None).cast("string"))
    assert [tuple(r) for r in collocations.collocations(exact).collect()] == [("und", 1, "a b", 30, 30, 30, 118, 1_000_000)]


def test_large_counts_stay_exact(spark):
    big = 3 * 10**17
    rows = [("en", "a", 1, big + 1), ("en", "b", 1, big), ("en", "a b", 2, big - 7)]
    found = collocations.scored_candidates(spark.createDataFrame(rows, "lang string, phrase string, words int, f long")).first()
    assert found.score == 2_000_000 * (big - 7) // (2 * big + 1)
