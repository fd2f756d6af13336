"""Operators on documents: brute force, held-out accuracy, and defined results for odd input."""

import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.llm import crf, hmm, langid, license_scan, line_frequency, mixing, packing, simhash
from formline.llm.common import word_bounds, word_keys
from formline.llm.queries import QUERIES

SMALL, MIDDLE, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rate string, copy int, _row int, kept int"
LONG = " ".join(f"wort{i % 977} und{i % 13}" for i in range(40_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, null ids and sources, repeated rows, a very long text, clashing column names."""
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (4, "one two three four five six seven eight nine ten eleven", "en", "a", 1),
        (4, "one two three four five six seven eight nine ten eleven", "en", "a", 1),
        (5, LONG, "de", None, 1),
        (None, "the the the the the the the the the the the the", None, "b", 1),
        (7, "1234 !!! ...", "en", "b", 1),
        (8, "Released under the MIT License.\nA line with words in it and more words again.", "en", "a", 1),
    ]
    return spark.createDataFrame([(*r, 0.5, "r", 3, 4, 5) for r in rows], SCHEMA).repartition(3)


def read(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_words_and_keys_agree_with_split():
    texts = ["A b\tc", "", " x ", "ÄÖ z\x0b\x0cq", "tail ", "É e É"]
    raw = [t.encode() for t in texts]
    data, starts = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    begin, end, first = word_bounds(data, starts)
    found = [bytes(data[a:b]) for a, b in zip(begin, end)]
    assert found == [w for r in raw for w in r.split()]
    assert np.diff(first).tolist() == [len(r.split()) for r in raw]
    keys = dict(zip(word_keys(data, begin, end).tolist(), (w.lower() for w in found)))
    assert len(keys) == len({w.lower() for w in found})


# Quality: conditional random field


def test_marginals_equal_enumeration():
    random = np.random.default_rng(0)
    evidence, edges, chains = random.normal(size=7), random.normal(size=(2, 2)), np.array([0, 4, 5, 7])
    good, pairs, log_z = crf.marginals(evidence, edges, chains)
    total, expected, transitions, z_sum = 0.0, np.zeros(7), np.zeros((2, 2)), 0.0
    for low, high in zip(chains, chains[1:]):
        z, mass, moved = 0.0, np.zeros(high - low), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=high - low):
            score = sum((2 * y - 1) * evidence[low + i] / 2 for i, y in enumerate(path))
            score += sum(edges[a, b] for a, b in zip(path, path[1:]))
            w = math.exp(score)
            z += w
            mass += w * np.array(path)
            for a, b in zip(path, path[1:]):
                moved[a, b] += w
        expected[low:high] = mass / z
        transitions += moved / z
        z_sum += math.log(z)
    assert np.allclose(good, expected) and np.allclose(pairs, transitions) and math.isclose(log_z, z_sum)


def test_quality_is_learned(spark):
    scored = QUERIES["op1_line_crf"](spark, MIDDLE).join(spark.read.parquet(f"{MIDDLE}/labels.parquet"), "doc_id")
    held = scored.where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.count("*")).first()
    assert held[0] > 0.95 and held[1] > 30
    assert scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_crf_odd_input(spark, odd):
    labels = spark.createDataFrame([(4, 1), (8, 0), (5, 1), (99, 0)], "doc_id long, quality int")
    field = crf.fit(odd, labels)
    rows = {r.doc_id: r for r in crf.score_documents(odd, field).collect()}
    assert len(rows) == 8 and rows[1].score == rows[2].score == rows[3].score == 0.0
    assert rows[4].score > 0.5 > rows[8].score
    assert crf.score_documents(odd.limit(0), field).count() == 0
    assert crf.fit(odd, labels.limit(0)) == 1.0 and crf.fit(odd, labels.where("quality = 0")) == 0.0


def test_crf_sample_holds_one_text_per_id(spark, odd, monkeypatch):
    labels = spark.createDataFrame([(4, 1), (8, 0)], "doc_id long, quality int")
    seen = []
    fit_field = crf.fit_field
    monkeypatch.setattr(crf, "fit_field", lambda *a: seen.append(len(a[2]) - 1) or fit_field(*a))
    once = odd.dropDuplicates(["doc_id"])
    many = odd.unionAll(odd.crossJoin(spark.range(50).select()))
    assert np.allclose(crf.fit(many, labels).weights, crf.fit(once, labels).weights) and seen == [2, 2]


# Packing


def test_fast_ids_equal_the_tokenizers_file():
    encode = packing.Encoder(*packing._vocabulary())
    random = np.random.default_rng(1)
    texts = ["".join(map(chr, range(lo, lo + 64))) for lo in range(0, 0x280, 64)]
    texts += ["a  b\n\n c\t\t", "don't  STOP  12345  x \x85y", "x<|endoftext|>y", "日本 語 z", " " * 50, ""]
    pool = [c for c in map(chr, range(1, 0x280))]
    texts += ["".join(random.choice(pool, 60)) for _ in range(300)]
    texts += ["".join(random.choice(list(" \n\t'sa1!.é"), 80)) for _ in range(300)]
    for text in texts:
        assert encode(text).tolist() == encode.exact.encode(text, add_special_tokens=False).ids


def test_packing_places_every_token_once(spark):
    rows = QUERIES["op2_sum_of_squares"](spark, SMALL).toPandas()
    exact = packing.Encoder(*packing._vocabulary()).exact
    docs = {r.doc_id: r.text for r in read(spark, SMALL).collect()}
    assert set(rows.doc_id) == set(docs)
    for doc_id, pieces in rows.sort_values("piece").groupby("doc_id"):
        ids = np.array([*exact.encode(docs[doc_id] or "", add_special_tokens=False).ids, 0], "<u4")
        assert pieces.piece.tolist() == list(range(len(pieces)))
        assert pieces.start.tolist() == [0, *pieces.length.cumsum().tolist()[:-1]] and pieces.length.sum() == len(ids)
        assert all(pieces.length.iloc[1:] == 2048)
        assert pieces.ids_crc32.tolist() == [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(pieces.start, pieces.length)]
    for _, part in rows.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and part.length.sum() <= 2048
    assert rows.sequence_id.nunique() <= 1.01 * -(-rows.length.sum() // 2048) + 1


def test_sum_of_squares_picks_the_smallest_sum():
    random = np.random.default_rng(2)
    sizes = random.integers(1, 20, 200)
    bins, offsets = packing.sum_of_squares(sizes, 20)
    gaps: dict[int, int] = {}
    for i in np.argsort(-sizes, kind="stable"):
        fitting = {g for g in gaps.values() if g >= sizes[i]}
        value = lambda left: sum(
            list(left.values()).count(g) ** 2 for g in set(left.values()) if g
        )
        if fitting:
            one = {g: next(b for b, x in gaps.items() if x == g) for g in fitting}
            costs = {g: value({**gaps, b: g - sizes[i]}) for g, b in one.items()}
            assert costs[gaps[bins[i]]] == min(costs.values())
        else:
            assert bins[i] not in gaps
        gaps[bins[i]] = gaps.get(bins[i], 20) - sizes[i]
        assert offsets[i] == 20 - gaps[bins[i]] - sizes[i]


def test_packing_odd_input(spark, odd):
    rows = packing.packed_pieces(odd).toPandas()
    assert rows[rows.doc_id == 1].length.tolist() == [1] and rows[rows.doc_id == 4].shape[0] == 2
    assert (rows[rows.doc_id == 5].length.iloc[1:] == 2048).any()
    assert packing.packed_pieces(odd.limit(0)).count() == 0
    joined = packing.packed_ids(odd).select(F.size("ids").alias("n")).toPandas()
    assert joined.n.sum() == rows.length.sum() and joined.n.max() <= 2048


# SimHash


def brute_components(prints: list[int], ids: list) -> dict:
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(prints)), 2):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
                changed = True
    return {i: min(ids[k] for k in range(len(ids)) if label[k] == label[p]) for p, i in enumerate(ids)}


def plain_print(text: str) -> int:
    import xxhash

    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\r", " ")
    words = [w for w in words.replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark):
    rows = QUERIES["op3_simhash_mih"](spark, SMALL).collect()
    docs = {r.doc_id: r.text for r in read(spark, SMALL).collect()}
    assert len(rows) == len(docs)
    assert all(r.fingerprint == f"{plain_print(docs[r.doc_id]):016x}" for r in rows)
    ids = [r.doc_id for r in rows]
    expected = brute_components([int(r.fingerprint, 16) for r in rows], ids)
    assert {r.doc_id: r.component_id for r in rows} == expected


def test_hamming_balls_find_every_pair(spark):
    random = np.random.default_rng(3)
    prints = {int(p) for p in random.integers(-(2**63), 2**63, 40)} | {0, -1, 1, -(2**63), 7}
    for p in list(prints):
        for flips in (1, 2, 3, 3, 4):
            q = p & (2**64 - 1)
            for bit in random.choice(64, flips, replace=False).tolist():
                q ^= 1 << bit
            prints.add(q - 2**64 if q >> 63 else q)
    rows = spark.createDataFrame([(p,) for p in prints], "_print long")
    found = {(r.a, r.b) for r in simhash.near_pairs(rows).collect()}
    ordered = sorted(prints)
    assert found == {(a, b) for a, b in itertools.combinations(ordered, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}


def test_simhash_odd_input(spark, odd):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == 9 and {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}
    kept = simhash.keep_first(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 4").count() == 1 and kept.count() == 6
    assert simhash.simhash_groups(odd.limit(0)).count() == 0 and simhash.keep_first(odd.limit(0)).count() == 0


# Line rules


def test_line_rules_odd_input(spark, odd):
    rows = {r.doc_id: r for r in line_frequency.line_quality(odd).collect()}
    assert len(rows) == 8 and rows[1].base_failed and not rows[1].kept and rows[4].kept
    assert rows[None].n_repeat_words == 12 and rows[None].base_failed
    assert rows[5].n_words == 80_000 and rows[5].n_repeat_words == 80_000
    kept = line_frequency.keep_good(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [4, 4, 8]
    assert line_frequency.line_quality(odd.limit(0)).count() == 0


def test_frequent_lines_are_taken_from_all_but_the_first(spark):
    shared = "this very line stands in many documents of one host and says nothing new"
    rows = [(i, shared if i % 2 else f"{shared}\nwith words of its own that nobody else has ever written here {'x' * (i + 1)}", "h") for i in range(60)]
    rows += [(100 + i, shared + " " * i, "other") for i in range(3)] + [(200, "a b c d e f g h i j k", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in line_frequency.line_quality(docs, max_documents=20).collect()}
    assert out[0].kept and not out[3].kept == (out[3].n_left == 0)
    assert all(out[i].kept for i in range(0, 60, 2)) and all(out[i].kept for i in (100, 101, 102, 200))


def test_repeated_rows_count_a_frequent_line_once_each(spark):
    shared = "one line of eight words that all have"
    rows = [(i, f"{shared}\nown {'x' * (i + 1)} words b c d e f g h i j k", "h") for i in range(30)]
    docs = spark.createDataFrame(rows + rows[20:] * 2, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in line_frequency.line_quality(docs).collect()}
    assert out[0].n_left == 21 and all(out[i].n_left == 13 and out[i].kept for i in range(1, 30))
    assert line_frequency.keep_good(docs).count() == 50


def test_kept_documents_lose_their_frequent_lines(spark):
    shared = "This LINE  stands 7 times"
    own = lambda i: f"words of {'x' * (i + 1)} own a b c d\n\n e f g h i j k  l{'y' * i}\n"
    rows = [(i, f"{shared}\n{own(i)}this line stands {i % 10} times\nend", "h", i) for i in range(30)]
    rows += [(40, f"{shared}\n{own(40)}", "other", 40), (41, f"{own(41)}\n", "h", 41)]
    docs = spark.createDataFrame(rows + rows[7:8], "doc_id long, text string, source string, n long")
    out = line_frequency.keep_good(docs)
    assert out.columns == docs.columns
    # "end" stands in 30 texts of the host too, so it goes with the other two.
    want = [(i, rows[0][1] if not i else own(i).removesuffix("\n"), "h", i) for i in [*range(30), 7]] + rows[30:]
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_no_line_stays_over_the_limit(spark):
    docs = spark.createDataFrame(
        [(i, f"Shared by all.\na b c d e f g h i j k {i}x{'y' * i}", "en", "s", 1) for i in range(40)],
        "doc_id long, text string, lang string, source string, n_chars int",
    )
    import corpus_pipeline

    assert corpus_pipeline.quality_rules(spark, docs, "").where(F.col("text").contains("Shared")).count() == 1


# Mixing


def test_poisson_counts_equal_direct_inversion(spark):
    means = [0.0, 0.01, 0.5, 1.0, 3.7, 40.0, 900.0]
    units = [1e-9, 0.1, 0.3, 0.5, 0.9, 0.999, 1 - 1e-9]
    rows = spark.createDataFrame(list(itertools.product(means, units)), "m double, u double")

    def direct(m, u):
        k, log_p, c = 0, -m, math.exp(-m)
        while c < u and m > 0:
            k += 1
            log_p += math.log(m) - math.log(k)
            c += math.exp(log_p)
        return k

    for r in rows.select("m", "u", mixing.poisson_count(F.col("m"), F.col("u")).alias("k")).collect():
        assert r.k == direct(r.m, r.u), r


def test_mixing_reaches_the_target_weights(spark):
    docs = spark.createDataFrame([(i, "x" * 10, "a" if i % 10 else "b") for i in range(20_000)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, weight double")
    mixed = mixing.mix_sources(docs, targets)
    share = mixed.agg(F.avg((F.col("source") == "b").cast("double")), F.count("*")).first()
    assert abs(share[0] - 0.75) < 0.01 and abs(share[1] - 20_000) < 600
    keys = [r.shuffle_key for r in mixed.select("shuffle_key").collect()]
    assert keys == sorted(keys)


def test_mixing_odd_input(spark, odd):
    mixed = mixing.mix_sources(odd)
    assert set(mixed.columns) == set(odd.columns) | {"rate", "copy", "shuffle_key"}
    assert mixing.replicate(odd).select(*odd.columns).columns == odd.columns
    assert mixing.mix_sources(odd.limit(0)).count() == 0


# License scan


def test_license_scan_finds_long_templates_and_variants(spark):
    words = [f"w{i}" for i in range(200)]
    template = " ".join(words)
    docs = spark.createDataFrame(
        [
            (1, "before " * 30 + template.upper() + " after" * 9),
            (2, " ".join(w if i % 60 else "changed" for i, w in enumerate(words))),
            (3, " ".join(words[:120])),
            (4, None),
            (5, "Text.\nReleased under\tthe MIT License. End"),
        ],
        "doc_id long, text string",
    )
    templates = spark.createDataFrame([("long", template), ("mit", "Released under the MIT License."), ("none", None)], "template_id string, text string")
    found = {(r.doc_id, r.template_id): r.containment for r in license_scan.scan(docs, templates).collect()}
    assert set(found) == {(1, "long"), (2, "long"), (5, "mit")}
    assert found[1, "long"] == 1.0 and 0.8 <= found[2, "long"] < 1
    assert license_scan.scan(docs.limit(0), templates).count() == 0 and license_scan.scan(docs, templates.limit(0)).count() == 0


def test_license_scan_odd_input(spark, odd):
    templates = spark.createDataFrame(list(license_scan.NOTICES.items()), "template_id string, text string")
    assert [(r.doc_id, r.template_id) for r in license_scan.scan(odd, templates).collect()] == [(8, "mit-line")]


def test_license_scan_finds_all_planted_lines(spark):
    planted = {
        "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
        "mit-line": "Released under the MIT License.",
        "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
        "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
        "all-rights-reserved": "All rights reserved.",
    }
    rows = read(spark, MIDDLE).collect()
    want = {(r.doc_id, name) for r in rows for name, line in planted.items() if line in (r.text or "").split("\n")}
    found = {(r.doc_id, r.template_id) for r in QUERIES["op6_license_scan"](spark, MIDDLE).collect()}
    assert {name for _, name in want} == set(planted) and want <= found

    def short(text, size):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}

    key = tuple(b"all rights reserved.".split())
    assert {i for i, name in found if name == "all-rights-reserved"} == {r.doc_id for r in rows if key in short(r.text, 3)}


def test_license_scan_of_slices_and_long_templates(spark, odd):
    words = [f"w{i}" for i in range(900)]
    long = [" ".join(words[a : a + 400]) for a in (0, 250, 500)]
    templates = spark.createDataFrame(
        [(f"t{i}", t) for i, t in enumerate(long)] + [("mit", "Released under the MIT License."), (None, LONG), ("none", None)],
        "template_id string, text string",
    )
    docs = odd.select("doc_id", "text").unionAll(
        spark.createDataFrame([(20, " ".join(words[:700])), (21, "x " + " ".join(words[480:])), (22, " ".join(words[:380]))], "doc_id long, text string")
    )
    whole = sorted(map(tuple, license_scan.scan(docs, templates, template_words=10**6).collect()), key=str)
    assert [(r[0], r[1]) for r in whole] == [(20, "t0"), (20, "t1"), (21, "t2"), (22, "t0"), (5, None), (8, "mit")]
    for limits in ({}, {"template_words": 300}, {"slice_words": 450}, {"slice_words": 1000, "template_words": 10}):
        assert sorted(map(tuple, license_scan.scan(docs, templates, **limits).collect()), key=str) == whole


def test_whole_license_texts_are_templates(spark):
    texts = {name: text for name, text in license_scan.NOTICES.items() if name.endswith("-text")}
    assert len(texts) >= 8
    docs = spark.createDataFrame([(n, f"Some words before.\n{t}\nand after.") for n, t in texts.items()], "doc_id string, text string")
    templates = spark.createDataFrame(list(license_scan.NOTICES.items()), "template_id string, text string")
    found = {(r.doc_id, r.template_id): r.containment for r in license_scan.scan(docs, templates).collect()}
    assert all(found[n, n] == 1.0 for n in texts)


# Hidden Markov model


def small_chain():
    random = np.random.default_rng(4)
    chain = hmm._normal(random.random(2), random.random((2, 2)), random.random((2, hmm.CLASSES)))
    return chain, np.array([5, 9, 5, 0, 7, 0, 0]), np.array([0, 4, 6, 7])


def paths(chain, kinds):
    for path in itertools.product(range(2), repeat=len(kinds)):
        p = chain.start[path[0]] * math.prod(chain.move[a, b] for a, b in zip(path, path[1:]))
        yield path, p * math.prod(chain.emit[z, k] for z, k in zip(path, kinds))


def test_forward_equals_the_sum_over_paths():
    chain, kinds, starts = small_chain()
    logs = hmm.forward_log10(chain, kinds, starts)
    for value, low, high in zip(logs, starts, starts[1:]):
        assert math.isclose(value, math.log10(sum(p for _, p in paths(chain, kinds[low:high]))), rel_tol=1e-12)


def test_expected_counts_equal_the_sum_over_paths():
    chain, kinds, starts = small_chain()
    start, move, emit, likelihood = hmm.expected_counts(chain, kinds, starts)
    log_z = sum(math.log(sum(p for _, p in paths(chain, kinds[a:b]))) for a, b in zip(starts, starts[1:]))
    assert math.isclose(likelihood, log_z, rel_tol=1e-12)
    want_start, want_move, want_emit = np.zeros(2), np.zeros((2, 2)), np.zeros((2, hmm.CLASSES))
    for low, high in zip(starts, starts[1:]):
        z = sum(p for _, p in paths(chain, kinds[low:high]))
        for path, p in paths(chain, kinds[low:high]):
            want_start[path[0]] += p / z
            for a, b in zip(path, path[1:]):
                want_move[a, b] += p / z
            for state, kind in zip(path, kinds[low:high]):
                want_emit[state, kind] += p / z
    assert np.allclose(start, want_start) and np.allclose(move, want_move) and np.allclose(emit, want_emit)


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_counts_of_cut_texts_are_those_of_whole_ones(run):
    random = np.random.default_rng(8)
    chain = hmm._normal(random.random(3), random.random((3, 3)) * 9, random.random((3, hmm.CLASSES)))
    kinds, starts = random.integers(0, 30, 700), np.array([0, 1, 4, 300, 303, 303, 640, 700])
    starts = np.unique(starts)  # every text has its end token
    whole = hmm.expected_counts(chain, kinds, starts, 1000)
    for a, b in zip(whole, hmm.expected_counts(chain, kinds, starts, run)):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-9)
    assert math.isclose(whole[0].sum(), len(starts) - 1) and math.isclose(whole[1].sum(), 700 - len(starts) + 1)


def test_counts_of_a_text_longer_than_a_run_equal_path_enumeration():
    chain, _, _ = small_chain()
    kinds, starts = np.array([5, 9, 5, 5, 7, 9, 9, 7, 5, 0]), np.array([0, 10])
    start, move, emit, _ = hmm.expected_counts(chain, kinds, starts, 3)
    z = sum(p for _, p in paths(chain, kinds))
    want = np.zeros((2, 2))
    for path, p in paths(chain, kinds):
        for a, b in zip(path, path[1:]):
            want[a, b] += p / z
    assert np.allclose(move, want) and math.isclose(start.sum(), 1) and math.isclose(emit.sum(), 10)


def test_every_pass_raises_the_likelihood(spark):
    docs = read(spark, SMALL)
    rows = hmm.class_rows(docs, "text").cache()
    random = np.random.default_rng(9)
    chain = hmm._normal(random.random(3), random.random((3, 3)) * 9, random.random((3, hmm.CLASSES)))
    gained = []
    for _ in range(4):
        chain, likelihood, tokens = hmm.baum_welch(chain, rows)
        gained.append(likelihood / tokens)
    assert gained == sorted(gained) and tokens == sum(len((r.text or "").encode().split()) + 1 for r in docs.collect())
    rows.unpersist()


@pytest.mark.parametrize("head", [hmm.HEAD, 20])
def test_scores_and_base_scores(spark, head):
    docs = read(spark, SMALL)
    train = docs.where("doc_id % 7 != 2")
    rows = {r.doc_id: r for r in hmm.score_texts(docs, train, head=head).collect()}
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in docs.collect()}
    counts: dict = {}
    for doc_id, own in tokens.items():
        if doc_id % 7 != 2:
            for t in own:
                counts[t] = counts.get(t, 0) + 1
    n, v = sum(counts.values()), len(counts)
    gained = 0.0
    for doc_id, own in tokens.items():
        row = rows[doc_id]
        base = sum(math.log10((counts.get(t, 0) + 1) / (n + v + 1)) for t in own)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(own), sum(t in counts for t in own), n)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        gained += row.score - base
    assert gained > 0 and len(rows) == len(tokens)


def test_rare_words_score_as_frequent_ones_do(spark):
    docs = read(spark, SMALL)
    whole, cut = ({r.doc_id: r.score for r in hmm.score_texts(docs, docs, head=h).collect()} for h in (hmm.HEAD, 5))
    assert all(math.isclose(whole[k], cut[k], rel_tol=1e-9) for k in whole)


def test_hmm_odd_input(spark, odd):
    rows = {r.doc_id: r for r in hmm.score_texts(odd, odd.where("doc_id < 8")).collect()}
    assert rows[1].n_tokens == 1 and rows[1].n_known == 1 and rows[5].n_tokens == 80_001
    assert all(r.score < 0 for r in rows.values())
    assert hmm.score_texts(odd.limit(0), odd.limit(0)).count() == 0
    assert all(r.n_known == 0 for r in hmm.score_texts(odd, odd.limit(0)).collect())


# Language ID


def test_languages_are_learned(spark):
    rows = QUERIES["op9_nearest_centroid"](spark, MIDDLE).join(read(spark, MIDDLE).select("doc_id", "lang"), "doc_id")
    right = rows.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.97 and rows.where("score < 0 or score > 1").count() == 0


def test_prediction_equals_a_dense_scan(spark):
    docs = read(spark, SMALL)
    model = langid.fit(docs, sample=30)
    grams = langid.Grams()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in langid.predict(docs, model).collect():
        cosines = model.centroids @ langid._scaled(*grams.counts(texts[row.doc_id]), model.idf)
        assert abs(row.score - cosines.max()) < 1e-5 and row.lang_pred == model.languages[int(cosines.argmax())]


def test_letters_beyond_the_first_plane(spark):
    model = langid.fit(read(spark, SMALL))
    texts = ["😀😀😀", "😀 1 😀", "\U0001d538\U0001d539 \U0001d53b", "😀 the other words", "\U00010400\U00010401"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: r for r in langid.predict(rows, model).collect()}
    assert [found[i].lang_pred == "und" for i in range(5)] == [True, True, False, False, False]
    assert found[0].score == found[1].score == 0.0 and found[0].rejected
    codes = langid.Grams().codes
    assert codes("\U00010400").tolist() == codes("\U00010428").tolist()  # upper and lower case


def test_distant_texts_are_rejected_and_clean_ones_kept(spark):
    import base64
    import random

    docs = line_frequency.keep_good(read(spark, LARGE)).persist()  # as in the pipeline
    model = langid.fit(docs.where("doc_id % 2 = 0"))
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 10)))
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem"
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki"
    odd = [" ".join(word() for _ in range(n)) for n in (50, 300, 2000)]
    odd += [base64.b64encode(draw.randbytes(3000)).decode(), polish, finnish]
    rows = spark.createDataFrame(list(enumerate(odd)), "doc_id int, text string")
    assert all(r.rejected for r in langid.predict(rows, model).collect())
    clean = langid.predict(docs.where("doc_id % 2 = 1"), model)
    assert clean.where("rejected").count() == 0
    docs.unpersist()
    assert list(model.limits) == sorted(model.limits, reverse=True) and model.limits[-1] < model.limits[0] < 1


def test_short_clean_texts_stay_after_the_quality_rules(spark):
    kept = line_frequency.keep_good(read(spark, LARGE))
    model = langid.fit(kept)
    assert langid.keep_known(kept, model).count() == kept.count()


def test_stages_keep_columns_named_like_their_own(spark, odd):
    import corpus_pipeline

    names = """_id _host _key _text _line _line_id _line_host _line_key _gone_lines _row _row_id _row_key _at _print _part _body
        _simhash_row _mix_source _mix_rate _mix_count _mix_key _mix_copy _source _draw _count _lang _tokens _seq""".split()
    names += ["a.b", "c d"]
    wide = odd.select("*", *[F.lit(77 + i).alias(n) for i, n in enumerate(names) if n not in odd.columns])
    kept = [f"`{n}`" for n in names if n not in odd.columns]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, "")
        assert out.columns == wide.columns
        assert {tuple(r) for r in out.select(*kept).collect()} <= {tuple(77 + i for i, n in enumerate(names) if n not in odd.columns)}
    pieces = corpus_pipeline.STAGES[-1][1](spark, wide, "")
    assert pieces.where("piece = 0").count() == odd.count()


def test_langid_odd_input(spark, odd):
    model = langid.fit(odd)
    rows = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert all(rows[k].lang_pred == "und" and rows[k].rejected and rows[k].score == 0 for k in (1, 2, 3, 7))
    assert rows[5].lang_pred == "de" and rows[4].lang_pred == "en"
    kept = langid.keep_known(odd, model)
    assert kept.columns == odd.columns and kept.where("doc_id in (1, 2, 3, 7)").count() == 0
    none = langid.fit(odd.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, none).collect()} == {"und"}
    assert langid.predict(odd.limit(0), model).count() == 0


def test_only_frequent_lines_are_shuffled_a_second_time(spark, monkeypatch):
    from formline.llm import line_frequency as rules

    own = " ".join(f"w{j}" for j in range(12))
    rows = [(i, f"shared line of the host\n{own} text{chr(97 + i % 26) * (i + 1)}", "a" if i % 2 else None) for i in range(60)] + [(60, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    stored, store = [], rules.store
    monkeypatch.setattr(rules, "store", lambda df, label: stored.append(store(df, label)) or stored[-1])
    got = {r.doc_id: r for r in rules.line_quality(docs).collect()}
    assert sorted(tuple(r) for r in stored[0].select("_fhost", "_first").collect() if r[0]) == [("a", 1)]
    assert stored[0].count() == 2 and len(got) == 61
    assert all(r.n_left == r.n_words - (0 if i in (0, 1) else 5) for i, r in got.items() if i < 60)
