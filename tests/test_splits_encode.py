"""Splits, shuffles, label indexes and token sequences."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from formline.functions.outcomes import away_points, away_score, points, result_class
from formline.operators import encode, epochs, shaping, splits
from formline.operators.metrics import argmax


def ranked(keys, seed=42):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{k}:{seed}".encode()).hexdigest(), k))


@pytest.mark.parametrize("n", [1, 2, 10, 399, 3000])
def test_split_sizes_and_members_are_exact(spark, n):
    df = spark.range(n).withColumnRenamed("id", "k")
    order = ranked(range(n))
    test = set(order[: math.ceil(0.2 * n)])
    got = {r.k: r.split for r in splits.split_80_20(df, "k").collect()}
    assert {k for k, v in got.items() if v == "test"} == test
    three = {r.k: r.split for r in splits.split_70_15_15(df, "k").collect()}
    held = math.ceil(0.3 * n)
    half = math.ceil(0.5 * held)
    assert three == {
        k: "test" if i < half else "validation" if i < held else "train" for i, k in enumerate(order)
    }


def test_split_is_the_same_for_every_layout_and_seed_matters(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    one = {r.k: r.split for r in splits.split_80_20(df.repartition(1), "k").collect()}
    many = {r.k: r.split for r in splits.split_80_20(df.orderBy(F.desc("k")).repartition(9), "k").collect()}
    assert one == many
    assert one != {r.k: r.split for r in splits.split_80_20(df, "k", seed=7).collect()}


def test_rows_of_one_key_stay_together(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("k"))
    sides = splits.split_80_20(df, "k").where("k = -1").select("split").distinct().collect()
    assert len(sides) == 1


def test_empty_split(spark):
    assert splits.split_80_20(spark.range(0), "id").count() == 0


def test_shuffle_is_a_permutation_in_hash_order(spark):
    df = spark.range(2500).withColumnRenamed("id", "k")
    got = {r.position: r.k for r in splits.seeded_shuffle(df, "k").collect()}
    assert [got[i] for i in range(1, 2501)] == ranked(range(2500))


def test_label_index_over_two_columns(spark):
    df = spark.createDataFrame([("b", "a"), ("c", "b"), (None, "a")], "x string, y string")
    index = encode.label_index(df, ["x", "y"])
    assert {r.label: r.idx for r in index.collect()} == {"a": 0, "b": 1, "c": 2}
    coded = encode.apply_label_index(df, index, ["x", "y"]).collect()
    assert {(r.x_enc, r.y_enc) for r in coded} == {(1, 0), (2, 1), (None, 0)}


@pytest.mark.parametrize("n", [0, 5, 512, 600])
def test_pad_and_mask(spark, n):
    row = (
        spark.range(1)
        .select(F.array(*[F.lit(i + 1) for i in range(n)]).cast("array<int>").alias("ids"))
        .select(encode.pad(F.col("ids")).alias("p"), encode.pad_mask(F.col("ids")).alias("m"))
        .first()
    )
    used = min(n, 512)
    assert row.p == list(range(1, used + 1)) + [0] * (512 - used)
    assert row.m == [1] * used + [0] * (512 - used)


def test_encoding_marks_unknown_and_empty_texts(spark):
    docs = spark.createDataFrame(
        [(1, "B a, a! b a c"), (2, None), (3, "..."), (4, "é É a")], "id int, text string"
    )
    vocab = encode.vocabulary(docs, size=4 + 2)
    assert {r.token: r.token_id for r in vocab.collect()} == {"a": 4, "b": 5}
    got = {r.id: r for r in encode.encode_texts(docs, vocab, "id", length=8).collect()}
    assert got[1].input_ids == [2, 5, 4, 4, 5, 4, 1, 3]
    assert got[2].input_ids == [2, 1, 3, 0, 0, 0, 0, 0]  # the word "nan"
    assert got[3].input_ids == [2, 3, 0, 0, 0, 0, 0, 0]
    assert got[4].attention_mask == [1, 1, 1, 1, 1, 0, 0, 0]
    assert encode.encode_texts(docs, vocab, "id", length=4).where("id = 1").first().input_ids == [2, 5, 4, 3]


def test_result_maps(spark):
    df = spark.createDataFrame([("H",), ("D",), ("A",), ("X",)], "r string")
    got = df.select(
        result_class("r"), points("r"), away_points("r"), away_score("r")
    ).collect()
    assert [tuple(r) for r in got] == [(0, 3, 0, 0.0), (1, 1, 1, 0.5), (2, 0, 3, 1.0), (None, None, None, 0.5)]


def test_argmax_takes_the_lowest_index_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.7, 0.7],), ([1.0, 1.0],), ([3.0],)], "s array<double>")
    assert [r[0] for r in df.select(argmax(F.col("s"))).collect()] == [1, 0, 0]


def test_shaping(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, float("nan"), "b"), (3, None, "c")], "x int, y double, z string")
    assert shaping.select_existing(df, ["z", "nope", "x"]).columns == ["z", "x"]
    assert [r.x for r in shaping.drop_incomplete(df).collect()] == [1]
    assert shaping.rename_present(df, {"y": "why", "q": "r"}).columns == ["x", "why", "z"]
    assert shaping.columns_with_prefix(df, "x") == ["x"]
    stacked = shaping.stack_tables([df, spark.createDataFrame([("d", 9)], "z string, x int")])
    assert stacked.where("x = 9").first().y is None and stacked.count() == 4


def test_target_vector_and_text(spark):
    df = spark.createDataFrame([(1.0, None, float("nan"))], "a double, b double, c double")
    assert df.select(encode.target_vector(["c", "a", "b"])).first()[0] == [None, 1.0, None]
    texts = spark.createDataFrame([(None,), ("x",)], "t string").select(encode.text_or_nan("t"))
    assert [r[0] for r in texts.collect()] == ["nan", "x"]


def test_rows_without_a_key_count_and_rank_last(spark):
    rows = spark.createDataFrame([(i if i % 2 else None,) for i in range(100)], "k int")
    parts = {r.split: r.n for r in splits.split_80_20(rows, "k").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert parts == {"test": 20, "train": 80}
    places = splits.seeded_shuffle(rows, "k").where("k is null").agg(F.min("position"), F.max("position")).first()
    assert tuple(places) == (51, 100)
    parts = splits.split_70_15_15(rows, "k").where("k is null").select("split").distinct().collect()
    assert [r.split for r in parts] == ["train"]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 32, 97, 1000])
def test_every_epoch_is_a_permutation_in_batches(spark, n):
    rows = spark.range(1, n + 1).withColumnRenamed("id", "no")
    out = epochs.epoch_batches(rows, "no", epochs=4, batch=10, first=1).collect()
    orders = [[r.no for r in sorted(out, key=lambda r: r.position) if r.epoch == e] for e in (1, 2, 3, 4)]
    assert all(sorted(r.position for r in out if r.epoch == e) == list(range(n)) for e in (1, 2, 3, 4))
    assert all(r.batch_id == r.position // 10 for r in out)
    if n > 20:
        assert len({tuple(o) for o in orders}) == 4 and orders[0] != sorted(orders[0])
        moved = sum(abs(a - b) == 1 for o in orders for a, b in zip(o, o[1:]))
        assert moved < 0.2 * 4 * n


def test_radices_leave_few_numbers_beyond_the_last():
    for n in (1, 10, 12_345, 10**6 + 3, 10**9 + 7, 10**12 + 39):
        a, b = epochs.radices(n)
        assert 0 <= a * b - n <= max(8, n**0.5 / 50) and a * b - n < a and a <= 2 * (n**0.5 + 1)


def test_frequent_words_travel_and_rare_ones_are_joined(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i + j) % 7}" for j in range(40)) + f" only{i}") for i in range(50)]
    docs = spark.createDataFrame(rows + [(None, "w1 w2 odd"), (7, "w9 w8 w8"), (60, "")], "id long, text string")
    vocab = encode.vocabulary(docs)
    id_of = {r.token: r.token_id for r in vocab.collect()}
    monkeypatch.setattr(encode, "HEAD", 7)  # w0 to w6
    joined, join = [], type(docs).join
    monkeypatch.setattr(type(docs), "join", lambda self, *a, **b: joined.append(self) or join(self, *a, **b))
    df = encode.encode_texts(docs, vocab, "id", length=64)
    assert joined[2].count() == 54  # words that are shuffled to meet the vocabulary, of 2,056
    got = {r.id: r for r in df.collect()}
    ids = lambda words: [2, *[id_of[w] for w in words], 3]
    for i, text in rows:
        if i != 7:
            want = ids(text.split())
            assert got[i].n_ids == len(want) == 43 and got[i].input_ids == want + [0] * 21 and sum(got[i].attention_mask) == 43
    assert got[None].input_ids[:6] == [*ids(["w1", "w2", "odd"]), 0] and got[60].n_ids == 2
    both = sorted([(p, id_of[w]) for p, w in enumerate(rows[7][1].split())] + [(p, id_of[w]) for p, w in enumerate(["w9", "w8", "w8"])])
    assert got[7].input_ids[:46] == [2, *[i for _, i in both], 3]  # rows of one key are merged place by place
