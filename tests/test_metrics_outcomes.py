"""Metrics, outcome statistics and merges with literal expectations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.operators import merges, metrics, scorelines


def numpy_wmae(true, pred):
    n = np.array([np.sum(~np.isnan(t)) for t in true])
    r = np.array([np.nanmax(t) - np.nanmin(t) if k else 1.0 for t, k in zip(true, n)])
    root = np.array([math.sqrt(1 / k) if k else 0.0 for k in n])
    w = (1 / r) * len(true) * root / root.sum()
    total = sum(w[j] * np.nansum(np.abs(pred[j] - true[j])) for j in range(len(true)))
    return total / n.sum(), w


def long_frame(spark, true, pred):
    rows = [
        (i, f"p{j}", float(true[j][i]), float(pred[j][i])) for j in range(len(true)) for i in range(len(true[j]))
    ]
    return spark.createDataFrame(rows, "id int, property string, y_true double, y_pred double")


def test_weighted_mae_equals_numpy_with_gaps(spark):
    rnd = np.random.default_rng(3)
    true = rnd.normal(size=(3, 50)) * [[1], [10], [3]]
    true[0, ::3] = np.nan
    true[2, :45] = np.nan
    pred = true + rnd.normal(size=(3, 50))
    pred[np.isnan(pred)] = 0.0
    true4, pred4 = np.vstack([true, np.full((1, 50), np.nan)]), np.vstack([pred, np.zeros((1, 50))])
    want, weights = numpy_wmae(list(true4), list(pred4))
    long = long_frame(spark, true4, pred4)
    row = metrics.weighted_mae(long).first()
    assert row.wmae == pytest.approx(want, rel=1e-12)
    got = {r.property: r.weight for r in metrics.property_weights(long).collect()}
    assert [got[f"p{j}"] for j in range(4)] == pytest.approx(list(weights))


def test_weighted_mae_without_labels_constant_property_or_missing_prediction(spark):
    nan = float("nan")
    assert metrics.weighted_mae(long_frame(spark, [[nan, nan]], [[1.0, 2.0]])).first().wmae is None
    assert metrics.weighted_mae(long_frame(spark, [[2.0, 2.0]], [[1.0, 2.0]])).first().wmae is None
    assert metrics.weighted_mae(long_frame(spark, [[1.0, 3.0]], [[1.0, nan]])).first().wmae is None


def test_batch_loss_is_mean_per_property_over_batch_rows(spark):
    rows = [
        (1, 1, "a", 1.0, 2.0), (1, 2, "a", 3.0, 3.0), (1, 1, "b", None, 9.0), (1, 2, "b", 0.0, 4.0),
        (2, 3, "a", None, 1.0), (2, 3, "b", None, 1.0),
    ]
    long = spark.createDataFrame(rows, "batch_id int, id int, property string, y_true double, y_pred double")
    weights = spark.createDataFrame([("a", 2.0), ("b", 0.5)], "property string, weight double")
    got = {r.batch_id: (r.loss, r.n_rows) for r in metrics.batch_loss(long, weights).collect()}
    assert got == {1: ((2.0 * 0.5 + 0.5 * 4.0) / 2, 2), 2: (0.0, 1)}


def test_class_report_with_a_class_never_predicted_and_one_never_true(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (0, 2), (1, 0)], "y int, p int")
    rows = {r.label: r for r in metrics.class_report(df, "y", "p", {0: "zero"}).collect()}
    assert (rows["zero"].precision, rows["zero"].recall, rows["zero"].support) == pytest.approx((2 / 3, 2 / 3, 3))
    assert (rows["1"].precision, rows["1"].recall, rows["1"].f1, rows["1"].support) == (0, 0, 0, 1)
    assert (rows["2"].precision, rows["2"].support) == (0, 0)
    assert rows["accuracy"].f1 == 0.5 and rows["accuracy"].support == 4
    assert rows["macro avg"].f1 == pytest.approx(2 / 9)
    assert rows["weighted avg"].precision == pytest.approx(0.5)
    assert metrics.accuracy(df, "y", "p").first().accuracy == 0.5


HISTORY = [("A", "B", 1, 0, "H")] * 2 + [("A", "B", 0, 0, "D")] * 2 + [("A", "B", 2, 2, "D"), ("A", "B", 0, 3, "A")] + [
    ("B", "A", 5, 0, "H")
] * 9


@pytest.fixture
def history(spark):
    return spark.createDataFrame(HISTORY, "home string, away string, fthg int, ftag int, ftr string")


@pytest.fixture
def requests(spark):
    return spark.createDataFrame([(1, "A", "B"), (2, "B", "C"), (3, "X", "A")], "req_id int, home string, away string")


def test_top_outcomes_break_ties_by_score_and_fall_back_to_all_rows(history, requests):
    got = scorelines.top_outcomes(history, requests, ["home", "away"], ["fthg", "ftag"]).collect()
    by = {(r.req_id, r["rank"]): (r.fthg, r.ftag, r.prob) for r in got}
    assert len(by) == 9
    assert [by[1, k] for k in (1, 2, 3)] == [(0, 0, 2 / 6), (1, 0, 2 / 6), (0, 3, 1 / 6)]
    assert by[2, 1] == (5, 0, 9 / 15) and by[3, 1] == by[2, 1]


def test_likely_outcome_without_any_history(history, requests):
    got = scorelines.likely_outcome(history.limit(0), requests, ["home", "away"], ["fthg", "ftag"]).collect()
    assert {(r.req_id, r.fthg, r.ftag, r.prob) for r in got} == {(i, 0, 0, 0.0) for i in (1, 2, 3)}


def test_head_to_head_counts_ordered_pairs(history, requests):
    got = {r.req_id: tuple(r)[3:] for r in scorelines.head_to_head(history, requests, ["home", "away"]).collect()}
    assert got == {1: (6, 2, 3, 1), 2: (0, 0, 0, 0), 3: (0, 0, 0, 0)}


def test_requests_split_into_valid_and_rejected(history, requests):
    valid, rejected = scorelines.split_requests(requests, history, "home", "away")
    assert [r.req_id for r in valid.collect()] == [1]
    assert {r.req_id: r.reason for r in rejected.collect()} == {2: "unknown away team", 3: "unknown home team"}


def test_team_list_and_texts(spark, history):
    assert tuple(scorelines.team_list(history, ["home", "away"]).first()) == ("A, B", 2)
    row = spark.range(1).select(
        scorelines.percent(F.lit(0.33333)), scorelines.percent(F.lit(0.00125)), scorelines.score_text(F.lit(2), F.lit(1))
    ).first()
    assert tuple(row) == (f"{0.33333 * 100:.1f}%", f"{0.00125 * 100:.1f}%", "2-1")


def test_outer_merge_matches_null_keys_and_multiplies_duplicates(spark):
    left = spark.createDataFrame([("a", 1.0), (None, 2.0)], "k string, v double")
    right = spark.createDataFrame([(None, 5.0), ("b", 6.0), ("b", 7.0)], "k string, v double")
    got = {(r.k, r.v, r.v_supp) for r in merges.outer_merge(left, right, "k", "match").collect()}
    assert got == {("a", 1.0, None), (None, 2.0, 5.0), ("b", None, 6.0), ("b", None, 7.0)}


def test_outer_merge_keeps_null_keys_unmatched_by_default(spark):
    left = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 3.0)], "k string, v double")
    right = spark.createDataFrame([(None, 5.0), ("a", 6.0)], "k string, v double")
    got = {(r.k, r.v, r.v_supp) for r in merges.outer_merge(left, right, "k").collect()}
    assert got == {("a", 1.0, 6.0), (None, 2.0, None), (None, 3.0, None), (None, None, 5.0)}
    with pytest.raises(ValueError):
        merges.outer_merge(left, right, "k", "drop")


def test_merge_chain_fills_gaps_and_keeps_originals(spark):
    base = spark.createDataFrame([("a", 1.0, None), ("b", None, 2.0)], "k string, tg double, tc double")
    one = spark.createDataFrame([("a", 9.0), ("c", 3.0)], "k string, TC_mean double")
    two = spark.createDataFrame([("b", 4.0), ("a", 8.0)], "k string, tg double")
    bare = spark.createDataFrame([("d",)], "k string")
    got = merges.null_safe_merge(base, [one, bare, two], "k", {"TC_mean": "tc", "tg": "tg"})
    assert {tuple(r) for r in got.select("k", "tg", "tc").collect()} == {
        ("a", 1.0, 9.0), ("b", 4.0, 2.0), ("c", None, 3.0), ("d", None, None),
    }
