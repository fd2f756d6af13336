"""Rolling features, latest values, sequences and slices."""

import math
import random

import pandas as pd
import pytest
import numpy as np
from pyspark.sql import functions as F

from formline.operators.ordered import Lagged, lagged_rolling, latest_or_mean, mean_fill, median_fill, medians
from formline.operators.sequence import assign_sequence, sequence_within
from formline.operators.slices import plan_slices
from formline.operators.stall import stall_stop


def games(n=600, seed=3, teams="ABCDE"):
    """Games in which team A hosts a third of all rows."""
    rnd = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        home = "A" if rnd.random() < 0.34 else rnd.choice(teams)
        away = rnd.choice([t for t in teams if t != home])
        rows.append((i, home, away, rnd.randint(0, 5), rnd.choice("HDA")))
    return pd.DataFrame(rows, columns=["ord", "home", "away", "goals", "ftr"])


def expected_rolling(pdf, key, column, agg, window=5):
    rolled = pdf.sort_values("ord").groupby(key)[column].transform(
        lambda x: getattr(x.shift().rolling(window, min_periods=1), agg)()
    )
    return dict(zip(pdf.sort_values("ord")["ord"], rolled))


ROLES = {
    "home": [Lagged("goals", "home_avg"), Lagged("goals", "home_sum", "sum", 0)],
    "away": [Lagged("goals", "away_avg", fill=None)],
}


@pytest.mark.parametrize("width", [None, 20, 7])
def test_rolling_matches_shifted_rolling_whole_and_sliced(spark, width):
    pdf = games()
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1))
    got = lagged_rolling(df, "ord", ROLES, width=width).toPandas().sort_values("ord")
    assert len(got) == len(pdf)
    mean = pdf.goals.mean()
    home, away = (expected_rolling(pdf, k, "goals", "mean") for k in ("home", "away"))
    total = expected_rolling(pdf, "home", "goals", "sum")
    for row in got.itertuples():
        want = home[row.ord]
        assert row.home_avg == pytest.approx(mean if math.isnan(want) else want)
        assert row.home_sum == (0 if math.isnan(total[row.ord]) else total[row.ord])
        if math.isnan(away[row.ord]):
            assert math.isnan(row.away_avg)
        else:
            assert row.away_avg == pytest.approx(away[row.ord])


@pytest.mark.parametrize("width", [None, 20])
def test_an_order_with_wide_gaps_gives_the_same_and_is_still_cut(spark, width):
    df = spark.createDataFrame(games())
    wide = df.withColumn("ord", F.col("ord") * 10**9)
    want = {r.ord: (r.home_avg, r.home_sum, r.away_avg) for r in lagged_rolling(df, "ord", ROLES, width=width).collect()}
    got = {r.ord // 10**9: (r.home_avg, r.home_sum, r.away_avg) for r in lagged_rolling(wide, "ord", ROLES, width=width).collect()}
    assert got == want
    assert plan_slices(wide, "ord", 5, width).sparse == bool(width)
    assert not plan_slices(df, "ord", 5, width).sparse


@pytest.mark.parametrize("width", [None, 20])
def test_rows_without_a_key_are_in_no_window(spark, width):
    df = spark.createDataFrame(games()).withColumn("home", F.when(F.col("ord") % 10 == 0, F.col("home")))
    roles = {"home": [Lagged("goals", "avg", fill=None)]}
    out = lagged_rolling(df, "ord", roles, width=width)
    assert out.count() == 600 and out.where("home IS NULL AND avg IS NOT NULL").isEmpty()
    want = lagged_rolling(df.where("home IS NOT NULL"), "ord", roles)
    assert {(r.ord, r.avg) for r in out.where("home IS NOT NULL").collect()} == {(r.ord, r.avg) for r in want.collect()}


def test_first_row_takes_the_mean_of_all_rows_or_of_the_training_rows(spark):
    df = spark.createDataFrame([(1, "A", "B", 2), (2, "B", "A", 4)], "ord long, home string, away string, goals int")
    roles = {"home": [Lagged("goals", "avg")]}
    assert {r.avg for r in lagged_rolling(df, "ord", roles).collect()} == {3.0}
    only_first = lagged_rolling(df, "ord", roles, fit_where=F.col("ord") == 1)
    assert {r.avg for r in only_first.collect()} == {2.0}


def test_rolling_rejects_unknown_aggregate(spark):
    with pytest.raises(ValueError):
        lagged_rolling(spark.range(1), "id", {"id": [Lagged("id", "x", "max")]})


def test_slice_width_grows_with_the_table(spark):
    assert plan_slices(spark.range(10), "id").width == 65_536
    assert not plan_slices(spark.range(10), "id").possible
    wide = plan_slices(spark.range(2).select((F.col("id") * 10**12).alias("id")), "id", carried=5)
    assert wide.width == math.isqrt(50 * (10**12 + 1))


def test_latest_by_role_and_mean_for_unseen(spark):
    history = spark.createDataFrame(
        [(1, "A", "B", 1.0, 10.0), (2, "A", "C", 2.0, 20.0), (3, "B", "A", 3.0, 30.0)],
        "ord long, home string, away string, h double, a double",
    )
    requests = spark.createDataFrame([(1, "A", "B"), (2, "C", "A"), (3, "X", "C")], "id int, x string, y string")
    got = latest_or_mean(requests, history, "ord", {"x": ("home", ["h"]), "y": ("away", ["a"])})
    rows = {r.id: (r.h, r.a) for r in got.collect()}
    assert rows == {1: (2.0, 10.0), 2: (2.0, 30.0), 3: (2.0, 20.0)}  # C and X never hosted: mean 2.0


def test_latest_of_a_null_stays_null(spark):
    history = spark.createDataFrame([(1, "A", 1.0), (2, "A", None)], "ord long, k string, v double")
    requests = spark.createDataFrame([("A",)], "k2 string")
    assert latest_or_mean(requests, history, "ord", {"k2": ("k", ["v"])}).first().v is None


@pytest.mark.parametrize("values,median", [([1, 2, 3, 10], 2.5), ([5], 5.0), ([1, 2, 9], 2.0), ([7, 7, 7, 1], 7.0)])
def test_median_is_exact_and_interpolated(spark, values, median):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    filled = median_fill(df, ["v"]).collect()
    assert sorted(r.v for r in filled) == sorted([*map(float, values), median])


def test_median_of_skewed_values_with_outliers(spark):
    rnd = random.Random(5)
    values = [rnd.choice([0.0, 1.0, rnd.gauss(0, 1)]) for _ in range(3000)] + [1e300, -1e300]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").withColumn("null_row", F.col("v").isNull())
    got = median_fill(df, ["v"]).where("null_row").first().v
    assert got == pytest.approx(pd.Series(values).median())


def test_mean_fill(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "v double")
    assert sorted(r.v for r in mean_fill(df, ["v"]).collect()) == [1.0, 2.0, 3.0]


def test_sequence_is_dense_and_ordered_for_any_layout(spark):
    pdf = pd.DataFrame({"k": range(2000)}).sample(frac=1, random_state=2)
    for parts in (1, 8):
        got = assign_sequence(spark.createDataFrame(pdf).repartition(parts), ["k"], partitions=parts).toPandas()
        assert (got.sort_values("k")["seq"] == range(1, 2001)).all()


def test_sequence_within_a_hot_key(spark):
    rows = [("hot", i) for i in range(700)] + [(f"k{i % 9}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int")
    got = sequence_within(df, "k", ["t"]).toPandas()
    want = got.sort_values("t").groupby("k").cumcount() + 1
    assert (got.sort_values("t")["seq"] == want).all()


def brute_stall(losses, patience):
    best, best_step, waited = math.inf, None, 0
    for step, loss in enumerate(losses, 1):
        if loss is not None and loss < best:
            best, best_step, waited = loss, step, 0
        else:
            waited += 1
            if waited >= patience:
                return step, best_step, None if best_step is None else best
    return None, best_step, None if best_step is None else best


@pytest.mark.parametrize("width", [None, 10, 3])
def test_stall_equals_the_loop(spark, width):
    rnd = random.Random(11)
    runs = {1: [1, 0.9, 0.95, 0.8, 0.8, 0.81, 0.82, 0.85, 0.9, 0.7], 2: [3.0, 2.0, 1.0], 3: [None] * 7 + [1.0], 4: [None, 2.0]}
    for run in range(5, 40):
        drift = rnd.choice([0.0, 0.05, 0.3])
        runs[run] = [10 - drift * i + rnd.random() for i in range(rnd.randint(1, 60))]
    rows = [(r, i, None if v is None else float(v)) for r, vs in runs.items() for i, v in enumerate(vs, 1)]
    df = spark.createDataFrame(rows, "run int, epoch int, loss double")
    got = {r.run: (r.stop, r.best_step, r.best) for r in stall_stop(df, "run", "epoch", "loss", width=width).collect()}
    assert got == {r: brute_stall(v, 5) for r, v in runs.items()}
    assert got[1] == (9, 4, 0.8)


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", nan), (3, "a", 3.0), (4, "a", 5.0)], "ord long, k string, v double")
    rolled = lagged_rolling(df, "ord", {"k": [Lagged("v", "m")]})
    assert [r.m for r in rolled.orderBy("ord").collect()] == [3.0, 1.0, 1.0, 2.0]
    holes = spark.createDataFrame([(1.0,), (3.0,), (nan,), (None,)], "v double")
    assert sorted(r.v for r in mean_fill(holes, ["v"]).collect()) == [1.0, 2.0, 2.0, 3.0]
    assert sorted(r.v for r in median_fill(holes, ["v"]).collect()) == [1.0, 2.0, 2.0, 3.0]


def test_medians_from_marks_of_many_tasks(spark, monkeypatch):
    from formline.operators import ordered

    monkeypatch.setattr(ordered, "_SORTED", 6000)  # several sorts in a task
    random = np.random.default_rng(8)
    n = 50_001
    frame = pd.DataFrame(
        {
            "even": random.normal(size=n),
            "late": np.sort(random.lognormal(size=n)),  # every task has values of its own
            "tied": random.integers(0, 3, n).astype(float),
            "split": np.where(np.arange(n) % 2 == 0, -1e300, random.random(n)),
            "rare": np.where(np.arange(n) % 10 == 0, random.random(n), np.nan),
        }
    )
    df = spark.createDataFrame(frame).repartitionByRange(7, "late")
    found = medians(df, list(frame.columns))
    assert {c: found[c] for c in frame} == {c: float(np.nanmedian(frame[c])) for c in frame}
    # The bracket stays narrow: what is ranked value by value is a small part of the rows.
    values = df.select(F.nanvl("even", F.lit(None)).alias("v0"))
    marks = values.mapInArrow(ordered._marks(1, ordered._MARKS, 6000), "i int, v binary, w binary")
    ends = ordered._middles(0.002)(marks.toPandas()).iloc[0]
    inside = frame["even"].between(ends["low"], ends["high"]).sum()
    assert ends["n"] == n and 0 < inside < n / 100


def test_medians_of_several_columns_at_once(spark):
    random = np.random.default_rng(7)
    columns = {
        "a": random.normal(size=5000),
        "b": np.round(random.exponential(size=5000), 1),
        "c": np.full(5000, 3.5),
        "d": np.where(np.arange(5000) % 2 == 0, 1.0, 2.0),
        "e": np.full(5000, np.nan),
    }
    pdf = pd.DataFrame(columns)
    pdf.loc[::7, ["a", "b"]] = np.nan
    df = spark.createDataFrame(pdf).repartition(3)
    found = medians(df, list(columns))
    want = {c: pdf[c].median() for c in columns}
    assert found["e"] is None and all(found[c] == pytest.approx(want[c], abs=1e-12) for c in "abcd")
    filled = median_fill(df, ["a", "b"])
    assert filled.columns == df.columns and filled.where("isnan(a) or a is null").count() == 0
    assert medians(df.limit(0), ["a", "b"]) == {"a": None, "b": None} and medians(df, []) == {}


def test_rows_of_one_very_long_key_are_not_brought_together(spark):
    df = spark.range(5000).select(F.lit("x").alias("k"), (F.col("id") * 7919 % 5000).alias("t")).repartition(7)
    got = sequence_within(df.unionByName(spark.createDataFrame([(None, 5), (None, 3)], "k string, t long")), "k", ["t"])
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r.t): r.seq for r in got.collect()} == {("x", i): i + 1 for i in range(5000)} | {(None, 3): 1, (None, 5): 2}


def test_roles_whose_keys_are_long_share_one_shuffle_of_the_rows(spark):
    pdf = games()
    pdf.loc[[40, 41, 300], "home"] = None
    pdf.loc[[40, 90], "away"] = None
    df = spark.createDataFrame(pdf).repartition(4)
    roles = ROLES | {"away": [Lagged("goals", "away_avg", fill=None), Lagged("goals", "away_sum", "sum", 0)]}
    cut, whole = lagged_rolling(df, "ord", roles, width=50), lagged_rolling(df, "ord", roles)
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
    assert set(cut.columns) == set(whole.columns) and cut.count() == len(pdf)
    assert cut.select(whole.columns).exceptAll(whole).isEmpty()
    # Very many short keys beside a long one stay whole: cut, they would repeat their rows.
    many = df.withColumn("home", F.when(F.col("ord") % 2 == 0, F.col("ord").cast("string")).otherwise(F.col("home")))
    apart = lagged_rolling(many, "ord", roles, width=50)
    assert "RepartitionByExpression" not in apart._jdf.queryExecution().optimizedPlan().toString()
    assert apart.exceptAll(lagged_rolling(many, "ord", roles).select(apart.columns)).isEmpty()
