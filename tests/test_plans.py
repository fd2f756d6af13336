"""Feature, model and answer jobs on small inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from formline.functions.outcomes import CLASS_NAMES
from formline.operators import metrics, splits
from formline.plans import fixtures, match_model, multitarget, outside_model, text_model
from formline.plans.fixtures import STATS
from formline.session import store


@pytest.fixture(scope="module")
def games(spark):
    rnd = random.Random(1)
    teams = ["Ash", "Bay", "Cove", "Dale"]
    rows = []
    for i in range(1, 401):
        home, away = rnd.sample(teams, 2)
        strong = teams.index(home) < teams.index(away)
        goals = (rnd.randint(1, 4), rnd.randint(0, 2)) if strong else (rnd.randint(0, 2), rnd.randint(1, 4))
        result = "H" if goals[0] > goals[1] else "A" if goals[0] < goals[1] else "D"
        rows.append((i, home, away, result, *goals, *[rnd.randint(0, 9) for _ in STATS[2:]]))
    columns = ["match_id", "home", "away", "ftr", *STATS]
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="module")
def featured(games):
    return store(match_model.match_features(games), "features")


def test_features_are_complete_and_first_game_has_no_past(featured):
    assert len(match_model.FEATURES) == len(set(match_model.FEATURES)) == 30
    assert featured.count() == 400
    assert featured.na.drop("any").count() == 400
    first = featured.where("match_id = 1").first()
    assert (first.home_elo, first.away_elo, first.home_form, first.away_form) == (1500.0, 1500.0, 0, 0)
    assert first.home_avg_fthg == pytest.approx(featured.agg(F.avg("fthg")).first()[0])


def test_away_form_counts_the_hosts_points_and_own_form_the_away_sides(games):
    rolled = match_model.rolling_features(games.where("away = 'Dale'"))
    two = rolled.orderBy("match_id").limit(2).collect()
    points = {"H": 3, "D": 1, "A": 0}
    assert two[1].away_form == points[two[0].ftr]
    assert two[1].away_form_own == {"H": 0, "D": 1, "A": 3}[two[0].ftr]


def test_models_learn_and_answer_requests(spark, featured):
    parts = match_model.assemble(splits.split_80_20(featured, "match_id"))
    teams = match_model.team_index(featured)
    models = match_model.fit_models(parts.where("split = 'train'"), teams, rounds=3, depth=3)
    scored = match_model.score_outcome(models.outcome, parts.where("split = 'test'"))
    assert scored.count() == 80
    assert metrics.accuracy(scored, "ftr_enc", "y_hat").first().accuracy > 0.5
    report = metrics.class_report(scored, "ftr_enc", "y_hat", CLASS_NAMES)
    assert "Home Win" in {r.label for r in report.collect()}
    requests = spark.createDataFrame(
        [(1, "Ash", "Dale"), (2, "Ash", "Dale"), (3, "Bay", "Bay"), (4, "Ash", "Nowhere")],
        "req_id int, home string, away string",
    )
    rows = {r.req_id: r for r in match_model.answer_requests(requests, featured, models).collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert rows[4].reason == "unknown away team" and rows[4].p_home is None and rows[4].top is None
    for row in (rows[i] for i in (1, 2, 3)):
        assert row.reason is None and len(row.top) == 3 and row.top[0].score == row.scoreline
        assert row.top[0].share >= row.top[1].share >= row.top[2].share > 0
        assert row.p_home + row.p_draw + row.p_away == pytest.approx(1.0)
    assert rows[1].games > 0 and rows[3].games == 0
    assert rows[1].answer == rows[2].answer and rows[1].answer.startswith("Home Win: ")
    assert rows[1].pred_fthg > rows[1].pred_ftag
    # A team that joins later moves no number of the fitted ones and is not known to the models.
    newer = featured.withColumn("home", F.when(F.col("match_id") == 400, "Aaa").otherwise(F.col("home")))
    asked = requests.unionAll(spark.createDataFrame([(5, "Aaa", "Ash")], requests.schema))
    again = {r.req_id: r for r in match_model.answer_requests(asked, newer, models).collect()}
    inputs = match_model.request_features(requests.where("req_id = 1"), newer, models.teams).first()
    assert (inputs.home_enc, inputs.away_enc) == (0, 3)
    assert again[5].reason == "unknown home team"


def test_text_model_tells_two_vocabularies_apart(spark):
    rnd = random.Random(2)
    bags = (["river", "stone", "wind"], ["gold", "miracle", "secret"])
    rows = [(i, " ".join(rnd.choices(bags[i % 2], k=20)), i % 2) for i in range(200)]
    news = spark.createDataFrame(rows, "doc_id int, text string, label int")
    model = text_model.fit_text_model(news.where("doc_id < 150"), rounds=5)
    scored = text_model.score_texts(model, news.where("doc_id >= 150"))
    assert metrics.accuracy(scored, "label", "y_hat").first().accuracy == 1.0
    fresh = spark.createDataFrame([(1, "wind stone"), (2, None)], "doc_id int, text string")
    verdicts = {r.doc_id: r.verdict for r in text_model.score_texts(model, fresh).collect()}
    assert verdicts[1] == "REAL" and verdicts[2] in ("REAL", "FAKE")


def test_multitarget_models_skip_unlabelled_targets_and_unparsed_rows(spark):
    rows = [(i, float(i), 3.0 * i if i % 2 else None, None) for i in range(100)] + [(100, None, None, None)]
    samples = spark.createDataFrame(rows, "id int, f double, a double, b double")
    models = multitarget.fit_targets(samples, ["f"], ["a", "b"], reg=0.0)
    assert models["b"] is None
    got = {r.id: (r.pred_a, r.pred_b) for r in multitarget.predict_targets(samples, models, ["f"], "id").collect()}
    assert len(got) == 100
    assert got[10][0] == pytest.approx(30.0) and got[10][1] is None


def test_all_targets_from_one_scan_equal_separate_fits(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(400):
        x, z = rnd.gauss(1e4, 3), rnd.random()
        y = 2 * x - 5 * z + 3 + rnd.gauss(0, 0.1)
        rows.append((i, x, z, 7.0, y if i % 3 else None, -y if i % 2 else float("nan"), None, y if i == 5 else None))
    samples = spark.createDataFrame(rows, "id int, x double, z double, k double, a double, b double, c double, d double")
    models = multitarget.fit_targets(samples, ["x", "z", "k"], ["a", "b", "c", "d"], reg=0.0)
    for target, column, sign in (("a", 4, 1), ("b", 5, -1)):
        held = [r for r in rows if r[column] is not None and r[column] == r[column]]
        plain = np.linalg.lstsq(np.array([[1, r[1], r[2]] for r in held]), np.array([r[column] for r in held]), rcond=None)[0]
        model = models[target]
        assert model.n == len(held) and model.weights[:2] == pytest.approx(plain[1:], rel=1e-6)
        assert model.weights[2] == 0 and model.intercept == pytest.approx(plain[0], abs=1e-2)
    assert models["c"] is None and models["d"].n == 1  # one row: its own value
    scored = {r.id: r for r in multitarget.predict_targets(samples, models, ["x", "z", "k"], "id").collect()}
    assert scored[5].pred_d == pytest.approx(rows[5][4] if rows[5][4] else rows[5][7]) and scored[0].pred_c is None
    assert multitarget.fit_targets(samples.limit(0), ["x"], ["a"]) == {"a": None}


def test_outside_models_score_in_batches(spark):
    def load():
        import numpy

        def predict(vector, number):
            assert len(vector) <= 32 and vector.shape[1:] == (3,)
            return numpy.stack([vector.sum(1) + number, number], 1)

        return predict

    rows = [(i, [float(i), 1.0, 2.0], i % 5) for i in range(100)]
    odd = [(100, None, 1), (101, [1.0, None, 2.0], 1), (102, [1.0], 1), (103, [1.0, 1.0, 1.0], None)]
    df = spark.createDataFrame(rows + odd, "id int, v array<double>, n int").repartition(2)
    got = {r.id: r.score for r in outside_model.score_batches(df, load, ["v", "n"], shapes=[[3], None], outputs=2).collect()}
    assert all(got[i] == [i + 3.0 + i % 5, float(i % 5)] for i in range(100)) and all(got[i] is None for i in range(100, 104))


def test_shared_tables_follow_their_input(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t.parquet")
    build = lambda: fixtures.table(spark, str(tmp_path), "t")
    assert fixtures.prepared(spark, str(tmp_path), "copy", build).count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/t.parquet")
    assert fixtures.prepared(spark, str(tmp_path), "copy", build).count() == 5


@pytest.fixture(scope="module")
def results(spark):
    """Three classes that depend on two inputs, with noise and uneven shares."""
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        a, b, noise = rnd.random(), rnd.random(), rnd.random()
        cls = 0 if a > 0.55 else 2 if b > 0.6 else 1
        rows.append((i, a, b, rnd.random(), cls if noise > 0.15 else rnd.choice([0, 1, 2])))
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, ftr_enc int")
    return match_model.assemble(df, ["a", "b", "c"]).select("id", "features", "ftr_enc")


def test_three_class_boosting_beats_the_forest_and_the_shares(results):
    train, test = results.where("id % 4 > 0"), results.where("id % 4 = 0")
    boosted = match_model.score_outcome(match_model.fit_outcome(train, rounds=12, depth=3), test)
    forest = match_model.score_outcome(match_model.fit_forest(train, trees=12, depth=3), test)
    assert set(results.columns) < set(boosted.columns) and "margins" not in boosted.columns
    total = F.col("p_home") + F.col("p_draw") + F.col("p_away")
    assert boosted.where((F.abs(total - 1) > 1e-9) | (F.least("p_home", "p_draw", "p_away") < 0)).count() == 0
    loss, plain = (match_model.log_loss(s, train).first() for s in (boosted, forest))
    assert loss.n == test.count() and loss.log_loss < plain.log_loss < plain.shares_loss
    assert metrics.accuracy(boosted, "ftr_enc", "y_hat").first().accuracy > 0.8


def test_boosting_is_by_default_a_hundred_rounds():
    assert match_model.ROUNDS == 100 and match_model.fit_outcome.__defaults__[0] == 100


def test_boosting_with_two_of_three_classes(results):
    model = match_model.fit_outcome(results.where("ftr_enc < 2"), rounds=2, depth=2)
    assert sorted(model.boosters) == [0, 1]
    rows = match_model.score_outcome(model, results.limit(20)).collect()
    assert all(r.y_hat in (0, 1) and not r.p_away for r in rows)


def test_raw_games_become_complete_inputs(games):
    raw = games.withColumn("ftr", F.when(F.col("match_id") % 50 != 0, F.col("ftr"))).withColumn(
        "hst", F.when(F.col("match_id") % 40 == 1, float("nan")).otherwise(F.col("hst").cast("double"))
    )
    ready = match_model.raw_match_features(raw.withColumn("referee", F.lit(None).cast("string")))
    assert "referee" not in ready.columns and ready.count() == 400 - 8 - 10
    assert ready.select(*match_model.FEATURES, "ftr_enc").na.drop("any").count() == ready.count()


def test_games_are_sorted_as_narrow_rows_and_widened_afterwards(spark, monkeypatch, tmp_path):
    lines = [(o, n, 10 * o + n, n % 3, float(n + o % 5), f"199{4 + o % 3}-01-0{n}") for o in range(1, 40) for n in range(1, 6)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, day string"
    made = {
        "lineitem": spark.createDataFrame(lines, schema).withColumn("l_shipdate", F.to_date("day")).drop("day"),
        "orders": spark.createDataFrame([(o, o % 4) for o in range(1, 40)], "o_orderkey long, o_custkey long"),
        "customer": spark.createDataFrame([(c, c) for c in range(4)], "c_custkey long, c_nationkey int"),
        "supplier": spark.createDataFrame([(s, s) for s in range(3)], "s_suppkey long, s_nationkey int"),
        "nation": spark.createDataFrame([(n, f"N{n}") for n in range(4)], "n_nationkey int, n_name string"),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    widths, number = [], fixtures.assign_sequence
    monkeypatch.setattr(fixtures, "assign_sequence", lambda df, *a: widths.append(len(df.columns)) or number(df, *a))
    got = fixtures.matches(spark, str(tmp_path)).orderBy("match_id")
    assert widths == [len(fixtures.MATCH_ORDER) + 3]
    want = fixtures.unordered_matches(spark, str(tmp_path)).orderBy(*fixtures.MATCH_ORDER).drop(*fixtures.MATCH_ORDER)
    assert got.columns == [*want.columns, "match_id"] and want.count() > 100
    assert [tuple(r) for r in got.collect()] == [(*r, i) for i, r in enumerate(want.collect(), 1)]


def test_raw_features_are_computed_once_and_stored(games):
    got = match_model.raw_match_features(games)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
    assert got.count() == match_model.clean_games(games).count()


def test_both_goal_models_are_fitted_side_by_side(spark, games, monkeypatch, tmp_path):
    from threading import Barrier

    from formline.plans import queries

    ready = match_model.assemble(games.withColumn("x", F.col("hs").cast("double")), ["x"])
    monkeypatch.setattr(queries, "_split_features", lambda *a: (ready.withColumn("ftr_enc", F.lit(0)), ready))
    monkeypatch.setattr(fixtures, "prepared", lambda s, d, name, build: build())
    both, fit = Barrier(2, timeout=60), match_model.fit_goals
    monkeypatch.setattr(match_model, "fit_goals", lambda train, target: both.wait() is not None and fit(train, target, 2, 2))
    got = queries._scored_goals(spark, str(tmp_path))
    assert got.columns == ["match_id", "fthg", "ftag", "pred_fthg", "pred_ftag"] and got.na.drop("any").count() == 400
