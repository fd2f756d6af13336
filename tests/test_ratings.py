"""Chunked ratings against a plain loop, and the stream against the table."""

from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from formline.operators import ratings
from formline.operators.ratings import CHUNK, elo_ratings, elo_with_final
from formline.session import scratch_path
from formline.streaming.ratings import _pack, final_ratings, rate_stream
from tests.test_ordered import games


def loop(pdf, pool=None, base=1500.0, k=20.0):
    ratings, out = {}, {}
    for row in pdf.sort_values("ord").to_dict("records"):
        h, a = (row.get(pool), row["home"]), (row.get(pool), row["away"])
        rh, ra = ratings.get(h, base), ratings.get(a, base)
        out[row["ord"]] = (rh, ra)
        expect = 1 / (1 + 10 ** ((ra - rh) / 400))
        won = {"H": 1.0, "A": 0.0}.get(row["ftr"], 0.5)
        ratings[h] = rh + k * (won - expect)
        ratings[a] = ra + k * ((1 - won) - (1 - expect))
    return out, ratings


def collected(df):
    return {r.ord: (r.home_elo, r.away_elo) for r in df.collect()}


def close(got, want, tolerance=1e-8):
    assert got.keys() == want.keys()
    assert max(abs(g - w) for key in want for g, w in zip(got[key], want[key])) <= tolerance


@pytest.mark.parametrize("chunk", [CHUNK, 100, 29])
def test_chunked_equals_loop_single_pool(spark, chunk):
    pdf = games()
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=4))
    close(collected(elo_ratings(df, "ord", "home", "away", "ftr", chunk=chunk)), loop(pdf)[0])


def test_chunks_give_exactly_the_loop(spark):
    pdf = games(120)
    got = elo_ratings(spark.createDataFrame(pdf), "ord", "home", "away", "ftr", chunk=30)
    assert collected(got) == loop(pdf)[0]


def test_pools_are_rated_apart(spark):
    pdf = games(300)
    pdf["league"] = pdf["ord"] % 3
    df = spark.createDataFrame(pdf)
    close(collected(elo_ratings(df, "ord", "home", "away", "ftr", "league", chunk=64)), loop(pdf, "league")[0])


def test_many_players_with_few_games_each(spark):
    pdf = games(400, teams=[f"t{i}" for i in range(90)])
    df = spark.createDataFrame(pdf)
    close(collected(elo_ratings(df, "ord", "home", "away", "ftr", chunk=50)), loop(pdf)[0])


def test_gaps_in_the_order_add_no_passes_and_each_game_is_played_once(spark, monkeypatch):
    paths = []
    monkeypatch.setattr(ratings, "scratch_path", lambda *a: paths.append(scratch_path(*a)) or paths[-1])
    pdf = games(60)
    pdf["ord"] *= 5_000_000_000
    df = spark.createDataFrame(pdf)
    close(collected(elo_ratings(df, "ord", "home", "away", "ftr", chunk=20)), loop(pdf)[0])
    written = spark.read.parquet(paths[-1])
    assert written.agg(F.max("pass")).first()[0] == 2
    assert written.where("_kind = 0").count() == 60


def test_games_without_a_pool_are_a_pool(spark):
    pdf = games(90)
    pdf["league"] = [None if i % 2 else "x" for i in pdf["ord"]]
    df = spark.createDataFrame(pdf, "ord long, home string, away string, goals long, ftr string, league string")
    close(collected(elo_ratings(df, "ord", "home", "away", "ftr", "league", chunk=16)), loop(pdf, "league")[0])


def test_first_game_is_at_the_base_and_ratings_sum_to_it(spark):
    pdf = games(200)
    rated, final = elo_with_final(spark.createDataFrame(pdf), "ord", "home", "away", "ftr", chunk=40)
    assert collected(rated)[1] == (1500.0, 1500.0)
    assert final.agg(F.avg("_rating")).first()[0] == pytest.approx(1500.0)


def test_empty_table(spark):
    df = spark.createDataFrame([], "ord long, home string, away string, ftr string")
    assert elo_ratings(df, "ord", "home", "away", "ftr").count() == 0


def test_stream_continues_ratings_over_batches(spark):
    pdf = games(240)
    arriving, out, offsets = (scratch_path(spark, n) for n in ("in", "out", "offsets"))
    schema = "ord long, home string, away string, goals long, ftr string"
    rated = None
    for low in (0, 80, 160):
        part = pdf[(pdf.ord > low) & (pdf.ord <= low + 80)]
        spark.createDataFrame(part, schema).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(schema).parquet(arriving)
        rated = rate_stream(stream, out, offsets, "ord", "home", "away", "ftr")
    want, ratings = loop(pdf)
    close(collected(rated), want)
    final = {r.player: r.rating for r in final_ratings(spark, offsets).collect()}
    assert final == pytest.approx({t: r for (_, t), r in ratings.items()})


def test_a_game_without_a_side_is_kept_unrated(spark):
    df = spark.createDataFrame([(1, "a", "b", "H"), (2, "a", None, "H"), (3, "a", "b", "A")], "ord long, home string, away string, ftr string")
    got = {r.ord: (r.home_elo, r.away_elo) for r in elo_ratings(df, "ord", "home", "away", "ftr").collect()}
    assert got[2] == (None, None) and got[1] == (1500.0, 1500.0) and got[3] == (1510.0, 1490.0)


def separate(teams=40, games_of_each=30):
    """A pool of pairs of teams that only ever meet each other, in mixed order."""
    random = np.random.default_rng(1)
    pairs = [(f"a{i}", f"b{i}") for i in range(teams)] * games_of_each
    random.shuffle(pairs)
    rows = [(i, h, a, str(random.choice(list("HDA")))) for i, (h, a) in enumerate(pairs, 1)]
    return pd.DataFrame(rows, columns=["ord", "home", "away", "ftr"])


def test_unconnected_teams_of_one_pool_are_played_side_by_side(spark, monkeypatch):
    monkeypatch.setattr(ratings, "PART", 100)
    paths = []
    monkeypatch.setattr(ratings, "scratch_path", lambda *a: paths.append(scratch_path(*a)) or paths[-1])
    pdf = separate()
    close(collected(elo_ratings(spark.createDataFrame(pdf), "ord", "home", "away", "ftr", chunk=500)), loop(pdf)[0])
    dealt = spark.read.parquet(next(p for p in paths if "elo-games" in p))
    parts = dealt.groupBy("_chunk", "_part").agg(F.count("*").alias("n"), F.collect_set("_home").alias("teams")).collect()
    assert {r._chunk for r in parts} == {0, 1, 2}
    for chunk in (0, 1, 2):
        own = [r for r in parts if r._chunk == chunk]
        assert len(own) == (5 if chunk < 2 else 2) and max(r.n for r in own) < 2 * min(r.n for r in own)
        assert sum(len(r.teams) for r in own) == len({t for r in own for t in r.teams})


@pytest.mark.parametrize("wide", [1, 10**9])
def test_waves_equal_the_loop(spark, monkeypatch, wide):
    monkeypatch.setattr(ratings, "WIDE", wide)
    pdf = games(300)
    close(collected(elo_ratings(spark.createDataFrame(pdf), "ord", "home", "away", "ftr", chunk=70)), loop(pdf)[0])


def test_folders_grow_with_the_passes_only(spark, monkeypatch):
    counts = {}
    for chunk in (60, 15):
        paths = []
        monkeypatch.setattr(ratings, "scratch_path", lambda *a: paths.append(scratch_path(*a)) or paths[-1])
        elo_ratings(spark.createDataFrame(games(300)), "ord", "home", "away", "ftr", chunk=chunk).count()
        folder = Path(next(p for p in paths if "elo-passes" in p))
        counts[chunk] = len([p for p in folder.rglob("*") if p.is_dir()])
    assert counts == {60: 5 * 3, 15: 20 * 3}


def test_a_team_against_itself_is_not_rated(spark):
    df = spark.createDataFrame([(1, "a", "b", "H"), (2, "a", "a", "H"), (3, "a", "b", "A")], "ord long, home string, away string, ftr string")
    got = {r.ord: (r.home_elo, r.away_elo) for r in elo_ratings(df, "ord", "home", "away", "ftr").collect()}
    assert got[2] == (None, None) and got[3] == (1510.0, 1490.0)


def test_stream_keeps_one_rating_per_player_of_a_null_pool(spark):
    pdf = games(90)
    pdf["league"] = [None if i % 3 else "x" for i in pdf["ord"]]
    schema = "ord long, home string, away string, goals long, ftr string, league string"
    arriving, out, offsets = (scratch_path(spark, n) for n in ("in", "out", "offsets"))
    for low in (0, 30, 60):
        part = pdf[(pdf.ord > low) & (pdf.ord <= low + 30)]
        spark.createDataFrame(part, schema).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(schema).parquet(arriving)
        rated = rate_stream(stream, out, offsets, "ord", "home", "away", "ftr", "league")
    pdf["league"] = pdf["league"].astype(object).where(pdf["league"].notna(), None)
    want, held = loop(pdf, "league")
    close(collected(rated), want)
    final = [(r.pool, r.player, r.rating) for r in final_ratings(spark, offsets).collect()]
    assert len(final) == len({(p, t) for p, t, _ in final}) == len(held)
    assert {(p, t): r for p, t, r in final} == pytest.approx(held)


def test_a_stream_keeps_games_that_cannot_be_rated(spark):
    rows = [(1, "a", "b", "H"), (2, "a", None, "H"), (3, "c", "c", "A")]
    schema = "ord long, home string, away string, ftr string"
    arriving, out, offsets = (scratch_path(spark, n) for n in ("in", "out", "offsets"))
    spark.createDataFrame(rows, schema).write.parquet(arriving)
    rated = rate_stream(spark.readStream.schema(schema).parquet(arriving), out, offsets, "ord", "home", "away", "ftr")
    assert collected(rated) == {1: (1500.0, 1500.0), 2: (None, None), 3: (None, None)}
    assert {r.player for r in final_ratings(spark, offsets).collect()} == {"a", "b"}


@pytest.mark.parametrize("pool", [None, "league"])
def test_more_chunks_than_passes_are_played_several_to_a_pass(spark, monkeypatch, pool):
    paths = []
    monkeypatch.setattr(ratings, "scratch_path", lambda *a: paths.append(scratch_path(*a)) or paths[-1])
    pdf = games(600, teams=[f"t{i}" for i in range(40)])
    pdf["league"] = [None if i % 3 == 0 else f"x{i % 3}" for i in pdf["ord"]]
    schema = "ord long, home string, away string, goals long, ftr string, league string"
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=4), schema)
    rated, final = elo_with_final(df, "ord", "home", "away", "ftr", pool, chunk=3)  # 200 chunks, or 67 of each pool
    want, held = loop(pdf.astype({"league": object}).where(pdf.notna(), None), pool)
    assert collected(rated) == want
    assert {(r._pool if pool else None, r._player): r._rating for r in final.collect()} == held
    written = spark.read.parquet(next(p for p in paths if "elo-passes" in p))
    assert written.agg(F.max("pass")).first()[0] < ratings.PASSES
    assert written.where("_kind = 0").count() == 600


@pytest.mark.parametrize(("teams", "block"), [(6, 1 << 19), (400, 100), (2000, 700)])
def test_a_stream_of_chunks_plays_games_without_common_sides_at_once(teams, block):
    random = np.random.default_rng(teams)
    pools = ["a", "b", None]
    rows, want = [], {}
    for pool in pools:
        names = [f"t{i}" for i in range(teams)]
        rows += [(pool, None, None, None, None, 0, t, 1500.0 + i % 7, -2) for i, t in enumerate(names)]
        rating = {t: 1500.0 + i % 7 for i, t in enumerate(names)}
        for order in range(900):
            h, a = random.choice(teams, 2, replace=False).tolist()
            won = float(random.choice([0.0, 0.5, 1.0]))
            x, y = rating[names[h]], rating[names[a]]
            want[(pool, order)] = (x, y)
            expect = 1.0 / (1.0 + 10.0 ** ((y - x) / 400.0))
            rating[names[h]], rating[names[a]] = x + 20.0 * (won - expect), y + 20.0 * ((1.0 - won) - (1.0 - expect))
            rows.append((pool, order + 1000 * pools.index(pool), names[h], names[a], won, 1, None, None, None))
        want |= {(pool, t): r for t, r in rating.items()}
    names = ["_pool", "_order", "_home", "_away", "_score", "_game", "_player", "_rating", "_next"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.string(), pa.float64(), pa.int64()]
    table = pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    got, games = {}, []
    for out in ratings._stream_fold(20.0, 24, block)(iter(table.to_batches(max_chunksize=250))):
        games.append(sum(r["_kind"] == 0 for r in out.to_pylist()))
        for r in out.to_pylist():
            if r["_kind"]:
                got[(r["_pool"], r["_player"])] = r["_rating"]
            else:
                got[(pools[r["_order"] // 1000], r["_order"] % 1000)] = (r["home_elo"], r["away_elo"])
    assert got.keys() == want.keys() and max(games) <= max(block + 250, 900)
    assert all(got[key] == pytest.approx(want[key], abs=1e-9) for key in want)


def test_a_batch_of_streamed_games_travels_as_one_row_per_pool():
    rows = [(1, "x", "a", "b", 1.0), (2, None, "a", None, 0.5), (3, "x", "b", "c", 0.0), (4, None, "d", "a", 1.0)]
    (packs,) = _pack(iter([pd.DataFrame(rows, columns=["seq", "pool", "home", "away", "score"])]))
    got = {p.pool: ([list(p.players)[i] if i >= 0 else None for i in [*p.home, *p.away]], list(p.seq)) for p in packs.itertuples()}
    assert got == {"x": (["a", "b", "b", "c"], [1, 3]), None: (["a", "d", None, "a"], [2, 4])}
