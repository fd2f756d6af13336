"""Ratings of a stream of games, kept as keyed state.

Every pool is a key of the state store, and its ratings are a map from player to rating, held in RocksDB. A
batch reads and writes the entries of the players in it and no others; the rated games are appended by the
stream's own file sink, so a batch that is run again after a failure is written once. Nothing is copied from
batch to batch.

Games must arrive in order; within a batch any order will do. The games of one pool in one batch are rated by one
task, so a batch's size (files or records per trigger of the source) bounds what a task holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from formline.operators.ratings import BASE, K, home_score

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "ratings"
_LATE = (1 << 63) - 1  # a game without an order comes last
_PACK = "pool string, players array<string>, home array<int>, away array<int>, seq array<long>, score array<double>"


def _rater(base: float, k: float) -> StatefulProcessor:
    """The processor as a value, so that workers need no copy of this package."""
    name = _STATE

    class Rater(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.ratings = handle.getMapState(name, "player string", "rating double")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            seat, parts = {}, []
            for packs in rows:
                for players, *games in zip(*[packs[c] for c in ("players", "home", "away", "seq", "score")]):
                    own = np.array([*[seat.setdefault(p, len(seat)) for p in players], -1], "int64")
                    home, away, seq, score = games
                    parts.append((own[np.asarray(home, "int64")], own[np.asarray(away, "int64")], np.asarray(seq, "int64"), np.asarray(score, "float64")))
            home, away, seq, score = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(seq, kind="stable")
            home, away, seq, score = home[order], away[order], seq[order], score[order]
            sides = (home >= 0) & (away >= 0) & (home != away)
            names, held = list(seat), [base] * len(seat)
            playing = np.unique(np.concatenate([home[sides], away[sides]])).tolist()
            for p in playing:
                if self.ratings.containsKey((names[p],)):
                    held[p] = self.ratings.getValue((names[p],))[0]
            hosts, guests = [], []
            for h, a, won in zip(home[sides].tolist(), away[sides].tolist(), score[sides].tolist()):
                x, y = held[h], held[a]
                hosts.append(x)
                guests.append(y)
                expect = 1.0 / (1.0 + 10.0 ** ((y - x) / 400.0))
                held[h] += k * (won - expect)
                held[a] += k * ((1.0 - won) - (1.0 - expect))
            for p in playing:
                self.ratings.updateValue((names[p],), (float(held[p]),))
            rated = np.full((len(seq), 2), np.nan)
            rated[sides, 0], rated[sides, 1] = hosts, guests
            for at in range(0, len(seq), 100_000):
                cut = slice(at, at + 100_000)
                yield pd.DataFrame({"seq": seq[cut], "home_elo": rated[cut, 0], "away_elo": rated[cut, 1]})

        def close(self) -> None:
            pass

    return Rater()


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every batch one row per pool, its games as arrays and its players by their place in a list (-1: none)."""
    for batch in batches:
        packs = []
        for pool, games in batch.groupby("pool", dropna=False, sort=False):
            sides = pd.concat([games["home"], games["away"]], ignore_index=True)
            codes, players = pd.factorize(sides)
            home, away = codes[: len(games)].astype("int32"), codes[len(games) :].astype("int32")
            pool = None if pd.isna(pool) else pool
            packs.append((pool, list(players), home, away, games["seq"].to_numpy(), games["score"].to_numpy()))
        if packs:
            yield pd.DataFrame(packs, columns=["pool", "players", "home", "away", "seq", "score"])


def rate_stream(
    games: DataFrame,
    out_path: str,
    checkpoint: str,
    order: str,
    home: str,
    away: str,
    outcome: str,
    pool: str | None = None,
    base: float = BASE,
    k: float = K,
) -> DataFrame:
    """Rate all games that are there; returns ``order, home_elo, away_elo`` of every batch so far.

    Games without a pool value form one pool. A game without one of its sides, or of a player against itself,
    is rated null.
    """
    spark = games.sparkSession
    text = lambda c: F.col(c).cast("string")
    # The rows reach the processor as named tuples, in which a name must not begin with an underscore.
    rows = games.select(
        F.coalesce(F.col(order).cast("long"), F.lit(_LATE)).alias("seq"),
        (text(pool) if pool else F.lit("")).alias("pool"),
        text(home).alias("home"),
        text(away).alias("away"),
        home_score(outcome).alias("score"),
    )
    # A row at a time costs the processor more than rating it, so the games travel to it in packs.
    packed = rows.mapInPandas(_pack, _PACK)
    rated = packed.groupBy("pool").transformWithStateInPandas(
        _rater(base, k), "seq long, home_elo double, away_elo double", "Append", "None"
    )
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        query = (
            rated.withColumn("seq", F.nullif(F.col("seq"), F.lit(_LATE)))
            .withColumnRenamed("seq", order)
            .writeStream.format("parquet")
            .option("path", f"{out_path}/games")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)
    return spark.read.schema(f"{order} long, home_elo double, away_elo double").parquet(f"{out_path}/games")


def final_ratings(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The ratings after the newest batch, read from the state store."""
    state = spark.read.format("statestore").option("stateVarName", _STATE).load(checkpoint)
    return state.select(
        F.col("key.pool").alias("pool"), F.col("user_map_key.player").alias("player"), F.col("user_map_value.rating").alias("rating")
    )
