"""Pairwise (Elo) ratings over an ordered table of games.

A rating depends on every earlier game of both sides, so no window frame can
express it and a single group would run in one task. The games of each pool are
numbered in order and cut into chunks of ``chunk`` games. Pass ``n`` plays chunk
``n`` of every pool at once, from the ratings the earlier chunks left behind:

1. Beforehand and for all chunks at once, the games of a chunk are put into
   parts that share no player (connected players stay together, small groups
   are dealt out evenly), and each game gets its wave: one more than the later
   one of its sides' previous games in the chunk. Games of one wave have no
   player in common.
2. Per chunk and player in it (a seat), the chunk in which that player appears
   next is found beforehand.
3. A pass plays the parts of its chunk side by side, and a part wave by wave
   where waves are wide. It writes the rated games, and each seat's rating with
   the chunk that will read it.
4. The next pass reads its own games, its own seats and the ratings that the earlier passes left for it.

More than ``PASSES`` chunks are played several to a pass, so that the rounds of the driver do not grow with the
table: a pool's games of the pass are then one ordered stream in one task, which holds its seats and a batch of games.

Every game is played once, so the work is linear in the games and the result is
that of a plain loop. Pools and unconnected players run side by side; players
who all meet are sequential by nature, so the passes are those of the longest
pool. No group ever holds more than one chunk of one pool in memory, and all
state between passes is a stored table.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from formline.operators.sequence import sequence_within
from formline.session import scratch_path

BASE = 1500.0
K = 20.0
CHUNK = 262_144

# A chunk is dealt into at most PARTS parts of about PART games; a wave is played at once from WIDE games on average.
PARTS, PART, WIDE = 32, 4096, 24
BLOCK = 1 << 19  # games of a stream whose sides are found among the seats at once
PASSES = 48  # of more chunks than this, several are played in one pass

_LAST = -2  # no later chunk: a final rating
_OUT = "_order long, home_elo double, away_elo double, _pool string, _player string, _rating double, _next long, _kind int"
_GAMES = "_order long, _pool string, _home string, _away string, _score double, _part int, _wave int, _chunk long"


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(",") if c.strip()]


def home_score(outcome: str) -> Column:
    """1 for a home win, 0 for an away win, one half otherwise."""
    return F.when(F.col(outcome) == "H", 1.0).when(F.col(outcome) == "A", 0.0).otherwise(0.5)


def expected_score(own: Column, other: Column) -> Column:
    """The logistic expectation of ``own`` against ``other``."""
    return 1.0 / (1.0 + F.pow(F.lit(10.0), (other - own) / 400.0))


def elo_ratings(
    df: DataFrame,
    order: str,
    home: str,
    away: str,
    outcome: str,
    pool: str | None = None,
    base: float = BASE,
    k: float = K,
    chunk: int = CHUNK,
    starts: DataFrame | None = None,
) -> DataFrame:
    """Pre-game ratings of both sides: ``order, home_elo, away_elo``.

    ``order`` must be unique and integral (see ``assign_sequence``); gaps of any
    size are fine. Players are rated within ``pool``; without one, all games
    share a pool, and games without a pool value form one of their own.
    ``starts`` (``_pool, _player, _rating``) continues from earlier ratings. A
    game without one of its sides, or of a player against itself, is rated null.
    """
    return elo_with_final(df, order, home, away, outcome, pool, base, k, chunk, starts)[0]


def elo_with_final(
    df: DataFrame,
    order: str,
    home: str,
    away: str,
    outcome: str,
    pool: str | None = None,
    base: float = BASE,
    k: float = K,
    chunk: int = CHUNK,
    starts: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """As ``elo_ratings``, and the final rating of each player that played: ``_pool, _player, _rating``."""
    sides = F.coalesce(F.col(home).cast("string") != F.col(away).cast("string"), F.lit(False))
    games = df.where(sides).select(
        F.col(order).cast("long").alias("_order"),
        (F.col(pool) if pool else F.lit("")).cast("string").alias("_pool"),
        F.col(home).cast("string").alias("_home"),
        F.col(away).cast("string").alias("_away"),
        home_score(outcome).alias("_score"),
    )
    numbered = sequence_within(games, "_pool", ["_order"], "_rank")
    longest = numbered.agg(F.max("_rank")).first()[0] or 0
    span = max(1, math.ceil(longest / chunk / PASSES))  # chunks in a pass
    chunked = numbered.withColumn("_chunk", F.floor((F.col("_rank") - 1) / (chunk * span)).cast("long")).drop("_rank")
    if span > 1:
        dealt = chunked.withColumns({"_part": F.lit(0), "_wave": F.lit(0)}).select(*_columns(_GAMES))
    else:
        dealt = chunked.groupBy("_pool", "_chunk").applyInPandas(_dealer(PARTS, PART), _GAMES)
    games = _store_by(dealt, "_chunk", "elo-games")
    played, final = _passes(games, _store_by(_seats(games, starts, base), "_chunk", "elo-seats"), k, span > 1)
    rated = played.select(F.col("_order").alias(order), "home_elo", "away_elo")
    unplayed = df.where(~sides).select(
        F.col(order).cast("long").alias(order),
        F.lit(None).cast("double").alias("home_elo"),
        F.lit(None).cast("double").alias("away_elo"),
    )
    return rated.unionByName(unplayed), final


def _store_by(df: DataFrame, key: str, label: str) -> DataFrame:
    """Stored with a folder per value of ``key``, so that a pass reads its own chunk only.

    Rows of one value are brought together first, in partitions of an even size, so a folder has few files.
    """
    path = scratch_path(df.sparkSession, label)
    df.hint("rebalance", key).write.partitionBy(key).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _seats(games: DataFrame, starts: DataFrame | None, base: float) -> DataFrame:
    """One row per chunk and player in it: the chunk that needs the rating next, and a first seat's rating."""
    career = Window.partitionBy("_pool", "_player").orderBy("_chunk")
    seats = (
        games.select("_chunk", "_pool", "_part", F.explode(F.array("_home", "_away")).alias("_player"))
        .distinct()
        .withColumn("_first", F.lag("_chunk").over(career).isNull())
        .withColumn("_next", F.coalesce(F.lead("_chunk").over(career), F.lit(_LAST)).cast("long"))
    )
    given = F.lit(base)
    if starts is not None:
        seats = _with_ratings(seats, starts, "_given")
        given = F.coalesce("_given", given)
    return seats.select("_chunk", "_pool", "_part", "_player", "_next", F.when(F.col("_first"), given).alias("_rating"))


def _with_ratings(seats: DataFrame, ratings: DataFrame, name: str) -> DataFrame:
    known = ratings.select(
        F.col("_pool").alias("_of_pool"), F.col("_player").alias("_of_player"), F.col("_rating").alias(name)
    )
    same = F.col("_pool").eqNullSafe(F.col("_of_pool")) & (F.col("_player") == F.col("_of_player"))
    return seats.join(known, same, "left").drop("_of_pool", "_of_player")


def _passes(games: DataFrame, seats: DataFrame, k: float, streamed: bool) -> tuple[DataFrame, DataFrame]:
    """Play the chunks in turn: the rated games and the final ratings of all passes."""
    spark = games.sparkSession
    last = games.agg(F.max("_chunk")).first()[0]
    if last is None:
        nothing = spark.createDataFrame([], _OUT)
        return nothing, nothing.select("_pool", "_player", "_rating")
    path = scratch_path(spark, "elo-passes")
    fold = _fold(k, WIDE)
    for n in range(last + 1):
        begins = seats.where(F.col("_chunk") == n)
        if n:
            carried = spark.read.schema(_OUT).parquet(path).where((F.col("_kind") == 1) & (F.col("_next") == n))
            begins = _with_ratings(begins, carried, "_carried")
            begins = begins.withColumn("_rating", F.coalesce("_carried", "_rating"))
        begins = begins.select("_pool", "_part", "_player", "_next", "_rating")
        chunk = games.where(F.col("_chunk") == n)
        if streamed:
            played = _stream(chunk, begins, k)
        else:
            both = ["_pool", "_part"]
            played = chunk.groupBy(*both).cogroup(begins.groupBy(*both)).applyInPandas(fold, _OUT)
        played.write.partitionBy("_kind").parquet(f"{path}/pass={n}")
    written = spark.read.schema(_OUT).parquet(path)
    final = written.where((F.col("_kind") == 1) & (F.col("_next") == _LAST))
    return written.where("_kind = 0"), final.select("_pool", "_player", "_rating")


def _stream(games: DataFrame, begins: DataFrame, k: float) -> DataFrame:
    """A pass of several chunks: of every pool first the seats, then the games in order, through one task."""
    rows = begins.select("_pool", "_player", "_rating", "_next").unionByName(
        games.select("_pool", "_order", "_home", "_away", "_score"), allowMissingColumns=True
    )
    is_game = F.col("_home").isNotNull().cast("int").alias("_game")
    # As many partitions as parts, said outright: else small pools are put together in one task.
    spread = rows.select(*rows.columns, is_game).repartition(PARTS, "_pool").sortWithinPartitions("_pool", "_game", "_order")
    return spread.mapInArrow(_stream_fold(k, WIDE, BLOCK), _OUT)


def _stream_fold(k: float, wide: int, block: int):
    """A fold over rows in order, by value as ``_fold``: it holds the seats of one pool and a block of its games.

    The games of a block whose sides have no earlier game left in it are played at once, as long as they are many.
    """
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    fields = [c.split() for c in _OUT.split(", ")]

    def shaped(n: int, rows: dict) -> pa.RecordBatch:
        columns = [pa.array(rows[c], kinds[t]) if c in rows else pa.nulls(n, kinds[t]) for c, t in fields]
        return pa.RecordBatch.from_arrays(columns, [c for c, _ in fields])

    def joined(parts: list) -> pa.Array:
        return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

    def numbers(column: pa.Array) -> np.ndarray:
        return column.to_numpy(zero_copy_only=False)

    def one_by_one(home, away, score, held: np.ndarray, before: np.ndarray, rows: np.ndarray) -> None:
        seats, own = np.unique(np.concatenate((home, away)), return_inverse=True)
        now, seen = held[seats].tolist(), []
        for h, a, won in zip(own[: len(home)].tolist(), own[len(home) :].tolist(), score.tolist()):
            x, y = now[h], now[a]
            seen.append((x, y))
            expect = 1.0 / (1.0 + 10.0 ** ((y - x) / 400.0))
            now[h] = x + k * (won - expect)
            now[a] = y + k * ((1.0 - won) - (1.0 - expect))
        held[seats] = now
        before[rows] = seen

    def played(home: np.ndarray, away: np.ndarray, score: np.ndarray, held: np.ndarray, first: np.ndarray) -> np.ndarray:
        before = np.empty((len(home), 2))
        for at in range(0, len(home), 1 << 15):
            left = np.arange(at, min(at + (1 << 15), len(home)))
            while len(left):
                h, a = home[left], away[left]
                both = np.stack((h, a), 1).ravel()
                first[both[::-1]] = np.arange(len(both) - 1, -1, -1) >> 1  # of equal seats the earliest game is written last
                place = np.arange(len(left))
                free = (first[h] == place) & (first[a] == place)
                if free.sum() < wide:
                    one_by_one(h, a, score[left], held, before, left)
                    break
                rows, h, a = left[free], h[free], a[free]
                won, x, y = score[rows], held[h], held[a]
                before[rows, 0], before[rows, 1] = x, y
                expect = 1.0 / (1.0 + 10.0 ** ((y - x) / 400.0))
                held[h] = x + k * (won - expect)  # no player twice among them
                held[a] = y + k * ((1.0 - won) - (1.0 - expect))
                left = left[~free]
        return before

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, pool = False, None
        players, held, nexts, first, waiting, rows = [], [], [], None, [], 0

        def seated() -> None:
            nonlocal players, held, nexts, first
            if first is None:
                players, held, nexts = joined(players), np.concatenate(held), np.concatenate(nexts)
                first = np.zeros(len(held), np.int64)

        def play() -> Iterator[pa.RecordBatch]:
            nonlocal waiting, rows
            if waiting:
                seated()
                order, home, away, score = (joined([b.column(c) for b in waiting]) for c in ("_order", "_home", "_away", "_score"))
                sides = [numbers(pc.index_in(side, value_set=players)) for side in (home, away)]
                before = played(*sides, numbers(score), held, first)
                rated = {"_order": order, "home_elo": before[:, 0].copy(), "away_elo": before[:, 1].copy()}
                yield shaped(len(order), rated | {"_kind": np.zeros(len(order), "int32")})
                waiting, rows = [], 0

        def ends() -> Iterator[pa.RecordBatch]:
            yield from play()
            if players:
                seated()
                for at in range(0, len(held), 100_000):
                    cut = slice(at, at + 100_000)
                    n = len(held[cut])
                    last = {"_pool": [pool] * n, "_player": players[cut], "_rating": held[cut], "_next": nexts[cut]}
                    yield shaped(n, last | {"_kind": np.ones(n, "int32")})

        for batch in batches:
            if not batch.num_rows:
                continue
            at = {name: i for i, name in enumerate(batch.schema.names)}
            pools = numbers(batch.column(at["_pool"]).dictionary_encode().indices.fill_null(-1))
            for own in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(pools)) + 1):
                part = batch.slice(own[0], len(own))
                name = part.column(at["_pool"])[0].as_py()
                if not begun or name != pool:
                    yield from ends()
                    begun, pool = True, name
                    players, held, nexts, first = [], [], [], None
                n = int((numbers(part.column(at["_game"])) == 0).sum())  # seats come first
                if n:
                    seats = part.slice(0, n)
                    players.append(seats.column(at["_player"]))
                    held.append(numbers(seats.column(at["_rating"])).astype("float64"))
                    nexts.append(numbers(seats.column(at["_next"])).astype("int64"))
                if n < len(own):
                    waiting.append(part.slice(n))
                    rows += len(own) - n
                if rows >= block:
                    yield from play()
        yield from ends()

    return fold


def _dealer(parts: int, size: int):
    """Parts and waves of one chunk, by value as ``_fold``."""
    columns = _columns(_GAMES)

    def deal(key: tuple, games: pd.DataFrame) -> pd.DataFrame:
        games = games.sort_values("_order")
        codes, players = pd.factorize(pd.concat([games["_home"], games["_away"]], ignore_index=True))
        home, away = codes[: len(games)].tolist(), codes[len(games) :].tolist()
        root, busy, waves = list(range(len(players))), [0] * len(players), []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for h, a in zip(home, away):
            busy[h] = busy[a] = max(busy[h], busy[a]) + 1
            waves.append(busy[h])
            root[find(h)] = find(a)
        groups = pd.Series([find(h) for h in home])
        sizes = groups.value_counts().sort_index().sort_values(ascending=False, kind="stable")
        heap = [(0, i) for i in range(max(1, min(parts, -(-len(games) // size))))]
        part_of = {}
        for group, n in sizes.items():  # the largest group goes to the emptiest part
            held, part = heapq.heappop(heap)
            part_of[group] = part
            heapq.heappush(heap, (held + n, part))
        return games.assign(_part=groups.map(part_of).to_numpy("int32"), _wave=np.array(waves, "int32"))[columns]

    return deal


def _fold(k: float, wide: int):
    """A fold that travels to the workers by value, so they need no copy of this package."""

    def by_game(home: np.ndarray, away: np.ndarray, score: np.ndarray, ratings: np.ndarray) -> np.ndarray:
        held, before = ratings.tolist(), []
        for h, a, won in zip(home.tolist(), away.tolist(), score.tolist()):
            x, y = held[h], held[a]
            before.append((x, y))
            expect = 1.0 / (1.0 + 10.0 ** ((y - x) / 400.0))
            held[h] += k * (won - expect)
            held[a] += k * ((1.0 - won) - (1.0 - expect))
        ratings[:] = held
        return np.array(before)

    def by_wave(home: np.ndarray, away: np.ndarray, score: np.ndarray, ratings: np.ndarray, wave: np.ndarray) -> np.ndarray:
        before = np.empty((len(home), 2))
        order = np.argsort(wave, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(wave[order])) + 1):
            h, a, won = home[rows], away[rows], score[rows]
            x, y = ratings[h], ratings[a]
            before[rows, 0], before[rows, 1] = x, y
            expect = 1.0 / (1.0 + 10.0 ** ((y - x) / 400.0))
            ratings[h] += k * (won - expect)  # no player twice in a wave
            ratings[a] += k * ((1.0 - won) - (1.0 - expect))
        return before

    def fold(key: tuple, played: pd.DataFrame, begins: pd.DataFrame) -> pd.DataFrame:
        """The games of one part with the ratings before each, then the ratings at its end."""
        games = played.sort_values("_order")
        seat = pd.Index(begins["_player"])
        home, away = seat.get_indexer(games["_home"]), seat.get_indexer(games["_away"])
        ratings, wave = begins["_rating"].to_numpy(float).copy(), games["_wave"].to_numpy()
        score = games["_score"].to_numpy(float)
        if len(games) >= wide * len(np.unique(wave)):
            before = by_wave(home, away, score, ratings, wave)
        else:
            before = by_game(home, away, score, ratings)
        rated = pd.DataFrame({"_order": games["_order"].to_numpy(), "home_elo": before[:, 0], "away_elo": before[:, 1]})
        rated["_kind"] = 0
        ends = begins[["_player", "_next"]].assign(_pool=key[0], _rating=ratings, _kind=1)
        both = pd.concat([rated, ends], ignore_index=True)
        both["_order"], both["_next"] = both["_order"].astype("Int64"), both["_next"].astype("Int64")
        return both[["_order", "home_elo", "away_elo", "_pool", "_player", "_rating", "_next", "_kind"]]

    return fold
