"""DuckDB twins of the registered queries (same column names, same rounding)."""

from __future__ import annotations

from formline.operators.encode import FIRST_TOKEN_ID, MAX_LENGTH
from formline.operators.epochs import CANDIDATES
from formline.plans.fixtures import CLASSES, STATS
from formline.plans.match_model import FEATURES
from formline.sources.html import AGAINST_TABLE, FOR_TABLE, SEASON_URL


def _i(expr: str) -> str:
    return f"CAST({expr} AS INT)"


_FTHG, _FTAG = "(l_linenumber % 5)", "(CAST(floor(l_quantity) AS INT) % 4)"


def _result(h: str, a: str) -> str:
    return f"CASE WHEN {h} > {a} THEN 'H' WHEN {h} < {a} THEN 'A' ELSE 'D' END"


MATCHES = f"""matches AS MATERIALIZED (
SELECT CAST(row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS match_id,
  {_i('year(l_shipdate)')} AS season, cn.n_name AS home, sn.n_name AS away,
  {_i(_FTHG)} AS fthg, {_i(_FTAG)} AS ftag, {_result(_FTHG, _FTAG)} AS ftr,
  {_i('floor(l_quantity)')} AS hs, {_i('l_linenumber * 3')} AS aws, {_i('l_partkey % 9')} AS hst, {_i('l_suppkey % 9')} AS ast,
  {_i('l_partkey % 12')} AS hc, {_i('l_suppkey % 11')} AS ac, {_i('l_orderkey % 6')} AS hy, {_i('l_partkey % 5')} AS ay,
  {_i('l_orderkey % 2')} AS hr, {_i('l_suppkey % 2')} AS ar
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation sn ON s_nationkey = sn.n_nationkey WHERE cn.n_name <> sn.n_name)"""

REQUESTS = """requests AS MATERIALIZED (
SELECT o_orderkey AS req_id, h.n_name AS home, coalesce(a.n_name, 'UNKNOWN') AS away
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation h ON c_nationkey = h.n_nationkey
LEFT JOIN nation a ON o_orderkey % 27 = a.n_nationkey)"""

SCORED = """scored AS MATERIALIZED (
SELECT o_orderkey AS id, CAST(floor(o_orderkey / 32) AS BIGINT) AS batch_id, 'p' || p.j AS property,
  CASE WHEN p.j = 3 OR o_orderkey % 4 = p.j THEN NULL ELSE o_totalprice * (p.j + 1) END AS y_true,
  o_totalprice * (p.j + 1) + (o_orderkey % 7) - 3 AS y_pred
FROM orders CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS j) p)"""

WEIGHTS = """stats AS (SELECT property, count(y_true) AS n_labelled, coalesce(max(y_true) - min(y_true), 1.0::DOUBLE) AS value_range,
  sum(abs(y_pred - y_true)) AS error_sum FROM scored GROUP BY property),
weighted AS (SELECT *, (1.0::DOUBLE / value_range) * CASE WHEN total = 0 THEN 1.0::DOUBLE ELSE k * root / total END AS weight FROM (
  SELECT *, sum(root) OVER () AS total, count(*) OVER () AS k FROM (
    SELECT *, CASE WHEN n_labelled > 0 THEN sqrt(1.0::DOUBLE / n_labelled) ELSE 0.0::DOUBLE END AS root FROM stats)))"""

_TARGETS = """SELECT CASE WHEN c_custkey NOT IN (1, 501, 1001) THEN c_name END AS k, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS tg
FROM customer"""
BASE = f"base AS ({_TARGETS} WHERE c_custkey % 3 <> 0)"
GAPPY = "base AS (SELECT c_name AS k, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS tg FROM customer)"
SUPP = """supp AS (SELECT c_name AS k, c_acctbal + 1 AS tg FROM customer WHERE c_custkey % 3 <> 1
UNION ALL SELECT CASE WHEN c_custkey NOT IN (750, 1500) THEN c_name END, c_acctbal + 2 FROM customer WHERE c_custkey % 50 = 0)"""

CLASS_SCORED = """scored AS (SELECT l_returnflag AS y,
  CASE WHEN l_linenumber % 3 = 0 THEN 'A' WHEN l_linenumber % 5 = 0 THEN 'N' ELSE l_returnflag END AS y_hat FROM lineitem)"""

RUNS = """runs AS (SELECT user_id AS run_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS epoch,
  value AS loss FROM events)"""

NEWS = """news AS (SELECT doc_id, text, CAST(CASE WHEN quality = 1 THEN 0 ELSE 1 END AS INT) AS label
FROM documents JOIN labels USING (doc_id))"""

NODES = """nodes AS (SELECT graph_id, CAST(n AS INT) AS node_id, CAST(graph_id % 13 + n AS DOUBLE) AS f0 FROM
  (SELECT DISTINCT l_orderkey AS graph_id FROM lineitem) CROSS JOIN (SELECT unnest(range(1, 9)) AS n))"""
EDGES = """edges AS (SELECT DISTINCT l_orderkey AS graph_id, CAST(l_linenumber AS INT) AS src,
  CAST(l_linenumber % 7 + 1 AS INT) AS dst, l_returnflag AS attr FROM lineitem)"""

_CLASS_CASE = " ".join(f"WHEN {k} THEN '{v}'" for k, v in CLASSES.items())
DETECTIONS = f"""det AS (SELECT event_id AS det_id, CAST(floor(event_id / 5) AS BIGINT) AS frame_id,
  CAST(event_id % 5 AS BIGINT) AS det_no, CAST(event_id * 37 % 100 AS DOUBLE) / 100.0::DOUBLE AS conf,
  CAST(user_id % 4 AS INT) AS class_id, CASE user_id % 4 {_CLASS_CASE} END AS class_name,
  value - 100 AS x1, value - 50 AS y1, value AS x2, value + 20 AS y2 FROM events)"""


def _cut(c: str) -> str:
    return f"CAST(trunc({c}) AS INT)"


_LABEL = "class_name || ': ' || printf('%.2f', conf)"
_CORNERS = (("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2"))
_POLYGON = " || ' ' || ".join(f"{_cut(x)} || ',' || {_cut(y)}" for x, y in _CORNERS)

SHAPED = f"""WITH {DETECTIONS} SELECT frame_id, det_no, class_id, class_name, conf, {_cut('x1')} AS x1, {_cut('y1')} AS y1,
  {_cut('x2')} AS x2, {_cut('y2')} AS y2, {_LABEL} AS label, CASE WHEN det_no < 3 THEN {_POLYGON} END AS polygon
FROM det WHERE conf > 0.5"""


def _rolled(agg: str, col: str, side: str) -> str:
    return f"{agg}({col}) OVER (PARTITION BY {side} ORDER BY match_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"


def _mean(stat: str, side: str, places: int = 6) -> str:
    return f"round(coalesce({_rolled('avg', stat, side)}, (SELECT avg({stat}) FROM matches)), {places}) AS {side}_avg_{stat}"


_PTS = "CASE ftr WHEN 'H' THEN 3 WHEN 'D' THEN 1 ELSE 0 END"
_AWAY_PTS = "CASE ftr WHEN 'A' THEN 3 WHEN 'D' THEN 1 ELSE 0 END"


def _form(points: str, side: str, name: str) -> str:
    return f"CAST(coalesce({_rolled('sum', points, side)}, 0) AS BIGINT) AS {name}"


ELO = """played AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY season ORDER BY match_id) AS no,
  CASE ftr WHEN 'H' THEN 1.0::DOUBLE WHEN 'A' THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS won FROM matches),
rated AS (
  SELECT season, 0::BIGINT AS no, NULL::BIGINT AS match_id, NULL::DOUBLE AS home_elo, NULL::DOUBLE AS away_elo,
    MAP {}::MAP(VARCHAR, DOUBLE) AS ratings FROM (SELECT DISTINCT season FROM played)
  UNION ALL
  SELECT season, no, match_id, h, a, map_concat(ratings, MAP {home: h + 20 * (won - e), away: a + 20 * ((1 - won) - (1 - e))})
  FROM (SELECT *, 1 / (1 + pow(10::DOUBLE, (a - h) / 400)) AS e FROM (
    SELECT p.season, p.no, p.match_id, p.home, p.away, p.won, r.ratings,
      coalesce(r.ratings[p.home], 1500.0::DOUBLE) AS h, coalesce(r.ratings[p.away], 1500.0::DOUBLE) AS a
    FROM rated r JOIN played p ON p.season = r.season AND p.no = r.no + 1)))"""

ELO_QUERY = f"""WITH RECURSIVE {MATCHES}, {ELO}
SELECT match_id, round(home_elo, 4) AS home_elo, round(away_elo, 4) AS away_elo FROM rated WHERE no > 0"""

def _waves(games: str, key: str) -> str:
    """Ratings of one pool: each round plays every game that is the next one of both its sides."""
    return f"""turns AS (SELECT {key}, player, row_number() OVER (PARTITION BY player ORDER BY {key}) AS turn
  FROM (SELECT {key}, home AS player FROM {games} UNION ALL SELECT {key}, away FROM {games})),
due AS MATERIALIZED (SELECT t.*, h.turn AS h_turn, a.turn AS a_turn,
  CASE ftr WHEN 'H' THEN 1.0::DOUBLE WHEN 'A' THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS won FROM {games} t
  JOIN turns h ON h.{key} = t.{key} AND h.player = home JOIN turns a ON a.{key} = t.{key} AND a.player = away),
state(kind, id, x, y) USING KEY (kind, id) AS (
  SELECT 'player', player, 1::DOUBLE, 1500::DOUBLE FROM (SELECT DISTINCT player FROM turns)
  UNION
  SELECT kind, id, x, y FROM (
    SELECT unnest([{{'kind': 'player', 'id': home, 'x': h_turn + 1.0, 'y': h + 20 * (won - e)}},
                   {{'kind': 'player', 'id': away, 'x': a_turn + 1.0, 'y': a + 20 * ((1 - won) - (1 - e))}},
                   {{'kind': 'game', 'id': {key}::VARCHAR, 'x': h, 'y': a}}], recursive := true)
    FROM (SELECT g.*, p.y AS h, q.y AS a, 1 / (1 + pow(10::DOUBLE, (q.y - p.y) / 400)) AS e
          FROM due g JOIN recurring.state p ON p.kind = 'player' AND p.id = g.home AND p.x = g.h_turn
                     JOIN recurring.state q ON q.kind = 'player' AND q.id = g.away AND q.x = g.a_turn)))
SELECT id::BIGINT AS {key}, round(x, 4) AS home_elo, round(y, 4) AS away_elo FROM state WHERE kind = 'game'"""


TRADES = f"""trades AS MATERIALIZED (
SELECT CAST(row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS trade_id,
  'C' || o_custkey AS home, 'P' || l_partkey AS away, {_result(_FTHG, _FTAG)} AS ftr
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

TEAMS = "teams AS (SELECT home AS team FROM matches UNION SELECT away FROM matches)"


def _index(side: str) -> str:
    return f"(SELECT CAST(idx AS BIGINT) FROM team_ids WHERE team = {side}) AS {side}_enc"


TEAM_IDS = f"{TEAMS}, team_ids AS MATERIALIZED (SELECT team, row_number() OVER (ORDER BY team) - 1 AS idx FROM teams)"

TOP = """pairs AS (SELECT home, away, fthg, ftag, count(*) AS n FROM matches GROUP BY ALL),
shares AS (SELECT *, n / sum(n) OVER (PARTITION BY home, away)::DOUBLE AS prob FROM pairs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY home, away ORDER BY prob DESC, fthg, ftag) AS rank FROM shares),
league AS (SELECT *, row_number() OVER (ORDER BY prob DESC, fthg, ftag) AS rank FROM (
  SELECT fthg, ftag, count(*) AS n, count(*) / (SELECT count(*) FROM matches)::DOUBLE AS prob FROM matches GROUP BY ALL)),
answers AS (
  SELECT q.*, true AS pair_met, r.rank, r.fthg, r.ftag, r.n, r.prob FROM requests q JOIN ranked r USING (home, away) WHERE r.rank <= {k}
  UNION ALL
  SELECT q.*, false, l.rank, l.fthg, l.ftag, l.n, l.prob FROM requests q CROSS JOIN league l
  WHERE l.rank <= {k} AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.home = q.home AND p.away = q.away))"""

WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"
_N = MAX_LENGTH


def _ranked(table: str, key: str) -> str:
    """Rank by hashed key."""
    return (
        f"SELECT *, row_number() OVER (ORDER BY md5(CAST({key} AS VARCHAR) || ':42'), {key}) AS rank, "
        f"count(*) OVER () AS total FROM {table}"
    )


_SPLIT_3 = """CASE WHEN rank <= ceil(0.5::DOUBLE * ceil(0.3::DOUBLE * total)) THEN 'test'
  WHEN rank <= ceil(0.3::DOUBLE * total) THEN 'validation' ELSE 'train' END AS split"""

SQUADS = """squads AS (SELECT CAST(floor(c_custkey / 20) AS BIGINT) AS page_id, c_custkey, c_name || ' & Co' || CASE WHEN c_custkey % 6 = 0 THEN 'é' ELSE '' END AS squad, c_nationkey, c_acctbal FROM customer)"""


def _uniform(*parts: str) -> str:
    text = " || ':' || ".join(parts)
    return f"((('0x' || substr(md5({text}), 1, 8))::BIGINT + 1.0::DOUBLE) / 4294967296.0::DOUBLE)"


_GN = ("CAST(graph_id AS VARCHAR)", "CAST(node_id AS VARCHAR)")
_NORMAL = (
    f"sqrt(-2.0::DOUBLE * ln({_uniform(chr(39) + 'r' + chr(39), chr(39) + 'f042' + chr(39), *_GN)})) * "
    f"cos(2.0::DOUBLE * pi() * {_uniform(chr(39) + 'a' + chr(39), chr(39) + 'f042' + chr(39), *_GN)})"
)

_URL_PARTS = SEASON_URL.split("{year}")[0], SEASON_URL.split("{next_year}")[1]

ORACLE = {
    "season_manifest": f"""SELECT DISTINCT {_i('year(l_shipdate)')} AS year,
        '{_URL_PARTS[0]}' || year(l_shipdate) || '-' || (year(l_shipdate) + 1) || '{_URL_PARTS[1]}' AS url FROM lineitem""",
    "html_table": f"""WITH {SQUADS} SELECT page_id, CAST(CASE WHEN c_custkey % 20 = 5 THEN 4 ELSE c_custkey % 20 END AS VARCHAR) AS rk, squad,
        CAST(c_nationkey AS VARCHAR) AS mp, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS gls FROM squads""",
    "html_missing": f"""WITH {SQUADS} SELECT 'squads' AS origin, page_id, '{AGAINST_TABLE}' AS table_id
        FROM (SELECT DISTINCT page_id FROM squads WHERE page_id % 7 = 3)
        UNION ALL SELECT 'pages' AS origin, page_id, t AS table_id FROM pages CROSS JOIN (SELECT unnest(['{FOR_TABLE}', '{AGAINST_TABLE}']) AS t)
        WHERE NOT coalesce(regexp_matches(html, '<table[^>]* id="' || t || '"'), false)""",
    "header_flatten": f"""WITH {SQUADS} SELECT page_id, CAST(unnest([0, 1, 2, 3]) AS INT) AS col_no,
        unnest(['Defensive_Rk', 'Squad', 'Defensive_Performance_MP', 'Defensive_Performance_GA']) AS name
        FROM (SELECT DISTINCT page_id FROM squads WHERE page_id % 7 <> 3 AND c_custkey % 4 <> 0)""",
    "header_rows_drop": f"""WITH {SQUADS} SELECT page_id, count(*) + sum(CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END)::BIGINT AS n_body,
        count(*) AS n_rows FROM squads WHERE page_id % 7 <> 3 AND c_custkey % 4 <> 0 GROUP BY page_id""",
    "left_merge": f"""WITH {SQUADS}, against AS (SELECT page_id, squad, CAST(c_nationkey + 1 AS VARCHAR) AS def_mp,
        CAST(c_custkey % 90 AS VARCHAR) AS def_ga FROM squads WHERE page_id % 7 <> 3 AND c_custkey % 4 <> 0)
        SELECT s.page_id, s.squad, CAST(c_nationkey AS VARCHAR) AS off_mp,
        CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS off_gls, def_mp, def_ga
        FROM squads s LEFT JOIN against a ON s.page_id = a.page_id AND s.squad = a.squad""",
    "seasons_csv": f"WITH {MATCHES} SELECT match_id AS ord, match_id, home, away, ftr, fthg, ftag FROM matches",
    "news_files": f"WITH {NEWS} SELECT doc_id, md5(text) AS text_md5, label FROM news",
    "submission_csv": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 1 THEN round(o_totalprice * 2 / 2, 2) END AS p0,
        CASE WHEN o_orderkey % 4 <> 1 THEN round(o_totalprice * 2, 2) END AS p1 FROM orders""",
    "table_summary": """SELECT lang, source, count(*) AS n_rows, CAST(5 AS INT) AS n_columns,
        'doc_id, text, lang, source, n_chars' AS column_names FROM documents GROUP BY lang, source""",
    "select_existing": "SELECT l_quantity, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem",
    "drop_nulls": f"SELECT * FROM ({_TARGETS}) WHERE k IS NOT NULL AND tg IS NOT NULL",
    "rename_map": "SELECT c_name AS k, c_acctbal AS tg FROM customer",
    "label_union": """SELECT doc_id, lang, CASE WHEN quality = 1 THEN toxic END AS toxic,
        CAST(CASE WHEN quality = 1 THEN 0 ELSE 1 END AS INT) AS label FROM documents JOIN labels USING (doc_id)""",
    "result_map": f"""WITH {MATCHES} SELECT match_id, CAST(CASE ftr WHEN 'H' THEN 0 WHEN 'D' THEN 1 ELSE 2 END AS INT) AS ftr_enc,
        CAST({_PTS} AS INT) AS points, CAST({_AWAY_PTS} AS INT) AS away_points,
        CASE ftr WHEN 'H' THEN 1.0::DOUBLE WHEN 'A' THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS score_home,
        CASE ftr WHEN 'H' THEN 0.0::DOUBLE WHEN 'A' THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS score_away FROM matches""",
    "pair_filter": f"""WITH {MATCHES}, {REQUESTS} SELECT match_id, home, away, ftr FROM matches m
        WHERE EXISTS (SELECT 1 FROM requests r WHERE r.home = m.home AND r.away = m.away)""",
    "team_union": f"WITH {MATCHES}, {TEAMS} SELECT team FROM teams",
    "team_list": f"""WITH {MATCHES}, {TEAMS} SELECT string_agg(team, ', ' ORDER BY team) AS names, count(*) AS n_names FROM teams""",
    "text_coerce": """SELECT doc_id, md5(t) AS text_md5, length(t) AS n FROM (
        SELECT doc_id, CASE WHEN doc_id % 10 <> 0 THEN text ELSE 'nan' END AS t FROM documents)""",
    "outer_merge": f"""WITH {BASE}, {SUPP} SELECT coalesce(b.k, s.k) AS k, b.tg, s.tg AS tg_supp
        FROM base b FULL JOIN supp s ON b.k IS NOT DISTINCT FROM s.k""",
    "coalesce_merge": f"""WITH {BASE}, {SUPP}, extra AS (SELECT replace(s_name, 'Supplier', 'Customer') AS k, s_acctbal AS rg FROM supplier),
        first AS (SELECT coalesce(b.k, s.k) AS k, coalesce(b.tg, s.tg) AS tg FROM base b FULL JOIN supp s ON b.k IS NOT DISTINCT FROM s.k)
        SELECT coalesce(f.k, e.k) AS k, f.tg, e.rg FROM first f FULL JOIN extra e ON f.k IS NOT DISTINCT FROM e.k""",
    "supplements_csv": f"""WITH {BASE}, {SUPP} SELECT coalesce(b.k, s.k) AS k, coalesce(b.tg, s.tg) AS tg, CAST(1 AS INT) AS n_skipped
        FROM base b FULL JOIN supp s ON b.k IS NOT DISTINCT FROM s.k""",
    "target_vector": f"""SELECT o_orderkey AS id, {', '.join(
        f'round(CASE WHEN o_orderkey % 4 <> {j} THEN o_totalprice * {j + 1} END, 4) AS t{j}' for j in range(3))},
        NULL::DOUBLE AS t3, CAST(4 AS INT) AS n FROM orders""",
    "submission_join": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 1 THEN round(o_totalprice * 2 / 2, 2) END AS p0,
        CASE WHEN o_orderkey % 4 <> 1 THEN round(o_totalprice * 2, 2) END AS p1 FROM orders""",
    "global_mean_fill": f"WITH {GAPPY} SELECT k, round(coalesce(tg, (SELECT avg(tg) FROM base)), 6) AS tg FROM base",
    "median_fill": f"WITH {GAPPY} SELECT k, round(coalesce(tg, (SELECT median(tg) FROM base)), 6) AS tg FROM base",
    "rolling_mean": f"""WITH {MATCHES} SELECT match_id,
        {', '.join(_mean(s, side) for side in ('home', 'away') for s in STATS)} FROM matches""",
    "rolling_sliced": f"""WITH {MATCHES} SELECT match_id, {_mean('fthg', 'home')}, {_mean('aws', 'away')} FROM matches""",
    "rolling_form": f"""WITH {MATCHES} SELECT match_id, {_form(_PTS, 'home', 'home_form')},
        {_form(_PTS, 'away', 'away_form')}, {_form(_AWAY_PTS, 'away', 'away_form_own')} FROM matches""",
    "elo": ELO_QUERY,
    "elo_chunked": ELO_QUERY,
    "stream_elo": ELO_QUERY,
    "elo_waves": f"WITH RECURSIVE {TRADES}, {_waves('trades', 'trade_id')}",
    "elo_expectation": f"""WITH RECURSIVE {MATCHES}, {ELO}
        SELECT match_id, round(1 / (1 + pow(10::DOUBLE, (away_elo - home_elo) / 400)), 6) AS expected FROM rated WHERE no > 0""",
    "latest_or_mean": f"""WITH {MATCHES}, {REQUESTS}, feats AS MATERIALIZED (SELECT match_id, home, away,
        {_mean('fthg', 'home', 12)}, {_mean('hs', 'home', 12)}, {_mean('ftag', 'away', 12)}, {_mean('aws', 'away', 12)} FROM matches),
        h AS (SELECT home, arg_max(home_avg_fthg, match_id) AS f, arg_max(home_avg_hs, match_id) AS g FROM feats GROUP BY home),
        a AS (SELECT away, arg_max(away_avg_ftag, match_id) AS f, arg_max(away_avg_aws, match_id) AS g FROM feats GROUP BY away)
        SELECT r.req_id, r.home, r.away,
        round(coalesce(h.f, (SELECT avg(home_avg_fthg) FROM feats)), 6) AS home_avg_fthg,
        round(coalesce(h.g, (SELECT avg(home_avg_hs) FROM feats)), 6) AS home_avg_hs,
        round(coalesce(a.f, (SELECT avg(away_avg_ftag) FROM feats)), 6) AS away_avg_ftag,
        round(coalesce(a.g, (SELECT avg(away_avg_aws) FROM feats)), 6) AS away_avg_aws
        FROM requests r LEFT JOIN h ON r.home = h.home LEFT JOIN a ON r.away = a.away""",
    "stall_stop": f"""WITH {RUNS}, marked AS (SELECT *, coalesce(loss < min(loss) OVER (PARTITION BY run_id ORDER BY epoch
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS better FROM runs),
        since AS (SELECT *, epoch - max(CASE WHEN better THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch) AS waited FROM marked),
        stops AS (SELECT run_id, min(CASE WHEN waited >= 5 THEN epoch END) AS stop FROM since GROUP BY run_id)
        SELECT s.run_id, any_value(t.stop) AS stop, max(s.epoch) AS best_step, arg_max(s.loss, s.epoch) AS best
        FROM since s JOIN stops t USING (run_id) WHERE s.better AND (t.stop IS NULL OR s.epoch <= t.stop) GROUP BY s.run_id""",
    "request_split": f"""WITH {MATCHES}, {REQUESTS}, {TEAMS} SELECT *, CASE WHEN home NOT IN (SELECT team FROM teams) THEN 'unknown home team'
        WHEN away NOT IN (SELECT team FROM teams) THEN 'unknown away team' ELSE 'valid' END AS reason FROM requests""",
    "scoreline_counts": f"WITH {MATCHES} SELECT fthg, ftag, count(*) AS n FROM matches GROUP BY ALL",
    "scoreline_share": f"""WITH {MATCHES} SELECT home, away, fthg, ftag, count(*) AS n,
        round(count(*) / sum(count(*)) OVER (PARTITION BY home, away)::DOUBLE, 6) AS prob FROM matches GROUP BY home, away, fthg, ftag""",
    "head_to_head": f"""WITH {MATCHES}, {REQUESTS} SELECT r.req_id, r.home, r.away, count(m.match_id) AS games,
        count(*) FILTER (m.ftr = 'H') AS home_wins, count(*) FILTER (m.ftr = 'D') AS draws, count(*) FILTER (m.ftr = 'A') AS away_wins
        FROM requests r LEFT JOIN matches m ON r.home = m.home AND r.away = m.away GROUP BY ALL""",
    "top3_scorelines": f"""WITH {MATCHES}, {REQUESTS}, {TOP.format(k=3)}
        SELECT req_id, home, away, pair_met, rank, fthg, ftag, n, round(prob, 6) AS prob FROM answers""",
    "request_sheet": f"""WITH {MATCHES}, {REQUESTS}, {TEAMS}, {TOP.format(k=3)},
        lists AS (SELECT req_id, any_value(pair_met) AS pair_met, max(CASE WHEN rank = 1 THEN fthg || '-' || ftag END) AS scoreline,
          {', '.join(f"max(CASE WHEN rank = {i} THEN fthg || '-' || ftag END) AS score_{i}, max(CASE WHEN rank = {i} THEN round(prob, 6) END) AS share_{i}" for i in (1, 2, 3))}
          FROM answers GROUP BY req_id),
        met AS (SELECT home, away, count(*) AS games, count(*) FILTER (ftr = 'H') AS home_wins, count(*) FILTER (ftr = 'D') AS draws,
          count(*) FILTER (ftr = 'A') AS away_wins FROM matches GROUP BY ALL),
        checked AS (SELECT *, CASE WHEN home NOT IN (SELECT team FROM teams) THEN 'unknown home team'
          WHEN away NOT IN (SELECT team FROM teams) THEN 'unknown away team' END AS reason FROM requests)
        SELECT c.req_id, c.home, c.away, reason, {', '.join(f"CASE WHEN reason IS NULL THEN {c} END AS {c}" for c in ("scoreline", "score_1", "share_1", "score_2", "share_2", "score_3", "share_3"))},
          {', '.join(f"CASE WHEN reason IS NULL THEN coalesce({c}, 0) END AS {c}" for c in ("games", "home_wins", "draws", "away_wins"))}
        FROM checked c JOIN lists l ON c.req_id = l.req_id LEFT JOIN met ON met.home = c.home AND met.away = c.away""",
    "likely_scoreline": f"""WITH {MATCHES}, {REQUESTS}, {TOP.format(k=1)}
        SELECT req_id, fthg || '-' || ftag AS scoreline, round(prob, 6) AS prob FROM answers""",
    "team_index": f"""WITH {MATCHES}, {TEAM_IDS} SELECT match_id, {_index('home')}, {_index('away')} FROM matches""",
    "match_features": f"""WITH RECURSIVE {MATCHES}, {ELO}, {TEAM_IDS} SELECT m.match_id,
        {_index('home')}, {_index('away')}, round(r.home_elo, 4) AS home_elo, round(r.away_elo, 4) AS away_elo,
        home_form, away_form, {', '.join(c for c in FEATURES if '_avg_' in c)}, ftr_enc
        FROM (SELECT match_id, home, away, {_form(_PTS, 'home', 'home_form')}, {_form(_PTS, 'away', 'away_form')},
          {', '.join(_mean(s, side, 4) for side in ('home', 'away') for s in STATS)},
          CAST(CASE ftr WHEN 'H' THEN 0 WHEN 'D' THEN 1 ELSE 2 END AS BIGINT) AS ftr_enc FROM matches) m
        JOIN rated r ON m.match_id = r.match_id""",
    "split_80_20": f"""WITH {MATCHES}, ranked AS ({_ranked('matches', 'match_id')})
        SELECT match_id, CASE WHEN rank <= ceil(0.2::DOUBLE * total) THEN 'test' ELSE 'train' END AS split FROM ranked""",
    "split_70_15_15": f"WITH ranked AS ({_ranked('documents', 'doc_id')}) SELECT doc_id, {_SPLIT_3} FROM ranked",
    "seeded_shuffle": f"WITH ranked AS ({_ranked('documents', 'doc_id')}) SELECT doc_id, CAST(rank AS BIGINT) AS position FROM ranked",
    "split_counts": f"""WITH {NEWS}, ranked AS ({_ranked('news', 'doc_id')}), parts AS (SELECT {_SPLIT_3}, label FROM ranked)
        SELECT split, label, count(*) AS n_rows FROM parts GROUP BY ALL""",
    "pad_mask": f"""WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
        p AS (SELECT doc_id, len(words) AS n_words, list_transform(words[1:{_N}], lambda x: length(x)) AS ids FROM w)
        SELECT doc_id, n_words, array_to_string(list_resize(ids, {_N}, 0), ' ') AS padded, CAST({_N} AS BIGINT) AS n_mask,
        CAST(least(n_words, {_N}) AS BIGINT) AS n_used FROM p""",
    "token_ids": f"""WITH w AS MATERIALIZED (SELECT doc_id, {WORDS} AS words FROM documents),
        counted AS (SELECT token, count(*) AS n FROM (SELECT unnest(words) AS token FROM w) GROUP BY token),
        vocab AS MATERIALIZED (SELECT token, row_number() OVER (ORDER BY n DESC, token) + {FIRST_TOKEN_ID - 1} AS id
          FROM counted),
        seq AS (SELECT doc_id, unnest(words[1:{_N - 2}]) AS token, generate_subscripts(words[1:{_N - 2}], 1) AS pos FROM w),
        ids AS (SELECT doc_id, list(coalesce(id, 1) ORDER BY pos) AS ids FROM seq LEFT JOIN vocab USING (token) GROUP BY doc_id),
        marked AS (SELECT w.doc_id, list_concat(list_concat([2], coalesce(ids, [])), [3]) AS ids FROM w LEFT JOIN ids USING (doc_id))
        SELECT doc_id, len(ids) AS n_ids, array_to_string(list_resize(ids, {_N}, 0), ' ') AS input_ids,
        repeat('1', len(ids)) || repeat('0', {_N} - len(ids)) AS attention_mask FROM marked""",
    "argmax_label": """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best_of_all,
        CASE WHEN embedding[2] > embedding[1] THEN 'FAKE' ELSE 'REAL' END AS verdict FROM embeddings""",
    "property_stats": f"WITH {SCORED}, {WEIGHTS} SELECT property, n_labelled, round(value_range, 4) AS value_range FROM stats",
    "property_weights": f"""WITH {SCORED}, {WEIGHTS} SELECT property, n_labelled, round(value_range, 10) AS value_range,
        round(weight, 10) AS weight FROM weighted""",
    "wmae": f"""WITH {SCORED}, {WEIGHTS} SELECT round(sum(CASE WHEN n_labelled > 0 THEN weight * error_sum END) / sum(n_labelled), 10) AS wmae,
        CAST(sum(n_labelled) AS BIGINT) AS n_labelled FROM weighted""",
    "batch_loss": f"""WITH {SCORED}, {WEIGHTS}, parts AS (SELECT batch_id, property, avg(abs(y_pred - y_true)) AS mae, count(*) AS n
        FROM scored GROUP BY ALL) SELECT batch_id, round(coalesce(sum(weight * mae), 0) / max(n), 10) AS loss, max(n) AS n_rows
        FROM parts JOIN weighted USING (property) GROUP BY batch_id""",
    "accuracy": f"WITH {CLASS_SCORED} SELECT round(avg(CASE WHEN y = y_hat THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy FROM scored",
    "class_report": f"""WITH {CLASS_SCORED}, classes AS (SELECT y AS c FROM scored UNION SELECT y_hat FROM scored),
        counts AS (SELECT c, (SELECT count(*) FROM scored WHERE y = c AND y_hat = c)::DOUBLE AS hit,
          (SELECT count(*) FROM scored WHERE y = c) AS support, (SELECT count(*) FROM scored WHERE y_hat = c) AS said FROM classes),
        pr AS (SELECT *, CASE WHEN said = 0 THEN 0 ELSE hit / said END AS p, CASE WHEN support = 0 THEN 0 ELSE hit / support END AS r FROM counts),
        f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1 FROM pr)
        SELECT CASE c WHEN 'A' THEN 'Away' WHEN 'N' THEN 'None' ELSE c END AS label, round(p, 6) AS precision, round(r, 6) AS recall,
          round(f1, 6) AS f1, support FROM f
        UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
          round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
    "epoch_loss": f"WITH {RUNS} SELECT epoch, round(avg(loss), 6) AS mean_loss, count(*) AS n_rows FROM runs GROUP BY epoch",
    "graph_pool": f"WITH {NODES} SELECT graph_id, round(avg(f0), 6) AS f0, count(*) AS n_nodes FROM nodes GROUP BY graph_id",
    "graph_degree": f"""WITH {NODES}, {EDGES}, ends AS (SELECT graph_id, src AS node_id FROM edges UNION ALL SELECT graph_id, dst FROM edges),
        d AS (SELECT graph_id, node_id, count(*) AS degree FROM ends GROUP BY ALL)
        SELECT graph_id, node_id, coalesce(degree, 0) AS degree FROM nodes LEFT JOIN d USING (graph_id, node_id)""",
    "graph_undirected": f"""WITH {EDGES} SELECT graph_id, src, dst, attr FROM edges
        UNION ALL SELECT graph_id, dst, src, attr FROM edges""",
    "graph_noise": f"""WITH {NODES}, n AS (SELECT *, {_uniform("'coin42'", _GN[0])} < 0.5 AND graph_id % 5 <> 0 AS noisy FROM nodes)
        SELECT graph_id, node_id, noisy, round(CASE WHEN noisy THEN f0 + {_NORMAL} * 0.01 ELSE f0 END, 6) AS f0 FROM n""",
    "conf_filter": f"WITH {DETECTIONS} SELECT det_id, conf FROM det WHERE conf > 0.5",
    "box_trunc": f"WITH {DETECTIONS} SELECT det_id, {', '.join(f'{_cut(c)} AS {c}' for c in ('x1', 'y1', 'x2', 'y2'))} FROM det",
    "class_lookup": f"""WITH {DETECTIONS} SELECT det_id, class_id, upper(n_name[1]) || lower(n_name[2:]) AS class_name
        FROM det LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 3) ON class_id = n_nationkey""",
    "label_format": f"WITH {DETECTIONS} SELECT det_id, {_LABEL} AS label FROM det",
    "detections_shape": SHAPED,
    "stream_detections": SHAPED,
    "polygon_area": f"""SELECT class_id, count(*) AS n_detections, round(CAST(sum(CASE WHEN polygon IS NOT NULL
        THEN abs((x2::DOUBLE - x1) * (y2::DOUBLE - y1)) END) AS DOUBLE), 2) AS area FROM ({SHAPED}) GROUP BY class_id""",
}

_TEST = "rank <= ceil(0.2::DOUBLE * total)"
_PER_ORDER = f"""sized AS MATERIALIZED (SELECT o_orderkey AS id, n::DOUBLE AS lines, {', '.join(f"CASE WHEN o_orderkey % 4 <> {j} THEN o_totalprice * {j + 1} END AS p{j}" for j in range(3))},
  NULL::DOUBLE AS p3 FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey),
fits AS MATERIALIZED ({' UNION ALL '.join(f"SELECT 'p{j}' AS target, regr_slope(p{j}, lines) AS slope, regr_intercept(p{j}, lines) AS intercept, count(p{j}) FILTER (lines IS NOT NULL) AS n FROM sized" for j in range(4))})"""


def _feistel(epochs: int, seed: int = 42) -> str:
    """Places by the same rounds; numbers beyond the last are sent round again until none is left."""
    h = lambda k, v: f"('0x' || substr(md5('{seed}:' || epoch || ':{k}:' || {v}), 1, 8))::BIGINT"
    rounds = f"""SELECT id, epoch, n, a, b, l2 * b + (r1 + {h(4, 'l2')}) % b AS x FROM (
      SELECT *, (l1 + {h(3, 'r1')}) % a AS l2 FROM (SELECT *, (r0 + {h(2, 'l1')}) % b AS r1 FROM (
        SELECT *, (l0 + {h(1, 'r0')}) % a AS l1 FROM (SELECT id, epoch, n, a, b, x // b AS l0, x % b AS r0 FROM {{}}))))"""
    return f"""numbered AS (SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS x FROM orders),
  sizes AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT count(*) AS n, ceil(sqrt(count(*)))::BIGINT AS root FROM orders), range(0, {CANDIDATES}) g(k),
    LATERAL (SELECT root + k AS a) WHERE k <= root ORDER BY a * ((n + a - 1) // a), a LIMIT 1),
  begun AS (SELECT id, e::INT AS epoch, n, a, b, x FROM numbered, sizes, range(1, {epochs + 1}) q(e)),
  walk AS (({rounds.format('begun')}) UNION ALL ({rounds.format("(SELECT * FROM walk WHERE x >= n)")})),
  placed AS MATERIALIZED (SELECT id, epoch, x::BIGINT AS position, (x // 32)::BIGINT AS batch_id FROM walk WHERE x < n)"""


ORACLE |= {
    "outcome_check": f"""WITH {MATCHES}, ranked AS ({_ranked('matches', 'match_id')})
        SELECT CASE ftr WHEN 'H' THEN 0 WHEN 'D' THEN 1 ELSE 2 END::BIGINT AS result, count(*) AS support, true AS sound, true AS loss_ok
        FROM ranked WHERE {_TEST} GROUP BY ALL""",
    "goals_check": f"WITH {MATCHES}, ranked AS ({_ranked('matches', 'match_id')}) SELECT match_id, fthg, ftag, true AS sound FROM ranked WHERE {_TEST}",
    "answers_check": f"""SELECT req_id, home, away, reason, scoreline, games, home_wins, draws, away_wins, true AS sound FROM ({ORACLE['request_sheet']})""",
    "request_inputs": f"""WITH {MATCHES}, {REQUESTS}, {TEAM_IDS}, rolled AS (SELECT match_id, home, away, {_mean('fthg', 'home', 12)}, {_mean('ftag', 'away', 12)},
        {_form(_PTS, 'home', 'home_form')}, {_form(_PTS, 'away', 'away_form')} FROM matches),
        h AS (SELECT home AS team, arg_max(home_avg_fthg, match_id) AS home_avg_fthg, arg_max(home_form, match_id) AS home_form FROM rolled GROUP BY home),
        a AS (SELECT away AS team, arg_max(away_avg_ftag, match_id) AS away_avg_ftag, arg_max(away_form, match_id) AS away_form FROM rolled GROUP BY away)
        SELECT req_id, home, away, {_index('home')}, {_index('away')}, round(coalesce(home_avg_fthg, (SELECT avg(home_avg_fthg) FROM rolled)), 4) AS home_avg_fthg,
          round(coalesce(away_avg_ftag, (SELECT avg(away_avg_ftag) FROM rolled)), 4) AS away_avg_ftag,
          round(coalesce(home_form::DOUBLE, (SELECT avg(home_form) FROM rolled)), 4) AS home_form, round(coalesce(away_form::DOUBLE, (SELECT avg(away_form) FROM rolled)), 4) AS away_form
        FROM requests LEFT JOIN h ON h.team = home LEFT JOIN a ON a.team = away
        WHERE home IN (SELECT team FROM teams) AND away IN (SELECT team FROM teams)""",
    "raw_match_features": f"""WITH RECURSIVE {MATCHES.replace('matches AS', 'every_match AS', 1)},
        matches AS MATERIALIZED (SELECT * FROM every_match WHERE match_id % 97 <> 0 AND match_id % 89 <> 0 AND match_id % 83 <> 0), {ELO},
        rolled AS (SELECT match_id, home, away, ftr, {_mean('hst', 'home', 4)}, {_mean('ast', 'away', 4)}, {_mean('fthg', 'home', 4)} FROM matches)
        SELECT m.*, round(home_elo, 4) AS home_elo, round(away_elo, 4) AS away_elo FROM rolled m JOIN rated r ON r.match_id = m.match_id AND r.no > 0""",
    "text_check": f"""WITH {NEWS}, ranked AS ({_ranked('news', 'doc_id')})
        SELECT split, label::BIGINT AS label, count(*) AS support, true AS learnt FROM (SELECT {_SPLIT_3}, label FROM ranked) GROUP BY ALL""",
    "verdict_check": "SELECT doc_id, true AS sound FROM documents",
    "outside_scores": """SELECT vec_id, CASE WHEN label IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL)) = 0 THEN
        round(list_sum(list_transform(range(0, 64), lambda i: embedding[i + 1]::DOUBLE * ((i * 37) % 11 - 5) / 10.0::DOUBLE)) + 0.25::DOUBLE * label - 1, 5) END AS score FROM embeddings""",
    "target_fits": f"WITH {_PER_ORDER} SELECT target, round(slope, 3) AS slope, round(intercept, 3) AS intercept, n FROM fits",
    "target_predictions": f"""WITH {_PER_ORDER} SELECT id, {', '.join(f"round((SELECT slope FROM fits WHERE target = 'p{j}') * lines + (SELECT intercept FROM fits WHERE target = 'p{j}'), 2) AS pred_p{j}" for j in range(4))} FROM sized""",
    "epoch_batches": f"WITH RECURSIVE {_feistel(3)} SELECT id, epoch, position, batch_id FROM placed",
    "epoch_batch_loss": f"""WITH RECURSIVE {_feistel(3)}, {SCORED}, {WEIGHTS},
        parts AS (SELECT p.epoch, p.batch_id, property, avg(abs(y_pred - y_true)) AS mae, count(*) AS n FROM scored s JOIN placed p ON p.id = s.id GROUP BY ALL)
        SELECT epoch, batch_id, round(coalesce(sum(weight * mae), 0) / max(n), 8) AS loss, max(n) AS n_rows FROM parts JOIN weighted USING (property) GROUP BY epoch, batch_id""",
    "validation_loss": f"""WITH {SCORED.replace('scored AS', 'every_score AS', 1)}, ranked AS ({_ranked('(SELECT DISTINCT id FROM every_score)', 'id')}),
        parts_of AS (SELECT id, {_SPLIT_3} FROM ranked), scored AS (SELECT s.* FROM every_score s JOIN parts_of USING (id) WHERE split = 'train'), {WEIGHTS},
        held AS (SELECT s.* FROM every_score s JOIN parts_of USING (id) WHERE split = 'validation'),
        parts AS (SELECT batch_id, property, avg(abs(y_pred - y_true)) AS mae, count(*) AS n FROM held GROUP BY ALL)
        SELECT batch_id, round(coalesce(sum(weight * mae), 0) / max(n), 8) AS loss, max(n) AS n_rows FROM parts JOIN weighted USING (property) GROUP BY batch_id""",
    "supplement_rejects": """SELECT c_name AS k, CASE WHEN c_custkey % 7 <> 0 THEN round(c_acctbal, 2) END AS tg,
        CASE WHEN c_custkey % 7 = 0 THEN c_name || ',n/a' END AS line FROM customer""",
}
