"""The registered queries: each reads whole given tables and returns a DataFrame."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from formline.functions.outcomes import CLASS_NAMES, away_points, away_score, mapped, points, result_class
from formline.operators import detections as det
from formline.operators import encode, epochs, graphs, merges, metrics, scorelines, shaping, splits
from formline.operators.ordered import Lagged, lagged_rolling, latest_or_mean, mean_fill, median_fill
from formline.operators.ratings import elo_ratings, expected_score, home_score
from formline.operators.sequence import assign_sequence
from formline.operators.stall import stall_stop
from formline.plans import fixtures as fx
from formline.plans import match_model, multitarget, outside_model, text_model
from formline.session import scratch_path, store
from formline.sources import files, html
from formline.streaming.detections import shape_stream
from formline.streaming.ratings import rate_stream

PAIR = ["home", "away"]
SCORE = ["fthg", "ftag"]
PAGE = ["page_id"]
ARRIVALS = 4
SLICE_ROWS, CHUNK_ROWS = 512, 8192  # small enough to cut the checked tables


def _r(column, places: int = 6):
    return F.round(column, places)


def _rounded(df: DataFrame, columns, places: int = 6) -> DataFrame:
    return df.withColumns({c: _r(F.col(c), places) for c in columns})


def _long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


# --- sources and sinks -------------------------------------------------------


def season_manifest(spark: SparkSession, d: str) -> DataFrame:
    years = fx.table(spark, d, "lineitem").select(F.year("l_shipdate").alias("year")).distinct()
    return html.season_urls(years)


def html_table(spark: SparkSession, d: str) -> DataFrame:
    rows = html.html_tables(fx.stat_pages(spark, d), PAGE, html.FOR_TABLE)
    clean = html.drop_repeated_headers(rows)
    picked = {"rk": "Rk", "squad": "Squad", "mp": "Performance_MP", "gls": "Performance_Gls"}
    return html.pick_columns(clean, PAGE, picked).drop("row_no")


def html_missing(spark: SparkSession, d: str) -> DataFrame:
    """The reject list of the given pages, which have no squad table, and of the squad pages, some of which lack one."""
    pages = [("pages", fx.table(spark, d, "pages")), ("squads", fx.stat_pages(spark, d))]
    mixed = [p.select(F.lit(name).alias("origin"), "page_id", "html") for name, p in pages]
    return html.missing_tables(mixed[0].unionByName(mixed[1]), ["origin", "page_id"], [html.FOR_TABLE, html.AGAINST_TABLE])


def header_flatten(spark: SparkSession, d: str) -> DataFrame:
    rows = html.html_tables(fx.stat_pages(spark, d), PAGE, html.AGAINST_TABLE, prefix=html.AGAINST_PREFIX)
    return rows.where("row_no = 0").select("page_id", F.posexplode("names").alias("col_no", "name"))


def header_rows_drop(spark: SparkSession, d: str) -> DataFrame:
    rows = html.html_tables(fx.stat_pages(spark, d), PAGE, html.AGAINST_TABLE)
    return (
        rows.groupBy("page_id")
        .agg(F.count("*").alias("n_body"))
        .join(html.drop_repeated_headers(rows).groupBy("page_id").agg(F.count("*").alias("n_rows")), "page_id", "left")
        .select("page_id", "n_body", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    )


def left_merge(spark: SparkSession, d: str) -> DataFrame:
    stats = html.squad_stats(
        fx.stat_pages(spark, d),
        PAGE,
        {"off_mp": "Offensive_Performance_MP", "off_gls": "Offensive_Performance_Gls"},
        {"def_mp": "Defensive_Performance_MP", "def_ga": "Defensive_Performance_GA"},
    )
    return stats.withColumnRenamed("Squad", "squad")


def seasons_csv(spark: SparkSession, d: str) -> DataFrame:
    """Games written as one CSV folder per season, in files of a stated size, read back in file order and numbered."""
    games = fx.matches(spark, d).select("season", "home", "away", "ftr", "fthg", "ftag", "match_id")
    folder = scratch_path(spark, "seasons")
    files.write_seasons(games, folder, order="match_id", rows_per_file=CHUNK_ROWS)
    schema = "home string, away string, ftr string, fthg int, ftag int, match_id long"
    read = files.read_in_order(spark, [folder], schema)
    return read.select("ord", "match_id", "home", "away", "ftr", "fthg", "ftag")


def news_files(spark: SparkSession, d: str) -> DataFrame:
    """Real and fake texts written as CSVs in different folders, each found by its exact name, labelled and united."""
    news = fx.news(spark, d)
    folder = scratch_path(spark, "news")
    parts = []
    for label, name in ((0, "true"), (1, "fake")):
        path = f"{folder}/{name}"
        rows = news.where(F.col("label") == label).select("doc_id", "text")
        rows.write.option("header", True).option("escape", '"').csv(path)
        written = spark.read.schema("doc_id long, text string").csv(path).inputFiles()
        found = [files.find_file(spark, folder, f.rsplit("/", 1)[1], "doc_id long, text string") for f in written]
        parts += [shaping.label_source(rows, label) for rows in found]
    united = shaping.stack_tables(parts)
    return united.select("doc_id", F.md5("text").alias("text_md5"), "label")


def supplement_rejects(spark: SparkSession, d: str) -> DataFrame:
    """A supplement with rows that do not fit their schema: each customer's key, cell, and the raw line if it was bad."""
    folder = scratch_path(spark, "supplement")
    key = F.col("c_custkey")
    cell = F.when(key % 7 == 0, "n/a").otherwise(F.round("c_acctbal", 2).cast("string"))
    rows = fx.table(spark, d, "customer").select(F.col("c_name").alias("k"), cell.alias("tg"))
    rows.write.option("header", True).csv(f"{folder}/one")
    loaded, _ = files.read_supplements(spark, [(f"{folder}/one", "k string, tg double")], bad_row="line")
    return loaded[0].select("k", _r("tg", 2).alias("tg"), "line")


def submission_csv(spark: SparkSession, d: str) -> DataFrame:
    """Predictions joined to every id, written as CSV and read back."""
    path = scratch_path(spark, "submission")
    files.write_predictions(submission_join(spark, d), path)
    return files.read_table(spark, path, "id long, p0 double, p1 double")


def table_summary(spark: SparkSession, d: str) -> DataFrame:
    return files.table_summary(fx.table(spark, d, "documents"), ["lang", "source"])


# --- projections, filters, set operations -----------------------------------


def select_existing(spark: SparkSession, d: str) -> DataFrame:
    wanted = ["l_quantity", "no_such_column", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return shaping.select_existing(fx.table(spark, d, "lineitem"), wanted)


def drop_nulls(spark: SparkSession, d: str) -> DataFrame:
    return shaping.drop_incomplete(fx.all_targets(spark, d))


def rename_map(spark: SparkSession, d: str) -> DataFrame:
    source = fx.table(spark, d, "customer").select(F.col("c_name").alias("k"), F.col("c_acctbal").alias("tg_src"))
    return shaping.rename_present(source, {"tg_src": "tg", "absent": "other"})


def label_union(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.table(spark, d, "documents")
    labels = fx.table(spark, d, "labels")
    real = docs.join(labels.where("quality = 1"), "doc_id").select("doc_id", "lang", "toxic")
    fake = docs.join(labels.where("quality <> 1"), "doc_id").select("lang", "doc_id")
    return shaping.stack_tables([shaping.label_source(real, 0), shaping.label_source(fake, 1)])


def result_map(spark: SparkSession, d: str) -> DataFrame:
    return fx.matches(spark, d).select(
        "match_id",
        result_class("ftr").alias("ftr_enc"),
        points("ftr").alias("points"),
        away_points("ftr").alias("away_points"),
        home_score("ftr").alias("score_home"),
        away_score("ftr").alias("score_away"),
    )


def pair_filter(spark: SparkSession, d: str) -> DataFrame:
    return scorelines.pair_filter(fx.matches(spark, d), fx.requests(spark, d), PAIR).select("match_id", *PAIR, "ftr")


def team_union(spark: SparkSession, d: str) -> DataFrame:
    return shaping.distinct_values(fx.matches(spark, d), PAIR, "team")


def team_list(spark: SparkSession, d: str) -> DataFrame:
    return scorelines.team_list(fx.matches(spark, d), PAIR)


def text_coerce(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.table(spark, d, "documents").withColumn("text", F.when(F.col("doc_id") % 10 != 0, F.col("text")))
    text = encode.text_or_nan("text")
    return docs.select("doc_id", F.md5(text).alias("text_md5"), F.length(text).cast("long").alias("n"))


# --- merges -----------------------------------------------------------------


def outer_merge(spark: SparkSession, d: str) -> DataFrame:
    base, supplement = fx.base_targets(spark, d), fx.supp_targets(spark, d)
    return merges.outer_merge(base, shaping.rename_present(supplement, {"tg_src": "tg"}), "k", "match")


def coalesce_merge(spark: SparkSession, d: str) -> DataFrame:
    base, supplement = fx.base_targets(spark, d), fx.supp_targets(spark, d)
    extra = fx.table(spark, d, "supplier").select(
        F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("k"), F.col("s_acctbal").alias("rg")
    )
    return merges.null_safe_merge(base, [supplement, extra], "k", {"tg_src": "tg"}, "match")


def supplements_csv(spark: SparkSession, d: str) -> DataFrame:
    """The same merge from supplement files, one of which is missing and is skipped."""
    folder = scratch_path(spark, "supplements")
    fx.supp_targets(spark, d).write.option("header", True).csv(f"{folder}/one")
    loaded, skipped = files.read_supplements(
        spark, [(f"{folder}/one", "k string, tg_src double"), (f"{folder}/two", "k string, rg double")]
    )
    merged = merges.null_safe_merge(fx.base_targets(spark, d), loaded, "k", {"tg_src": "tg"}, "match")
    return merged.withColumn("n_skipped", F.lit(len(skipped)))


def target_vector(spark: SparkSession, d: str) -> DataFrame:
    wide = fx.scored_wide(spark, d).withColumn("t", encode.target_vector(["p0", "p1", "p2", "p3"]))
    return wide.select("id", *[_r(F.get("t", F.lit(i)), 4).alias(f"t{i}") for i in range(4)], F.size("t").alias("n"))


def submission_join(spark: SparkSession, d: str) -> DataFrame:
    """Ids whose sample could not be parsed (no label in p1) keep a row without prediction."""
    ids = fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    predicted = graphs.parsed_only(fx.scored_wide(spark, d), "p1").select(
        "id", _r(F.col("p1") / 2, 2).alias("p0"), _r(F.col("p1"), 2).alias("p1")
    )
    return merges.attach_predictions(ids, predicted, "id")


def global_mean_fill(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(mean_fill(fx.gappy_targets(spark, d), ["tg"]), ["tg"])


def median_fill_query(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(median_fill(fx.gappy_targets(spark, d), ["tg"]), ["tg"])


# --- ordered features and ratings -------------------------------------------


def rolling_mean(spark: SparkSession, d: str) -> DataFrame:
    roles = {
        side: [Lagged(s, f"{side}_avg_{s}") for s in fx.STATS] for side in PAIR
    }
    out = [f"{side}_avg_{s}" for side in PAIR for s in fx.STATS]
    rolled = lagged_rolling(fx.matches(spark, d).select("match_id", *PAIR, *fx.STATS), "match_id", roles)
    return _rounded(rolled.select("match_id", *out), out)


def rolling_sliced(spark: SparkSession, d: str) -> DataFrame:
    """Two of the rolling means with every team cut into slices, as a team with very many games would be."""
    roles = {"home": [Lagged("fthg", "home_avg_fthg")], "away": [Lagged("aws", "away_avg_aws")]}
    games = fx.matches(spark, d).select("match_id", *PAIR, "fthg", "aws")
    rolled = lagged_rolling(games, "match_id", roles, width=SLICE_ROWS)
    return _rounded(rolled.select("match_id", "home_avg_fthg", "away_avg_aws"), ["home_avg_fthg", "away_avg_aws"])


def rolling_form(spark: SparkSession, d: str) -> DataFrame:
    games = fx.matches(spark, d).select("match_id", *PAIR, points("ftr").alias("pts"), away_points("ftr").alias("own"))
    roles = {
        "home": [Lagged("pts", "home_form", "sum", 0)],
        "away": [Lagged("pts", "away_form", "sum", 0), Lagged("own", "away_form_own", "sum", 0)],
    }
    rolled = lagged_rolling(games, "match_id", roles)
    return _long(rolled.select("match_id", "home_form", "away_form", "away_form_own"), "home_form", "away_form", "away_form_own")


def elo(spark: SparkSession, d: str) -> DataFrame:
    """Ratings per season."""
    return _rounded(elo_ratings(fx.matches(spark, d), "match_id", *PAIR, "ftr", "season"), ["home_elo", "away_elo"], 4)


def elo_expectation(spark: SparkSession, d: str) -> DataFrame:
    """The home side's expected score from both ratings."""
    rated = elo_ratings(fx.matches(spark, d), "match_id", *PAIR, "ftr", "season")
    return rated.select("match_id", _r(expected_score(F.col("home_elo"), F.col("away_elo"))).alias("expected"))


def elo_chunked(spark: SparkSession, d: str) -> DataFrame:
    """The same ratings folded in many chunks at once, as a long table would be."""
    rated = elo_ratings(fx.matches(spark, d), "match_id", *PAIR, "ftr", "season", chunk=CHUNK_ROWS)
    return _rounded(rated, ["home_elo", "away_elo"], 4)


def elo_single_pool(spark: SparkSession, d: str) -> DataFrame:
    """One rating per team over all seasons."""
    return _rounded(elo_ratings(fx.matches(spark, d), "match_id", *PAIR, "ftr"), ["home_elo", "away_elo"], 4)


def elo_waves(spark: SparkSession, d: str) -> DataFrame:
    """Ratings of one pool of very many players, played in waves of games that share no player."""
    rated = elo_ratings(fx.trades(spark, d), "trade_id", *PAIR, "ftr", chunk=CHUNK_ROWS)
    return _rounded(rated, ["home_elo", "away_elo"], 4)


def latest_or_mean_query(spark: SparkSession, d: str) -> DataFrame:
    games = fx.matches(spark, d)
    roles = {
        "home": [Lagged("fthg", "home_avg_fthg"), Lagged("hs", "home_avg_hs")],
        "away": [Lagged("ftag", "away_avg_ftag"), Lagged("aws", "away_avg_aws")],
    }
    history = store(
        lagged_rolling(games.select("match_id", *PAIR, "fthg", "hs", "ftag", "aws"), "match_id", roles), "history"
    )
    found = latest_or_mean(
        fx.requests(spark, d),
        history,
        "match_id",
        {"home": ("home", ["home_avg_fthg", "home_avg_hs"]), "away": ("away", ["away_avg_ftag", "away_avg_aws"])},
    )
    return _rounded(found, ["home_avg_fthg", "home_avg_hs", "away_avg_ftag", "away_avg_aws"])


def stall_stop_query(spark: SparkSession, d: str) -> DataFrame:
    return stall_stop(fx.run_metrics(spark, d), "run_id", "epoch", "loss")


# --- outcome statistics -----------------------------------------------------


def request_split(spark: SparkSession, d: str) -> DataFrame:
    checked = scorelines.check_requests(fx.requests(spark, d), fx.matches(spark, d), *PAIR)
    return checked.withColumn("reason", F.coalesce("reason", F.lit("valid")))


def scoreline_counts(spark: SparkSession, d: str) -> DataFrame:
    return scorelines.outcome_counts(fx.matches(spark, d), SCORE)


def scoreline_share(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(scorelines.outcome_shares(fx.matches(spark, d), SCORE, PAIR), ["prob"])


def head_to_head(spark: SparkSession, d: str) -> DataFrame:
    return scorelines.head_to_head(fx.matches(spark, d), fx.requests(spark, d), PAIR)


def top3_scorelines(spark: SparkSession, d: str) -> DataFrame:
    top = scorelines.top_outcomes(fx.matches(spark, d), fx.requests(spark, d), PAIR, SCORE)
    return _rounded(_long(top, "rank"), ["prob"])


def request_sheet(spark: SparkSession, d: str) -> DataFrame:
    """What a request's answer says without a model, or why it has none."""
    games = fx.matches(spark, d)
    sheet = match_model.describe_requests(fx.requests(spark, d), games, match_model.team_index(games))
    listed = {
        name: value
        for i in (1, 2, 3)
        for name, value in (
            (f"score_{i}", F.get("top", F.lit(i - 1))["score"]),
            (f"share_{i}", F.round(F.get("top", F.lit(i - 1))["share"], 6)),
        )
    }
    return sheet.withColumns(listed).drop("top")


def likely_scoreline(spark: SparkSession, d: str) -> DataFrame:
    likely = scorelines.likely_outcome(fx.matches(spark, d), fx.requests(spark, d), PAIR, SCORE)
    return likely.select("req_id", scorelines.score_text(F.col("fthg"), F.col("ftag")).alias("scoreline"), _r("prob").alias("prob"))


# --- encodings and splits ---------------------------------------------------


def team_index(spark: SparkSession, d: str) -> DataFrame:
    games = fx.matches(spark, d)
    index = encode.label_index(games, PAIR, "team")
    return _long(
        encode.apply_label_index(games, index, PAIR, "team").select("match_id", "home_enc", "away_enc"),
        "home_enc", "away_enc",
    )


def _features(spark: SparkSession, d: str) -> DataFrame:
    return fx.prepared(spark, d, "match_features", lambda: match_model.match_features(fx.matches(spark, d)))


def match_features(spark: SparkSession, d: str) -> DataFrame:
    """All model inputs, with ratings per season so that SQL can check them."""
    featured = match_model.match_features(fx.matches(spark, d), pool="season")
    return _rounded(
        _long(featured, "home_enc", "away_enc", "home_form", "away_form", "ftr_enc").select(
            "match_id", *match_model.FEATURES, "ftr_enc"
        ),
        [c for c in match_model.FEATURES if "_avg_" in c or c.endswith("_elo")],
        4,
    )


def split_80_20(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_80_20(fx.matches(spark, d).select("match_id"), "match_id")


def split_70_15_15(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_70_15_15(fx.table(spark, d, "documents").select("doc_id"), "doc_id")


def seeded_shuffle(spark: SparkSession, d: str) -> DataFrame:
    return splits.seeded_shuffle(fx.table(spark, d, "documents").select("doc_id"), "doc_id")


def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_counts(splits.split_70_15_15(fx.news(spark, d), "doc_id"), ["split", "label"])


def pad_mask(spark: SparkSession, d: str) -> DataFrame:
    ids = F.transform(encode.words(F.col("text")), lambda w: F.length(w))
    padded, mask = encode.pad(ids), encode.pad_mask(ids)
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    return fx.table(spark, d, "documents").select(
        "doc_id",
        F.size(ids).cast("long").alias("n_words"),
        F.array_join(padded.cast("array<string>"), " ").alias("padded"),
        F.size(mask).cast("long").alias("n_mask"),
        total(mask).alias("n_used"),
    )


def token_ids(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    vocab = store(encode.vocabulary(docs), "vocabulary")
    encoded = encode.encode_texts(docs, vocab, "doc_id")
    return encoded.select(
        "doc_id",
        F.col("n_ids").cast("long").alias("n_ids"),
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.array_join(F.col("attention_mask").cast("array<string>"), "").alias("attention_mask"),
    )


def argmax_label(spark: SparkSession, d: str) -> DataFrame:
    scores = F.col("embedding")
    two = F.slice(scores, 1, 2)
    return fx.table(spark, d, "embeddings").select(
        "vec_id",
        metrics.argmax(scores).cast("long").alias("best_of_all"),
        mapped(metrics.argmax(two), {0: "REAL", 1: "FAKE"}).alias("verdict"),
    )


# --- metrics ----------------------------------------------------------------


def property_stats(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.property_stats(fx.scored_long(spark, d)), ["value_range"], 4)


def property_weights(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.property_weights(fx.scored_long(spark, d)), ["value_range", "weight"], 10)


def wmae(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.weighted_mae(fx.scored_long(spark, d)), ["wmae"], 10)


def batch_loss(spark: SparkSession, d: str) -> DataFrame:
    long = fx.scored_long(spark, d)
    return _rounded(metrics.batch_loss(long, metrics.property_weights(long)), ["loss"], 10)


def accuracy(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.accuracy(fx.class_scored(spark, d), "y", "y_hat"), ["accuracy"])


def class_report(spark: SparkSession, d: str) -> DataFrame:
    report = metrics.class_report(fx.class_scored(spark, d), "y", "y_hat", {"A": "Away", "N": "None"})
    return _rounded(report, ["precision", "recall", "f1"])


def epoch_loss(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(metrics.epoch_loss(fx.run_metrics(spark, d)), ["mean_loss"])


# --- graphs -----------------------------------------------------------------


def graph_pool(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(graphs.mean_pool(fx.graph_nodes(spark, d), ["f0"]), ["f0"])


def graph_degree(spark: SparkSession, d: str) -> DataFrame:
    return graphs.degrees(fx.graph_nodes(spark, d), fx.graph_edges(spark, d)).select("graph_id", "node_id", "degree")


def graph_undirected(spark: SparkSession, d: str) -> DataFrame:
    return graphs.undirected(fx.graph_edges(spark, d))


def graph_noise(spark: SparkSession, d: str) -> DataFrame:
    """Noise on the training graphs only; every fifth graph is held out."""
    training = F.col("graph_id") % 5 != 0
    return _rounded(graphs.graph_noise(fx.graph_nodes(spark, d), ["f0"], training=training), ["f0"])


# --- detections -------------------------------------------------------------


def conf_filter(spark: SparkSession, d: str) -> DataFrame:
    return det.confident(fx.detections(spark, d)).select("det_id", "conf")


def box_trunc(spark: SparkSession, d: str) -> DataFrame:
    return det.int_box(fx.detections(spark, d)).select("det_id", "x1", "y1", "x2", "y2")


def class_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Classes from a table: the nations, by number."""
    classes = fx.table(spark, d, "nation").select(
        F.col("n_nationkey").alias("class_id"), F.initcap("n_name").alias("class_name")
    )
    return det.with_class_name(fx.detections(spark, d), classes.where("class_id <> 3")).select(
        "det_id", "class_id", "class_name"
    )


def label_format(spark: SparkSession, d: str) -> DataFrame:
    named = det.with_class_name(fx.detections(spark, d), fx.CLASSES)
    return named.select("det_id", det.label_text(F.col("class_name"), F.col("conf")).alias("label"))


def _flat(shaped: DataFrame) -> DataFrame:
    """Shaped detections with the polygon as text."""
    point = F.transform("polygon", lambda p: F.concat_ws(",", p["x"].cast("string"), p["y"].cast("string")))
    return shaped.select(
        "frame_id", F.col("det_no").cast("long").alias("det_no"), "class_id", "class_name", "conf",
        "x1", "y1", "x2", "y2", "label", F.array_join(point, " ").alias("polygon"),
    )


def detections_shape(spark: SparkSession, d: str) -> DataFrame:
    return _flat(det.shape_detections(fx.frames(spark, d), fx.CLASSES))


def polygon_area(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(det.class_areas(det.shape_detections(fx.frames(spark, d), fx.CLASSES)), ["area"], 2)


def stream_detections(spark: SparkSession, d: str) -> DataFrame:
    """Frames arriving in files, shaped by a stream that stops at the end of its source."""
    arriving = scratch_path(spark, "frames")
    fx.frames(spark, d).write.parquet(arriving)
    shaped = shape_stream(
        spark, arriving, fx.CLASSES, scratch_path(spark, "shaped"), scratch_path(spark, "offsets")
    )
    return _flat(shaped)


def stream_elo(spark: SparkSession, d: str) -> DataFrame:
    """Games arriving in parts, rated batch by batch with carried ratings."""
    games = fx.matches(spark, d).select("match_id", "season", *PAIR, "ftr")
    arriving, rated, offsets = (scratch_path(spark, label) for label in ("games", "rated", "offsets"))
    last = games.agg(F.max("match_id")).first()[0]
    out = None
    for part in range(ARRIVALS):
        low, high = last * part // ARRIVALS, last * (part + 1) // ARRIVALS
        games.where(F.col("match_id").between(low + 1, high)).write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(games.schema).parquet(arriving)
        out = rate_stream(stream, rated, offsets, "match_id", *PAIR, "ftr", "season")
    return _rounded(out, ["home_elo", "away_elo"], 4)


# --- models -----------------------------------------------------------------


def _split_features(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    ready = match_model.assemble(splits.split_80_20(_features(spark, d), "match_id"))
    return ready.where("split = 'train'"), ready.where("split = 'test'")


def _scored_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """The held-out games with the probabilities of the outcome model."""

    def build() -> DataFrame:
        train, test = _split_features(spark, d)
        train = match_model.training_rows(train)
        try:
            return match_model.score_outcome(match_model.fit_outcome(train), test).select(
                "match_id", "ftr_enc", "y_hat", "p_home", "p_draw", "p_away"
            )
        finally:
            train.unpersist()

    return fx.prepared(spark, d, "scored_outcomes", build)


def match_model_query(spark: SparkSession, d: str) -> DataFrame:
    """Report of the outcome model on the held-out games."""
    return metrics.class_report(_scored_outcomes(spark, d), "ftr_enc", "y_hat", CLASS_NAMES)


def outcome_check(spark: SparkSession, d: str) -> DataFrame:
    """Per class of the held-out games: how many, whether all probabilities are sound, and whether the model's log
    loss comes within 2 % of guessing the class shares, or below."""
    scored = _scored_outcomes(spark, d)
    train, _ = _split_features(spark, d)
    losses = match_model.log_loss(scored, train).withColumn("ok", F.col("log_loss") <= 1.02 * F.col("shares_loss"))
    p = [F.col(c) for c in ("p_home", "p_draw", "p_away")]
    sound = (F.abs(p[0] + p[1] + p[2] - 1) < 1e-9) & (F.least(*p) >= 0) & F.col("y_hat").isin(0, 1, 2)
    return (
        scored.groupBy(F.col("ftr_enc").cast("long").alias("result"))
        .agg(F.count(F.lit(1)).alias("support"), F.every(sound).alias("sound"))
        .withColumn("loss_ok", losses.select("ok").scalar())
    )


def _scored_goals(spark: SparkSession, d: str) -> DataFrame:
    """The held-out games with both sides' goals and their predictions."""

    def build() -> DataFrame:
        train, test = _split_features(spark, d)
        train = match_model.training_rows(train)
        try:
            scored = test
            with ThreadPoolExecutor(len(SCORE)) as pool:  # the fits are independent
                models = list(pool.map(lambda target: match_model.fit_goals(train, target), SCORE))
            for model in models:
                scored = model.transform(scored)
            return scored.select("match_id", *SCORE, *[f"pred_{t}" for t in SCORE])
        finally:
            train.unpersist()

    return fx.prepared(spark, d, "scored_goals", build)


def goal_models(spark: SparkSession, d: str) -> DataFrame:
    """Error of both goal models on the held-out games."""
    return _scored_goals(spark, d).agg(
        *[F.avg(F.abs(F.col(t) - F.col(f"pred_{t}"))).alias(f"mae_{t}") for t in SCORE], F.count("*").alias("n")
    )


def goals_check(spark: SparkSession, d: str) -> DataFrame:
    """Per held-out game: its goals, and whether both predictions are numbers not far outside the goals seen."""
    near = [F.col(f"pred_{t}").between(-5, 10) for t in SCORE]
    return _scored_goals(spark, d).select("match_id", *SCORE, F.coalesce(near[0] & near[1], F.lit(False)).alias("sound"))


def request_answers(spark: SparkSession, d: str) -> DataFrame:
    def build() -> DataFrame:
        history = _features(spark, d)
        train, _ = _split_features(spark, d)
        models = match_model.fit_models(train, match_model.team_index(history))
        return match_model.answer_requests(fx.requests(spark, d), history, models)

    return fx.prepared(spark, d, "request_answers", build)


def answers_check(spark: SparkSession, d: str) -> DataFrame:
    """Per request: what its answer holds, and whether probabilities and goals are there exactly if it was not rejected."""
    p = F.col("p_home") + F.col("p_draw") + F.col("p_away")
    whole = (F.abs(p - 1) < 1e-9) & F.col("pred_fthg").isNotNull() & F.col("pred_ftag").isNotNull() & F.col("answer").isNotNull()
    empty = p.isNull() & F.col("pred_fthg").isNull() & F.col("pred_ftag").isNull() & F.col("answer").isNull()
    sound = F.when(F.col("reason").isNull(), whole).otherwise(empty)
    columns = ["req_id", *PAIR, "reason", "scoreline", "games", "home_wins", "draws", "away_wins"]
    return request_answers(spark, d).select(*columns, F.coalesce(sound, F.lit(False)).alias("sound"))


def request_inputs(spark: SparkSession, d: str) -> DataFrame:
    """The model inputs of every valid request that come from ratings per season, team numbers and the newest games."""
    history = fx.prepared(
        spark, d, "season_features", lambda: match_model.match_features(fx.matches(spark, d), pool="season")
    )
    teams = match_model.team_index(history)
    valid = scorelines.check_against(fx.requests(spark, d), teams, "label", *PAIR).where(F.col("reason").isNull())
    found = match_model.request_features(valid.select("req_id", *PAIR), history, teams)
    columns = ["home_enc", "away_enc", "home_avg_fthg", "away_avg_ftag", "home_form", "away_form"]
    out = _long(found, "home_enc", "away_enc").select("req_id", *PAIR, *columns)
    return _rounded(out, columns[2:], 4)


def raw_match_features(spark: SparkSession, d: str) -> DataFrame:
    """From raw games with gaps to complete model inputs."""
    featured = match_model.raw_match_features(fx.raw_matches(spark, d), pool="season")
    columns = ["home_avg_hst", "away_avg_ast", "home_avg_fthg", "home_elo", "away_elo"]
    return _rounded(featured.select("match_id", *PAIR, "ftr", *columns), columns, 4)


def _split_news(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_70_15_15(fx.news(spark, d), "doc_id")


def _scored_news(spark: SparkSession, d: str) -> DataFrame:
    """Every document, labelled or not, with its score, and its part if it has one."""

    def build() -> DataFrame:
        news = _split_news(spark, d)
        model = text_model.fit_text_model(news.where("split = 'train'"))
        docs = fx.table(spark, d, "documents").select("doc_id", "text")
        scored = text_model.score_texts(model, docs).drop("text")
        return scored.join(news.select("doc_id", "label", "split"), "doc_id", "left")

    return fx.prepared(spark, d, "scored_news", build)


def text_model_query(spark: SparkSession, d: str) -> DataFrame:
    """Report of the text model on the test part."""
    return metrics.class_report(_scored_news(spark, d).where("split = 'test'"), "label", "y_hat")


def text_check(spark: SparkSession, d: str) -> DataFrame:
    """Per part and class: how many texts, and whether the model is right more often than the larger class is large."""
    scored = _scored_news(spark, d).where("split is not null")
    counts = scored.groupBy("split", F.col("label").cast("long").alias("label")).agg(F.count(F.lit(1)).alias("support"))
    right = scored.groupBy("split").agg(
        (F.avg((F.col("label") == F.col("y_hat")).cast("double")) >= F.greatest(F.avg("label"), 1 - F.avg("label"))).alias("learnt")
    )
    return counts.join(right, "split")


def text_predict(spark: SparkSession, d: str) -> DataFrame:
    """A verdict for every document, labelled or not."""
    return _scored_news(spark, d).select("doc_id", "p_fake", "verdict")


def verdict_check(spark: SparkSession, d: str) -> DataFrame:
    """Per document, labelled or not: whether its score and its verdict are there and fit each other."""
    sound = F.col("p_fake").between(0, 1) & (F.col("verdict") == F.when(F.col("p_fake") > 0.5, "FAKE").otherwise("REAL"))
    return _scored_news(spark, d).select("doc_id", F.coalesce(sound, F.lit(False)).alias("sound"))


def outside_scores(spark: SparkSession, d: str) -> DataFrame:
    """Vectors and labels scored in batches by a model from outside Spark."""
    load = outside_model.linear_model([(i * 37 % 11 - 5) / 10 for i in range(64)], 0.25, -1.0)
    vectors = fx.table(spark, d, "embeddings").select("vec_id", "embedding", "label")
    scored = outside_model.score_batches(vectors, load, ["embedding", "label"], shapes=[[64], None])
    return scored.select("vec_id", _r("score", 5).alias("score"))


TARGETS = ["p0", "p1", "p2", "p3"]


def _order_sizes(spark: SparkSession, d: str) -> DataFrame:
    """The sparse targets of every order, and its number of line items as the input."""
    lines = fx.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count(F.lit(1)).alias("lines"))
    return fx.scored_wide(spark, d).join(lines, "id", "left")


def target_fits(spark: SparkSession, d: str) -> DataFrame:
    """Slope, intercept and labelled rows of every target's least-squares line; a target without labels has nulls."""
    models = multitarget.fit_targets(_order_sizes(spark, d), ["lines"], TARGETS, reg=0.0)
    rows = [(t, m and m.weights[0], m and m.intercept, m.n if m else 0) for t, m in models.items()]
    fits = spark.createDataFrame(rows, "target string, slope double, intercept double, n long")
    return _rounded(fits, ["slope", "intercept"], 3)


def target_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Every order's predictions from one fit of all targets."""
    samples = store(_order_sizes(spark, d), "order-sizes")
    models = multitarget.fit_targets(samples, ["lines"], TARGETS, reg=0.0)
    wide = merges.attach_predictions(samples.select("id"), multitarget.predict_targets(samples, models, ["lines"], "id"), "id")
    return _rounded(wide, [f"pred_{t}" for t in TARGETS], 2)


def multitarget_model(spark: SparkSession, d: str) -> DataFrame:
    """Weighted error of per-target models on pooled graph features, on held-out samples."""
    pooled = multitarget.graph_inputs(fx.graph_nodes(spark, d), fx.graph_edges(spark, d), ["f0"])
    samples = fx.scored_wide(spark, d).join(pooled.withColumnRenamed("graph_id", "id"), "id", "left")
    samples = store(splits.split_80_20(samples, "id"), "samples")
    inputs = ["f0", "degree", "n_nodes"]
    models = multitarget.fit_targets(samples.where("split = 'train'"), inputs, TARGETS)
    held = samples.where("split = 'test'")
    wide = merges.attach_predictions(held, multitarget.predict_targets(held, models, inputs, "id"), "id")
    cells = [
        F.struct(F.lit(t).alias("property"), F.col(t).alias("y_true"), F.col(f"pred_{t}").alias("y_pred"))
        for t in TARGETS
    ]
    long = wide.where(F.col("f0").isNotNull()).select("id", F.inline(F.array(*cells)))
    return metrics.weighted_mae(long)


EPOCHS = 3


def _order_epochs(spark: SparkSession, d: str) -> DataFrame:
    rows = assign_sequence(fx.table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), ["id"], "row", 0)
    return epochs.epoch_batches(store(rows, "numbered-orders"), "row", EPOCHS)


def epoch_batches(spark: SparkSession, d: str) -> DataFrame:
    """Every order once per epoch, each epoch in an order of its own, in batches of 32."""
    return _order_epochs(spark, d).select("id", "epoch", "position", "batch_id")


def epoch_batch_loss(spark: SparkSession, d: str) -> DataFrame:
    """Loss of the reshuffled batches of every epoch, weighted by the properties of the whole table."""
    long = fx.scored_long(spark, d).drop("batch_id")
    batches = _order_epochs(spark, d).select("id", F.struct("epoch", "batch_id").alias("batch"))
    lost = metrics.batch_loss(long.join(batches, "id"), metrics.property_weights(long), batch="batch")
    return lost.select("batch.epoch", "batch.batch_id", _r("loss", 8).alias("loss"), "n_rows")


def validation_loss(spark: SparkSession, d: str) -> DataFrame:
    """Loss of the validation batches with the weights of the training rows."""
    long = splits.split_70_15_15(fx.scored_long(spark, d), "id")
    weights = store(metrics.property_weights(long.where("split = 'train'")), "weights")
    lost = metrics.batch_loss(long.where("split = 'validation'"), weights)
    return _rounded(lost, ["loss"], 8)


QUERIES = {
    "season_manifest": season_manifest,
    "html_table": html_table,
    "html_missing": html_missing,
    "header_flatten": header_flatten,
    "header_rows_drop": header_rows_drop,
    "left_merge": left_merge,
    "seasons_csv": seasons_csv,
    "news_files": news_files,
    "supplement_rejects": supplement_rejects,
    "submission_csv": submission_csv,
    "table_summary": table_summary,
    "select_existing": select_existing,
    "drop_nulls": drop_nulls,
    "rename_map": rename_map,
    "label_union": label_union,
    "result_map": result_map,
    "pair_filter": pair_filter,
    "team_union": team_union,
    "team_list": team_list,
    "text_coerce": text_coerce,
    "outer_merge": outer_merge,
    "coalesce_merge": coalesce_merge,
    "supplements_csv": supplements_csv,
    "target_vector": target_vector,
    "submission_join": submission_join,
    "global_mean_fill": global_mean_fill,
    "median_fill": median_fill_query,
    "rolling_mean": rolling_mean,
    "rolling_sliced": rolling_sliced,
    "rolling_form": rolling_form,
    "elo": elo,
    "elo_chunked": elo_chunked,
    "elo_expectation": elo_expectation,
    "elo_single_pool": elo_single_pool,
    "elo_waves": elo_waves,
    "latest_or_mean": latest_or_mean_query,
    "stall_stop": stall_stop_query,
    "request_split": request_split,
    "scoreline_counts": scoreline_counts,
    "scoreline_share": scoreline_share,
    "head_to_head": head_to_head,
    "top3_scorelines": top3_scorelines,
    "request_sheet": request_sheet,
    "likely_scoreline": likely_scoreline,
    "team_index": team_index,
    "match_features": match_features,
    "split_80_20": split_80_20,
    "split_70_15_15": split_70_15_15,
    "seeded_shuffle": seeded_shuffle,
    "split_counts": split_counts,
    "pad_mask": pad_mask,
    "token_ids": token_ids,
    "argmax_label": argmax_label,
    "property_stats": property_stats,
    "property_weights": property_weights,
    "wmae": wmae,
    "batch_loss": batch_loss,
    "accuracy": accuracy,
    "class_report": class_report,
    "epoch_loss": epoch_loss,
    "graph_pool": graph_pool,
    "graph_degree": graph_degree,
    "graph_undirected": graph_undirected,
    "graph_noise": graph_noise,
    "conf_filter": conf_filter,
    "box_trunc": box_trunc,
    "class_lookup": class_lookup,
    "label_format": label_format,
    "detections_shape": detections_shape,
    "polygon_area": polygon_area,
    "stream_detections": stream_detections,
    "stream_elo": stream_elo,
    "match_model": match_model_query,
    "goal_models": goal_models,
    "request_answers": request_answers,
    "text_model": text_model_query,
    "text_predict": text_predict,
    "multitarget_model": multitarget_model,
    "outcome_check": outcome_check,
    "goals_check": goals_check,
    "answers_check": answers_check,
    "request_inputs": request_inputs,
    "raw_match_features": raw_match_features,
    "text_check": text_check,
    "verdict_check": verdict_check,
    "outside_scores": outside_scores,
    "target_fits": target_fits,
    "target_predictions": target_predictions,
    "epoch_batches": epoch_batches,
    "epoch_batch_loss": epoch_batch_loss,
    "validation_loss": validation_loss,
}
