"""Views that put the shapes of match, text, label and detection data on the given tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from formline.operators.sequence import assign_sequence, sequence_within
from formline.operators.shaping import in_blocks
from formline.session import scratch_path
from formline.sources.html import AGAINST_TABLE, FOR_TABLE

# The twelve statistics of a match, home then away.
STATS = ("fthg", "ftag", "hs", "aws", "hst", "ast", "hc", "ac", "hy", "ay", "hr", "ar")
CLASSES = {0: "apple", 1: "bread", 2: "rice"}
MATCH_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

_stored: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of change of the tables in a folder, which is asked through Spark's file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))


def prepared(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A table built once per application and state of the input folder, then read from the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, input_state(spark, sf_dir), name)
    if key in _stored:
        try:
            return spark.read.parquet(_stored[key])
        except AnalysisException:
            del _stored[key]  # the scratch folder was emptied
    path = scratch_path(spark, name)
    build().write.parquet(path)
    _stored[key] = path
    return spark.read.parquet(path)


def _pairings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the nations that play, as their numbers and with no more than ``games_of`` needs.

    Orders meet their customers before they meet the line items, so the line items are shuffled for their order and
    their supplier only, and as narrow rows.
    """
    t = lambda name: table(spark, sf_dir, name)
    home = t("nation").select(F.col("n_nationkey").alias("hk"), F.col("n_name").alias("home"))
    away = t("nation").select(F.col("n_nationkey").alias("ak"), F.col("n_name").alias("away"))
    hosts = (
        t("customer").select("c_custkey", "c_nationkey").join(home, F.col("c_nationkey") == F.col("hk"))
    ).select("c_custkey", "home")
    guests = (
        t("supplier").select("s_suppkey", "s_nationkey").join(away, F.col("s_nationkey") == F.col("ak"))
    ).select("s_suppkey", "away")
    ordered = (
        t("orders").select("o_orderkey", "o_custkey").join(hosts, F.col("o_custkey") == F.col("c_custkey"))
    ).select("o_orderkey", "home")
    return (
        t("lineitem")
        .select(*MATCH_ORDER, F.floor("l_quantity").cast("int").alias("qty"))
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(guests, F.col("l_suppkey") == F.col("s_suppkey"))
        .where(F.col("home") != F.col("away"))
        .select(*MATCH_ORDER, "qty", "home", "away")
    )


def _games_of(pairings: DataFrame, *kept: str) -> DataFrame:
    """The statistics of every pairing: each follows from its own row."""
    qty = F.col("qty")
    fthg, ftag = F.col("l_linenumber") % 5, qty % 4
    hthg, htag = F.floor(fthg / 2).cast("int"), F.floor(ftag / 2).cast("int")
    result = lambda h, a: F.when(h > a, "H").when(h < a, "A").otherwise("D")
    i = lambda column: column.cast("int")
    return pairings.select(
        *kept,
        F.year("l_shipdate").alias("season"),
        "home",
        "away",
        i(fthg).alias("fthg"),
        i(ftag).alias("ftag"),
        result(fthg, ftag).alias("ftr"),
        hthg.alias("hthg"),
        htag.alias("htag"),
        result(hthg, htag).alias("htr"),
        qty.alias("hs"),
        i(F.col("l_linenumber") * 3).alias("aws"),
        i(F.col("l_partkey") % 9).alias("hst"),
        i(F.col("l_suppkey") % 9).alias("ast"),
        i(F.col("l_partkey") % 12).alias("hc"),
        i(F.col("l_suppkey") % 11).alias("ac"),
        i(F.col("l_orderkey") % 6).alias("hy"),
        i(F.col("l_partkey") % 5).alias("ay"),
        i(F.col("l_orderkey") % 2).alias("hr"),
        i(F.col("l_suppkey") % 2).alias("ar"),
    )


def unordered_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as games between the customer's and the supplier's nation; a nation does not play itself."""
    return _games_of(_pairings(spark, sf_dir), *MATCH_ORDER)


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games with their dense order ``match_id``; pairings are sorted, and widened to games only when stored."""

    def build() -> DataFrame:
        numbered = assign_sequence(_pairings(spark, sf_dir), MATCH_ORDER, "match_id")
        games = _games_of(numbered, "match_id")
        return games.select(*[c for c in games.columns if c != "match_id"], "match_id")

    return prepared(spark, sf_dir, "matches", build)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as games between customers and parts: one pool of very many players with few games each."""

    def build() -> DataFrame:
        t = lambda name: table(spark, sf_dir, name)
        fthg, ftag = F.col("l_linenumber") % 5, F.floor("l_quantity").cast("int") % 4
        played = (
            t("lineitem")
            .join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                *MATCH_ORDER,
                F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("home"),
                F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("away"),
                F.when(fthg > ftag, "H").when(fthg < ftag, "A").otherwise("D").alias("ftr"),
            )
        )
        return assign_sequence(played, MATCH_ORDER, "trade_id").select("trade_id", "home", "away", "ftr")

    return prepared(spark, sf_dir, "trades", build)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One match request per order; some name an unknown team, some a pair that never met."""
    t = lambda name: table(spark, sf_dir, name)
    home = t("nation").select(F.col("n_nationkey").alias("hk"), F.col("n_name").alias("home"))
    away = t("nation").select(F.col("n_nationkey").cast("long").alias("ak"), F.col("n_name").alias("known"))
    return (
        t("orders")
        .join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(home, F.col("c_nationkey") == F.col("hk"))
        .join(away, (F.col("o_orderkey") % 27) == F.col("ak"), "left")
        .select(F.col("o_orderkey").alias("req_id"), "home", F.coalesce("known", F.lit("UNKNOWN")).alias("away"))
    )


def scored_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as samples with four sparse targets; the last one has no labels."""
    price = F.col("o_totalprice")
    target = lambda j: F.when(F.col("o_orderkey") % 4 != j, price * (j + 1))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        *[target(j).alias(f"p{j}") for j in range(3)],
        F.lit(None).cast("double").alias("p3"),
    )


def scored_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth and prediction per sample and property."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    cells = [
        F.struct(
            F.lit(f"p{j}").alias("property"),
            (F.when(key % 4 != j, price * (j + 1)) if j < 3 else F.lit(None).cast("double")).alias("y_true"),
            (price * (j + 1) + (key % 7) - 3).alias("y_pred"),
        )
        for j in range(4)
    ]
    return table(spark, sf_dir, "orders").select(
        key.alias("id"), F.floor(key / 32).cast("long").alias("batch_id"), F.inline(F.array(*cells))
    )


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The games as season files hold them: some have no result, some lack a statistic, some a side."""
    games, no = matches(spark, sf_dir), F.col("match_id")
    return games.withColumns(
        {
            "ftr": F.when(no % 97 != 0, F.col("ftr")),
            "hst": F.when(no % 89 != 0, F.col("hst").cast("double")).otherwise(float("nan")),
            "away": F.when(no % 83 != 0, F.col("away")),
            "referee": F.lit(None).cast("string"),
        }
    )


def _targets(customers: DataFrame) -> DataFrame:
    """A sparse target per key; three customers have no key (null)."""
    return customers.select(
        F.when(~F.col("c_custkey").isin(1, 501, 1001), F.col("c_name")).alias("k"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).alias("tg"),
    )


def all_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse target of every customer."""
    return _targets(table(spark, sf_dir, "customer"))


def gappy_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target of every customer; of the missing ones, some are NaN and the rest null."""
    c = table(spark, sf_dir, "customer")
    target = F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")).when(F.col("c_custkey") % 11 == 0, float("nan"))
    return c.select(F.col("c_name").alias("k"), target.alias("tg"))


def base_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The targets of two thirds of the keys, so that a merge has keys without a match on either side."""
    return _targets(table(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 != 0))


def supp_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A supplement under another column name, with repeated keys and two null keys."""
    c = table(spark, sf_dir, "customer")
    name, balance = F.col("c_name"), F.col("c_acctbal")
    once = c.where(F.col("c_custkey") % 3 != 1).select(name.alias("k"), (balance + 1).alias("tg_src"))
    again = c.where(F.col("c_custkey") % 50 == 0).select(
        F.when(~F.col("c_custkey").isin(750, 1500), name).alias("k"), (balance + 2).alias("tg_src")
    )
    return once.unionAll(again)


def class_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    guess = F.when(line % 3 == 0, "A").when(line % 5 == 0, "N").otherwise(F.col("l_returnflag"))
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("y"), guess.alias("y_hat"))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses per epoch of one run per user."""

    def build() -> DataFrame:
        events = table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), "ts", "event_id", F.col("value").alias("loss"))
        return sequence_within(events, "run_id", ["ts", "event_id"], "epoch").select("run_id", "epoch", "loss")

    return prepared(spark, sf_dir, "run_metrics", build)


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled texts: 0 real, 1 fake."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id")
        .select("doc_id", "text", F.when(F.col("quality") == 1, 0).otherwise(1).alias("label"))
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five events as the detections of one frame; only the first three have polygons."""
    value, no = F.col("value"), (F.col("event_id") % 5).cast("int")
    x1, y1, x2, y2 = value - 100, value - 50, value, value + 20
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    entry = F.struct(
        F.col("event_id"),
        F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")).alias("box"),
        (F.col("event_id") * 37 % 100 / F.lit(100.0)).alias("conf"),
        (F.col("user_id") % 4).cast("int").alias("class_id"),
        F.when(no < 3, F.array(corner(x1, y1), corner(x2, y1), corner(x2, y2), corner(x1, y2))).alias("polygon"),
    )
    packed = (
        table(spark, sf_dir, "events")
        .groupBy(F.floor(F.col("event_id") / 5).cast("long").alias("frame_id"))
        .agg(F.array_sort(F.collect_list(entry)).alias("d"))  # five unique events at most
    )
    return packed.select(
        "frame_id",
        F.col("d.box").alias("boxes"),
        F.col("d.conf").alias("confs"),
        F.col("d.class_id").alias("class_ids"),
        F.filter("d.polygon", lambda p: p.isNotNull()).alias("polygons"),
    )


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same detections, one per row."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("det_id"),
        (F.col("event_id") * 37 % 100 / F.lit(100.0)).alias("conf"),
        (F.col("user_id") % 4).cast("int").alias("class_id"),
        (value - 100).alias("x1"),
        (value - 50).alias("y1"),
        value.alias("x2"),
        (value + 20).alias("y2"),
    )


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, lines = F.col("l_linenumber"), table(spark, sf_dir, "lineitem")
    edges = lines.select(
        F.col("l_orderkey").alias("graph_id"),
        line.cast("int").alias("src"),
        (line % 7 + 1).cast("int").alias("dst"),
        F.col("l_returnflag").alias("attr"),
    )
    return in_blocks(edges, lines.count(), edges.columns).distinct()


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    graphs = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("graph_id")).distinct()
    return graphs.select("graph_id", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("node_id")).withColumn(
        "f0", (F.col("graph_id") % 13 + F.col("node_id")).cast("double")
    )


def stat_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of squad tables made from customers, twenty to a page.

    Every tenth row repeats the header, every fourth squad is missing from the
    second table, and every seventh page lacks that table. Ampersands are named or numbered entities. In the first
    table the rank of every page's fifth row spans two rows, and some squads have an empty table in their cell or an accent
    as a named entity behind their name.
    """
    key = F.col("c_custkey")
    text = lambda c: c.cast("string")
    td = lambda *cells: F.concat(
        F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>\n")
    )
    repeat = lambda second: F.when(
        key % 10 == 0, F.lit(f"<tr class='thead'><th>Rk</th><th>Squad</th><th>MP</th><th>{second}</th></tr>")
    ).otherwise("")
    ampersand = F.element_at(F.array(F.lit("&amp;"), F.lit("&#38;"), F.lit("&#x26;")), (key % 3 + 1).cast("int"))
    accent = F.when(key % 6 == 0, "&eacute;").otherwise("")
    nested = F.when(key % 3 == 0, "<table class='x'><tr><td> </td></tr></table>").otherwise("")
    squad = F.concat(F.lit('<a href="/s">'), F.col("c_name"), F.lit(" "), ampersand, F.lit(" Co"), accent, F.lit("</a>"))
    rest = td(F.concat(squad, nested), text(F.col("c_nationkey")), text(F.floor("c_acctbal").cast("long")))
    spanned = key % 20 == 5  # the rank of the row before covers this one
    rank = F.when(spanned, "").otherwise(
        F.concat(F.when(key % 20 == 4, "<td rowspan='2'>").otherwise("<td>"), text(key % 20), F.lit("</td>"))
    )
    for_row = F.concat(repeat("Gls"), F.lit("<tr>"), rank, F.substring(rest, 5, 1 << 30))
    against_row = F.concat(repeat("GA"), td(text(key % 20), squad, text(F.col("c_nationkey") + 1), text(key % 90)))
    packed = (
        table(spark, sf_dir, "customer")
        .groupBy(F.floor(key / 20).cast("long").alias("page_id"))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(key.alias("k"), for_row.alias("f"), F.when(key % 4 != 0, against_row).otherwise("").alias("a"))
                )
            ).alias("r")
        )
    )
    head = lambda last: (
        "<thead><tr><th></th><th>Unnamed: 1_level_0</th><th colspan=\"2\">Performance</th></tr>\n"
        f"<tr><th>Rk</th><th>Squad</th><th>MP</th><th>{last}</th></tr></thead><tbody>"
    )
    whole = lambda name, last, rows: F.concat(
        F.lit(f'<table class="stats" id="{name}">{head(last)}'), F.array_join(rows, ""), F.lit("</tbody></table>")
    )
    second = F.when(F.col("page_id") % 7 != 3, whole(AGAINST_TABLE, "GA", F.col("r.a"))).otherwise("")
    html = F.concat(
        F.lit('<html><body><!-- <table id="stats_squads_standard_for"></table> --><table id="decoy"><tr><td>x</td></tr></table>'),
        whole(FOR_TABLE, "Gls", F.col("r.f")),
        second,
        F.lit("</body></html>"),
    )
    return packed.select("page_id", html.alias("html"))
