"""HTML tables, CSV sources, graphs and detections."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from formline.operators import detections as det
from formline.operators import graphs
from formline.session import scratch_path
from formline.sources import files, html
from formline.streaming.detections import shape_stream

PAGE = """
<html><!-- <table id="t"><tr><th>no</th></tr></table> --><script>var x = '<table id="t"></table>';</script>
<table data-id="t"><tr><td>decoy</td></tr></table><table id="tt"><tr><td>other</td></tr></table>
<TABLE class='x' id='t'><thead>
<tr><th></th><th>Unnamed: 1_level_0</th><th colspan=2>Playing Time</th></tr>
<tr><th>Rk</th><th>Squad</th><th>MP</th><th>Min</th></tr></thead>
<tbody><tr><th scope="row">1</th><td><a href="#">Tom &amp; Co</a></td><td> 3 </td><td></td></tr>
<tr class="thead"><th>Rk</th><th>Squad</th><th>MP</th><th>Min</th></tr>
<tr><th>2</th><td>B &lt;x&gt;</td><td>4</td><td>90</td></tr></tbody></TABLE></html>
"""


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None)], "page_id int, html string")


def test_html_rows_names_and_cells(pages):
    rows = html.html_tables(pages, ["page_id"], "t", prefix="Off")
    assert rows.count() == 3
    clean = html.drop_repeated_headers(rows).orderBy("row_no").collect()
    assert clean[0].names == ["Off_Rk", "Squad", "Off_Playing Time_MP", "Off_Playing Time_Min"]
    assert [r.cells for r in clean] == [["1", "Tom & Co", "3", None], ["2", "B <x>", "4", "90"]]
    picked = html.pick_columns(rows, ["page_id"], {"mp": "Off_Playing Time_MP", "none": "absent"}).first()
    assert picked.mp == "3" and picked.none is None


def test_html_single_header_row_and_missing_tables(pages):
    one = html.html_tables(pages, ["page_id"], "tt", header_rows=1).collect()
    assert one == []  # the only row is the header
    missing = {(r.page_id, r.table_id) for r in html.missing_tables(pages, ["page_id"], ["t", "zz"]).collect()}
    assert missing == {(1, "zz"), (2, "t"), (2, "zz"), (3, "t"), (3, "zz")}


def test_html_entities(spark):
    cells = {
        "&#65;&#x42;&#X63;": "ABc", "caf&#233; &#x1F600;": "café \U0001F600", "&amp;#65;": "&#65;", "&#38;lt;": "&lt;",
        "&lt;&gt;&quot;&apos;&#39;&nbsp;x": "<>\"'' x", "&#0;&#xD800;&#9999999;": "\ufffd\ufffd\ufffd", "&#;&#x;&#65": "&#;&#x;&#65",
    }
    body = "".join(f"<tr><td>{raw}</td></tr>" for raw in cells)
    page = spark.createDataFrame([(1, f"<table id=t><tr><th>c</th></tr>{body}</table>")], "page_id int, html string")
    rows = html.html_tables(page, ["page_id"], "t", header_rows=1).orderBy("row_no").collect()
    assert [r.cells[0] for r in rows] == list(cells.values())


def test_season_urls(spark):
    rows = html.season_urls(html.season_range(spark), template="u/{year}-{next_year}/x").collect()
    assert len(rows) == 8 and rows[0].url == "u/2017-2018/x"


def test_csv_files_keep_listed_order(spark, tmp_path):
    for name, values in (("b", range(50)), ("a", range(50, 90))):
        (tmp_path / f"{name}.csv").write_text("v,w\n" + "".join(f"{v},x\n" for v in values))
    read = files.read_in_order(spark, [f"{tmp_path}/b.csv", f"{tmp_path}/a.csv"], "v int, w string")
    assert [r.v for r in read.orderBy("ord").collect()] == list(range(90))
    assert files.read_table(spark, f"{tmp_path}/a.csv", "v int, w string").count() == 40


def test_find_file_wants_exactly_one(spark, tmp_path):
    deep = tmp_path / "x" / "y"
    deep.mkdir(parents=True)
    (deep / "True.csv").write_text('text\n"a ""quoted""\nline"\n')
    (deep / "NotTrue.csv").write_text("text\nb\n")
    assert files.find_file(spark, str(tmp_path), "True.csv", "text string").first().text == 'a "quoted"\nline'
    with pytest.raises(FileNotFoundError):
        files.find_file(spark, str(tmp_path), "Fake.csv", "text string")


def test_supplements_skip_missing_files_and_keep_bad_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text("k,v\na,1.5\nb,oops\n")
    loaded, skipped = files.read_supplements(
        spark, [(f"{tmp_path}/s.csv", "k string, v double"), (f"{tmp_path}/none.csv", "k string")]
    )
    assert {tuple(r) for r in loaded[0].collect()} == {("a", 1.5), ("b", None)}
    assert skipped == [(f"{tmp_path}/none.csv", "PATH_NOT_FOUND")]


def test_supplements_report_bad_rows(spark, tmp_path):
    (tmp_path / "s.csv").write_text("k,v\na,1.5\nb,oops\nc\nd,\n")
    (loaded,), _ = files.read_supplements(spark, [(f"{tmp_path}/s.csv", "k string, v double")], bad_row="line")
    got = {r.k: (r.v, r.line) for r in loaded.collect()}
    assert got == {"a": (1.5, None), "b": (None, "b,oops"), "c": (None, "c"), "d": (None, None)}
    assert {r.k for r in loaded.where("line is not null").select("k", "line").collect()} == {"b", "c"}


def test_season_and_prediction_files(spark, tmp_path):
    df = spark.createDataFrame([(2017, "a"), (2018, "b")], "season int, team string")
    files.write_seasons(df, f"{tmp_path}/s")
    assert {tuple(r) for r in spark.read.option("header", True).csv(f"{tmp_path}/s/season=2018").collect()} == {("b",)}
    files.write_predictions(df, f"{tmp_path}/p")
    files.write_predictions(df.limit(1), f"{tmp_path}/p")
    assert files.read_table(spark, f"{tmp_path}/p", "season int, team string").count() == 1
    summary = files.table_summary(df, ["season"]).where("season = 2017").first()
    assert (summary.n_rows, summary.n_columns, summary.column_names) == (1, 2, "season, team")


def test_degrees_and_pooling(spark):
    nodes = spark.createDataFrame([(1, 1, 2.0), (1, 2, 4.0), (1, 3, None), (2, 1, 7.0)], "graph_id int, node_id int, f double")
    edges = spark.createDataFrame([(1, 1, 2, "x")], "graph_id int, src int, dst int, attr string")
    got = {(r.graph_id, r.node_id): r.degree for r in graphs.degrees(nodes, edges).collect()}
    assert got == {(1, 1): 1, (1, 2): 1, (1, 3): 0, (2, 1): 0}
    assert {tuple(r) for r in graphs.undirected(edges).collect()} == {(1, 1, 2, "x"), (1, 2, 1, "x")}
    pooled = {r.graph_id: (r.f, r.n_nodes) for r in graphs.mean_pool(nodes, ["f"]).collect()}
    assert pooled == {1: (3.0, 3), 2: (7.0, 1)}
    assert graphs.degrees(nodes, edges.limit(0)).agg(F.sum("degree")).first()[0] == 0
    assert graphs.parsed_only(nodes, "f").count() == 3


def test_degrees_meet_their_nodes_in_blocks(spark):
    rows = [(g, n) for g in range(300) for n in range(8)] + [(0, 0), (None, 1), (1, None), (None, None)]
    nodes = spark.createDataFrame(rows, "graph_id int, node_id int")
    edges = spark.createDataFrame([(g, 1, 2 + g % 5) for g in range(300)] + [(None, 1, 1)], "graph_id int, src int, dst int")
    got = graphs.degrees(nodes, edges, block=256)
    parts = got.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(parts) == max(10, least) and max(r.n for r in parts) < 2 * 256  # adaptive execution would put them in one
    degree = {r["graph_id"] * 8 + r["node_id"]: r["degree"] for r in got.where("graph_id + node_id is not null").collect()}
    assert all(degree[g * 8 + n] == (n == 1) + (n == 2 + g % 5) for g in range(300) for n in range(8))
    assert got.where("graph_id is null or node_id is null").agg(F.count("*"), F.sum("degree")).first() == (3, 0)
    assert got.where("graph_id = 0 and node_id = 0").count() == 2


def test_noise_is_per_graph_repeatable_and_small(spark):
    nodes = spark.range(4000).select((F.col("id") / 4).cast("int").alias("graph_id"), (F.col("id") % 4).alias("node_id"), F.lit(1.0).alias("f"))
    noisy = graphs.graph_noise(nodes, ["f"])
    per_graph = noisy.groupBy("graph_id").agg(F.countDistinct("noisy").alias("n"), F.first("noisy").alias("c"))
    assert per_graph.where("n > 1").count() == 0
    assert 400 < per_graph.where("c").count() < 600
    stats = noisy.where("noisy").agg(F.avg("f"), F.stddev("f")).first()
    assert stats[0] == pytest.approx(1.0, abs=0.001) and stats[1] == pytest.approx(0.01, rel=0.1)
    assert noisy.where("not noisy and f <> 1.0").count() == 0
    assert noisy.exceptAll(graphs.graph_noise(nodes.repartition(7), ["f"])).count() == 0
    held = F.when(F.col("graph_id") % 4 != 1, F.col("graph_id") % 4 != 0)  # null for some, which counts as held out
    part = graphs.graph_noise(nodes, ["f"], training=held)
    assert part.where("graph_id % 4 < 2 and (noisy or f <> 1.0)").count() == 0
    assert part.where("graph_id % 4 > 1").exceptAll(noisy.where("graph_id % 4 > 1")).count() == 0


FRAMES = [
    (1, [(-1.9, 2.9, 10.5, 20.0), (0.0, 0.0, 4.0, 3.0)], [0.87, 0.5], [0, 1], None),
    (2, [(0.0, 0.0, 4.9, 3.9), (1.0, 1.0, 2.0, 2.0)], [0.505, 0.9], [9, 1], [[(0.0, 0.0), (4.9, 0.0), (4.0, 3.9), (0.0, 3.0)]]),
    (3, [], [], [], None),
]


def test_detections_shape(spark):
    frames = spark.createDataFrame(FRAMES, det.FRAME_SCHEMA)
    rows = {(r.frame_id, r.det_no): r for r in det.shape_detections(frames, {0: "apple", 1: "bread"}).collect()}
    assert set(rows) == {(1, 0), (2, 0), (2, 1)}  # 0.5 is not above the threshold
    first = rows[1, 0]
    assert (first.x1, first.y1, first.x2, first.y2) == (-1, 2, 10, 20)
    assert first.label == "apple: 0.87" and first.polygon is None
    assert rows[2, 0].class_name is None and rows[2, 0].label is None
    assert [(p.x, p.y) for p in rows[2, 0].polygon] == [(0, 0), (4, 0), (4, 3), (0, 3)]
    assert rows[2, 1].polygon is None
    areas = {r.class_id: (r.n_detections, r.area) for r in det.class_areas(det.shape_detections(frames, {})).collect()}
    assert areas == {0: (1, None), 1: (1, None), 9: (1, 12.0)}


def test_label_rounds_like_the_exact_value(spark):
    values = [0.125, 0.135, 0.375, 0.995, 1.0, 0.615]
    df = spark.createDataFrame([(v,) for v in values], "c double")
    assert [r[0] for r in df.select(det.label_text(F.lit("x"), F.col("c"))).collect()] == [f"x: {v:.2f}" for v in values]


def test_stream_equals_table_with_a_class_table(spark):
    frames = spark.createDataFrame(FRAMES, det.FRAME_SCHEMA)
    classes = spark.createDataFrame([(0, "apple"), (1, "bread")], "class_id int, class_name string")
    arriving = scratch_path(spark, "frames")
    frames.repartition(3).write.parquet(arriving)
    got = shape_stream(
        spark, arriving, classes, scratch_path(spark, "out"), scratch_path(spark, "offsets"), files_per_batch=1
    )
    want = det.shape_detections(frames, classes)
    assert {str(r) for r in got.collect()} == {str(r) for r in want.collect()}


def grid(spark, body, table_id="t", header_rows=1):
    page = f"<p>x</p><table id='other'><tr><td>no</td></tr></table>{body}<table><tr><td>after</td></tr></table>"
    frame = spark.createDataFrame([(1, page)], "page_id int, html string")
    rows = html.html_tables(frame, ["page_id"], table_id, header_rows=header_rows).orderBy("row_no").collect()
    return [r.cells for r in rows], (rows[0].names if rows else None)


def test_spans_and_nested_tables_fill_the_grid(spark):
    body = """<table id="t"><tr><th>Squad</th><th>MP</th><th>GA</th></tr>
      <tr><td rowspan="2">X &eacute;</td><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr>
      <tr><td>N<TABLE><tr><td>i</td></tr></TABLE ></td><td>5</td><td>6</td></tr></table>"""
    cells, names = grid(spark, body)
    assert names == ["Squad", "MP", "GA"]
    assert cells == [["X é", "1", "2"], ["X é", "3", "4"], ["N i", "5", "6"]]


def test_spans_in_both_directions(spark):
    body = """<table id=t><tr><th colspan=2>A</th><th rowspan=2>B</th></tr><tr><th>a1</th><th>a2</th></tr>
      <tr><td rowspan=3 colspan=2>w</td><td>1</td></tr><tr><td>2</td></tr><tr><td rowspan=9>3</td></tr>
      <tr><td>p</td><td>q</td></tr><tr><td>r</td></tr></table>"""
    cells, names = grid(spark, body, header_rows=2)
    assert names == ["A_a1", "A_a2", "B_B"]
    assert cells == [["w", "w", "1"], ["w", "w", "2"], ["w", "w", "3"], ["p", "q", "3"], ["r", None, "3"]]


def test_grid_equals_a_plain_fold(spark):
    rnd = random.Random(3)
    for _ in range(5):
        rows, held, plain = [], {}, []
        for r in range(6):
            cells = [(f"c{r}{i}", rnd.randint(1, 3), rnd.randint(1, 2)) for i in range(rnd.randint(1, 3))]
            rows.append("<tr>" + "".join(f"<td rowspan={d} colspan={w}>{t}</td>" for t, d, w in cells) + "</tr>")
            flat, line, k = [(t, d) for t, d, w in cells for _ in range(w)], [], 0
            while flat or any(c >= k for c, (_, left) in held.items() if left):
                if held.get(k, ("", 0))[1]:
                    text, left = held[k]
                    held[k] = (text, left - 1)
                elif flat:
                    text, d = flat.pop(0)
                    held[k] = (text, d - 1)
                else:
                    text = None
                line.append(text)
                k += 1
            plain.append(line)
        cells, _ = grid(spark, "<table id='t'><tr><th>h</th></tr>" + "".join(rows) + "</table>")
        assert cells == plain


def test_a_table_inside_another_is_found_by_its_own_id(spark):
    body = "<table id='o'><tr><td>a<table id='t'><tr><th>h</th></tr><tr><td>1</td></tr></table></td></tr><tr><td>b</td></tr></table>"
    assert grid(spark, body)[0] == [["1"]]
    assert grid(spark, body, "o")[0] == [["b"]]
    assert grid(spark, "<table id='t'><tr><td>never closed</td></tr>")[0] == []


def test_named_entities(spark):
    body = "<table id='t'><tr><th>h</th></tr><tr><td>&Auml;&ouml; &amp;eacute; &nosuch; &lt;b&gt; &euro;&nbsp;5 &apos;</td></tr></table>"
    assert grid(spark, body)[0] == [["Äö &eacute; &nosuch; <b> € 5 '"]]


@pytest.mark.parametrize("partitions", [8, 64])
def test_season_files_have_a_stated_size_and_other_seasons_stay(spark, tmp_path, partitions):
    path = f"{tmp_path}/seasons"
    rows = [(2000 + (i % 10 > 6), i, f"t{i}") for i in range(500)] + [(None, 900 + i, "x") for i in range(3)]
    df = spark.createDataFrame(rows, "season int, no int, team string").repartition(partitions)
    files.write_seasons(df, path, order="no", rows_per_file=100)
    listed = lambda season: sorted(Path(f"{path}/season={season}").glob("part-*.csv"))
    assert [len(listed(s)) for s in (2000, 2001, "__HIVE_DEFAULT_PARTITION__")] == [4, 2, 1]
    lines = [f.read_text().split("\n")[1:-1] for f in listed(2000)]
    assert [len(x) for x in lines] == [100, 100, 100, 50]
    numbers = [int(line.split(",")[0]) for part in lines for line in part]
    assert numbers == sorted(numbers)
    before = {f: f.read_text() for f in listed(2000)}
    files.write_seasons(spark.createDataFrame([(2001, 1, "new")], df.schema), path, order="no")
    assert {f: f.read_text() for f in listed(2000)} == before and len(listed(2001)) == 1
    files.write_seasons(df.where("season = 2000"), f"{tmp_path}/one")
    assert len(list(Path(f"{tmp_path}/one/season=2000").glob("part-*.csv"))) == 1
    files.write_seasons(df.limit(0), f"{tmp_path}/none")
