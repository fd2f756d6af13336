"""Vectors, components, archives and the pipeline."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from formline.llm import langid, line_frequency, mixing, packing, projections, simhash, warc
from formline.llm.components import connected
from formline.session import scratch_path

SMALL = "/root/testdata/sf0.001"


def test_components_of_long_and_wide_graphs(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(2000, 2001), (2001, 2000), (5, 5)]
    rows = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {rows[i] for i in range(301)} == {0} and {rows[1000 + i] for i in range(200)} == {1000}
    assert rows[2000] == rows[2001] == 2000
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def planted(seed=0, groups=60, size=16):
    """Groups of vectors around a centre, some near the threshold, with copies and odd rows."""
    random = np.random.default_rng(seed)
    rows, at = [], itertools.count()
    for g in range(groups):
        centre = random.normal(size=size)
        for _ in range(5):
            v = centre + random.normal(size=size) * random.choice([0.0, 0.03, 0.1, 0.14])
            rows.append((next(at), [float(np.float32(x)) for x in v * random.choice([1.0, 2.5])], g % 3))
    odd = [None, [], [0.0] * size, [float("nan")] * size, [float("inf")] * size, [None] * size, [1.0] * (size - 1)]
    rows += [(next(at), v, 1) for v in odd] + [(next(at), [1.0] * size, None)] * 2
    return rows


def brute(rows):
    usable = [
        (i, np.array(v, float), label)
        for i, v, label in rows
        if v and label is not None and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    links, label = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}
    for (i, v, k), (j, w, m) in itertools.combinations(usable, 2):
        if k == m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
            links[i] += 1
            links[j] += 1
            low, high = sorted((label[i], label[j]))
            label = {a: low if b == high else b for a, b in label.items()}
    return links, label


@pytest.mark.parametrize("block", [projections.BLOCK, 20])
def test_vectors_equal_brute_force(spark, block):
    rows = planted()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("a", F.lit(1))
    found = projections.near_vectors(frame, block=block).collect()
    links, label = brute(rows)
    assert len(found) == len(rows)
    assert {r.vec_id: r.n_links for r in found} == links and {r.vec_id: r.component_id for r in found} == label
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert projections.near_vectors(frame.limit(0)).count() == 0


def test_needed_collisions_keep_the_recall():
    needed, random = projections.needed_collisions(), np.random.default_rng(1)
    gaps = np.abs(random.normal(size=(20_000, projections.DIRECTIONS)) * np.sqrt(2 - 2 * projections.THRESHOLD))
    assert needed > 1 and ((gaps <= projections.WINDOW).sum(1) >= needed).mean() > 0.998


def test_cells_miss_hardly_any_link():
    random = np.random.default_rng(2)
    for entries in (2_000, 20_000, 10**7):
        width, tables = projections.cell_plan(entries)
        own = projections.unit_rows(random.normal(size=(4_000, 32)))
        away = random.normal(size=own.shape)
        away = projections.unit_rows(away - (away * own).sum(1, keepdims=True) * own)
        other = 0.98 * own + np.sqrt(1 - 0.98**2) * away
        first, second = projections.cells(own, width, tables), projections.cells(other, width, tables)
        assert (first == second).any(1).mean() > 0.999
        # Unrelated vectors share cells far less often than all of them would.
        assert (first == first[random.permutation(len(first))]).mean() < 2 * projections.SHARED**width + 0.002
    assert projections.cell_plan(100) == projections.cell_plan(0) == (0, 1) and projections.cell_plan(10**6, -0.5) == (0, 1)
    plans = [projections.cell_plan(10**e) for e in (4, 6, 8)]
    assert plans[2][0] <= plans[0][0] + 11 and plans[2][1] < 10 * plans[0][1]


@pytest.fixture(scope="module")
def pages(spark):
    body = "<p>" + "same " * 40 + "</p>"
    rows = [
        (1, "http://a.example.com/x?q=1", body), (2, "http://b.example.com/", body), (3, None, None), (4, "http://[bad", "é\r\n\r\nü"),
        (5, "http://a.example.com/x?q=1", "short"), (6, "https://c.org:8080", "short"), (7, "", ""), (None, "http://a.example.com/", body + "!"),
    ]
    rows += [(100 + i, "http://hot.example.net/one", f"{body}{i % 3}") for i in range(40)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, key string, size int").repartition(3)


def test_archives_round_trip(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    rows = warc.round_trip(spark, pages).collect()
    out = {r.page_id: r for r in rows}
    assert len(rows) == 48 and out[1].record_type == "response" and (out[2].record_type, out[2].refers_to) == ("revisit", 1)
    assert out[2].payload_bytes == out[1].payload_bytes == 207 and out[2].payload_digest == out[1].payload_digest
    assert out[5].record_type == out[6].record_type == "response" and out[3].payload_bytes == out[7].payload_bytes == 0
    assert out[4].payload_bytes == 8 and sum(r.record_type == "revisit" for r in rows) == 1 + 37
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_archives_of_repeated_ids_and_payloads(spark):
    body, other = "<p>" + "same " * 40, "<p>" + "else " * 40
    rows = [(3, "u", body)] * 3 + [(2, "u", body), (2, "v", other), (3, "u", other), (None, "u", body), (None, "w", None), (4, None, "tiny")] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("_page", F.lit(1))
    found = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(spark, frame).collect())
    want = [("3", 203, "revisit", 2)] * 5 + [("3", 203, "revisit", 2)] * 2 + [("2", 203, "response", None)] * 4
    want = want[2:] + [("None", 203, "response", None)] * 2 + [("None", 0, "response", None)] * 2 + [("4", 4, "response", None)] * 2
    assert found == sorted(want)


def test_vectors_of_extreme_size_keep_their_links(spark):
    rows = [(0, [3e38, 2.9e38, 1e38], 1), (1, [3e-38, 2.9e-38, 1e-38], 1), (2, [3.0, 2.9, 1.0], 1), (3, [0.0, 1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    wide = [(4, [c * 1e200 / 3e38 for c in rows[0][1]], 1), (5, [c * 1e-200 / 3e-38 for c in rows[1][1]], 1)]
    frame = frame.unionAll(spark.createDataFrame(wide, frame.schema))
    found = {r.vec_id: (r.n_links, r.component_id) for r in projections.near_vectors(frame).collect()}
    assert all(found[i] == (4, 0) for i in (0, 1, 2, 4, 5)) and found[3] == (0, 3)


def test_lookup_by_url_finds_every_capture(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    root = scratch_path(spark, "warc-test")
    captures = warc.write_archives(pages, f"{root}/archive")
    top = warc.build_index(captures, f"{root}/index")
    asked = [("http://hot.example.net/one",), ("http://a.example.com/x?q=1",), ("http://none.example",), (None,)]
    found = warc.lookup(spark.createDataFrame(asked, "url string"), top, f"{root}/index")
    ids = sorted(r.page_id for r in found.collect())
    assert ids == [1, 3, 5, 7, *range(100, 140)]
    records = warc.read_records(found, f"{root}/archive").collect()
    assert {r.page_id: r.payload for r in records}[5] == b"short"


def test_url_keys():
    assert warc.url_key("http://M.ththth.example.net/en/25?a=b#top") == "net,example,ththth,m)/en/25?a=b"
    assert warc.url_key("https://c.org:8080") == "org,c:8080)/" and warc.url_key(None) == ""


def test_pipeline_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("score", F.lit(1))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SMALL)
        assert now.columns == docs.columns and now.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, now, SMALL).count() >= now.count()


def test_pipeline_equals_its_operators(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    good = {r.doc_id for r in line_frequency.line_quality(docs).where("kept").collect()}
    step = docs.where(F.col("doc_id").isin(sorted(good)))
    known = {r.doc_id for r in langid.predict(step, langid.fit(step)).where("not rejected").collect()}
    step = step.where(F.col("doc_id").isin(sorted(known)))
    first = {r.component_id for r in simhash.simhash_groups(step).collect()}
    step = step.where(F.col("doc_id").isin(sorted(first)))
    copies = sorted((r.doc_id, r.copy) for r in mixing.mix_sources(step).select("doc_id", "copy").collect())
    rows = corpus_pipeline.run(spark, SMALL).toPandas()
    assert sorted(rows[rows.piece == 0].doc_id) == [i for i, _ in copies]
    whole = packing.token_pieces(step).groupBy("_id").agg(F.sum("length").alias("n")).toPandas().set_index("_id").n
    assert rows.length.sum() == sum(whole[i] for i, _ in copies)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
