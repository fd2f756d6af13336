"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from formline.llm import collocations, crf, hmm, langid, license_scan, line_frequency, mixing, packing, projections, simhash, suffix_sort, warc, whitening
from formline.llm.common import fold, read_table


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    field = crf.fit(docs, labels.where(fold("doc_id", 5) != 0))
    scored = crf.score_documents(docs, field)
    return scored.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
        "n_lines",
        "n_good_lines",
    )


def op2_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.packed_pieces(read_table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_simhash_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"))


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = line_frequency.line_quality(read_table(spark, sf_dir, "documents"))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_left"
    )


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents"))
    return mixed.withColumn("rate", F.round("rate", 9))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = spark.createDataFrame(list(license_scan.NOTICES.items()), "template_id string, text string")
    return license_scan.scan(read_table(spark, sf_dir, "documents"), templates).drop("n_windows")


def op7_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = hmm.score_texts(docs, docs.where(fold("doc_id", 7) != 2))
    return scored.select(
        "doc_id", (fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_projection_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op9_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(fold("doc_id", 4) != 2))
    return langid.predict(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op10_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read_table(spark, sf_dir, "pages"))


def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_sort.remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_crf, op2_sum_of_squares, op3_simhash_mih, op4_line_frequency, op5_poisson_mix, op6_license_scan,
        op7_hidden_markov, op8_projection_collisions, op9_nearest_centroid, op10_capture_index,
        op11_bit_sliced_whitening, op12_suffix_sort, op13_collocations, pipeline,
    )
}
