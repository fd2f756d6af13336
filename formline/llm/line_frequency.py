"""Quality rules: per-text repetition and symbol rules, and lines that too many documents of a host share.

Everything runs as DataFrame expressions. Lines are normalised and hashed; for every host (``source``) the
*different texts* that hold a line are counted, so exact copies of one document count once. A line held by
more than ``max_documents`` texts of its host is taken out of all documents of that host but the one with
the smallest id, and a document that keeps less than ``min_left`` of its words is rejected. ``line_quality``
measures and judges; ``keep_good`` returns the kept documents without the lines taken out.

Defined results: a null text has no words, so it fails the base rules; null hosts form one host; documents
with equal id and text get one verdict (returned once); a line in exactly ``max_documents`` texts stays, a document
with exactly ``min_left`` of its words too; very long texts are rows like others; an empty table gives an empty
result. Columns other than id, text and host, of any name, are ignored by ``line_quality`` and kept as they are by
``keep_good`` (a stored length is that of the text before).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from formline.llm.common import let, whole_row
from formline.session import store

MAX_DOCUMENTS = 20
MIN_LEFT = 0.3
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BREAK), "")


def normal_line(line: Column) -> Column:
    """Lower case, digits as 0, white space squeezed and trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), BREAK, " "))


def _covered(windows: Column) -> Column:
    """Words inside a window that occurs twice or more: sort windows, keep those with an equal neighbour."""

    def marked(pairs: Column) -> Column:
        value = lambda j: F.get(pairs, j)["h"]
        twin = F.filter(
            F.transform(pairs, lambda x, j: F.when((value(j - 1) == x["h"]) | (value(j + 1) == x["h"]), x["i"])),
            lambda i: i.isNotNull(),
        )
        return let(F.sort_array(twin), spread)

    def spread(places: Column) -> Column:
        gap = lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - x, F.lit(WINDOW)))
        return F.aggregate(F.transform(places, gap), F.lit(0), lambda a, x: a + x)

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return let(F.sort_array(pairs), marked)


def base_measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``_id, _host, _text, _lines`` (lines with a word) and the base measures."""
    at = lambda i, k: F.get(F.col("_words"), i + k)
    size = F.size("_words")
    windows = F.when(
        size >= WINDOW,
        F.transform(F.sequence(F.lit(0), size - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    solid = F.array_join("_words", "")
    plain = F.col("_solid")
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return (
        docs.select(
            F.col(doc_id).alias("_id"), F.col(host).alias("_host"), F.coalesce(F.col(text), F.lit("")).alias("_text")
        )
        .withColumns(
            {
                "_words": words(F.col("_text")),
                "_lines": F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)),
            }
        )
        .withColumns({"_windows": windows, "_solid": solid})
        .select(
            "_id",
            "_host",
            "_text",
            "_lines",
            size.cast("long").alias("n_words"),
            F.length("_solid").cast("long").alias("word_chars"),
            (F.length("_solid") - F.length(plain)).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.when(repeated, _covered(F.col("_windows"))).otherwise(0).cast("long").alias("n_repeat_words"),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
        )
    )


def line_hash(line: Column) -> Column:
    return F.xxhash64(normal_line(line))


def _judged(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """One row per different (id, text, host): ``_id, _host, _key``, the measures, ``kept``, ``_gone_lines`` (hashes).

    Only hashes and counts are shuffled, never texts. Counts are combined before each shuffle. The frequent lines, one
    row per host and line, are stored first: their size is then known, and where they are few, only the lines that
    are frequent are shuffled a second time; otherwise adaptive execution can split the rows of a very common line.
    """
    measured = base_measures(docs, doc_id, text, host).withColumn("_key", F.xxhash64("_text"))
    lines = F.transform(
        "_lines", lambda x: F.struct(line_hash(x).alias("line"), F.size(words(x)).alias("n"))
    )
    held = measured.select("_id", "_host", "_key", F.explode(lines).alias("_line")).select(
        "_id", "_host", "_key", F.col("_line.line").alias("_line"), F.col("_line.n").alias("_n")
    )
    frequent = store(
        held.groupBy("_host", "_line", "_key")
        .agg(F.min("_id").alias("_id"))
        .groupBy("_host", "_line")
        .agg(F.count(F.lit(1)).alias("_texts"), F.min("_id").alias("_first"))
        .where(F.col("_texts") > max_documents)
        .select(F.col("_host").alias("_fhost"), F.col("_line").alias("_fline"), "_first"),
        "frequent-lines",
    )
    removed = (
        held.join(frequent, F.col("_host").eqNullSafe(F.col("_fhost")) & (F.col("_line") == F.col("_fline")))
        .where(~F.col("_id").eqNullSafe(F.col("_first")))
        .groupBy("_id", "_host", "_key", "_line")
        .agg(F.max("_n").alias("_n"), F.count(F.lit(1)).alias("_times"))
        .groupBy("_id", "_host", "_key")
        .agg(F.sum(F.col("_n") * F.col("_times")).alias("_gone"), F.collect_list("_line").alias("_gone_lines"))
        .withColumnsRenamed({"_id": "_rid", "_host": "_rhost", "_key": "_rkey"})
    )
    # Equal rows have equal lines, so the words gone from all of them are a multiple of their number.
    kinds = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    own = measured.groupBy("_id", "_host", "_key").agg(
        *[F.first(kind).alias(kind) for kind in kinds], F.count(F.lit(1)).alias("_rows")
    )
    left = F.col("n_words") - F.coalesce(F.col("_gone") / F.col("_rows"), F.lit(0))
    return (
        own.join(
            removed,
            F.col("_id").eqNullSafe(F.col("_rid"))
            & F.col("_host").eqNullSafe(F.col("_rhost"))
            & (F.col("_key") == F.col("_rkey")),
            "left",
        )
        .withColumn("n_left", left.cast("long"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_left") >= min_left * F.col("n_words")))
    )


def line_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """One row per different (id, text, host): the base measures, ``n_left`` words after the removal, ``kept``."""
    return _judged(docs, doc_id, text, host, **limits).select(
        F.col("_id").alias(doc_id),
        F.col("_host").alias(host),
        F.col("_key").alias("text_hash"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_left",
        "base_failed",
        "kept",
    )


def without_lines(text: Column, gone: Column) -> Column:
    """The text without the lines whose hash is in ``gone``; the other lines stay byte for byte."""
    left = F.filter(F.split(text, "\n"), lambda line: ~F.array_contains(gone, line_hash(line)))
    return F.when(gone.isNull(), text).otherwise(F.array_join(left, "\n"))


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` whose document is kept, without their frequent lines; repeated rows stay."""
    verdicts = _judged(docs, doc_id, text, host, **limits).where("kept").select("_id", "_host", "_key", "_gone_lines")
    whole = docs.select(
        whole_row(docs).alias("_row"),
        F.col(doc_id).alias("_row_id"),
        F.col(host).alias("_row_host"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_row_key"),
    )
    kept = whole.join(
        verdicts,
        F.col("_row_id").eqNullSafe(F.col("_id"))
        & F.col("_row_host").eqNullSafe(F.col("_host"))
        & (F.col("_row_key") == F.col("_key")),
    )
    own = F.col("_row")
    left = without_lines(own[text], F.col("_gone_lines"))
    return kept.select(*[(left if c == text else own[c]).alias(c) for c in docs.columns])
