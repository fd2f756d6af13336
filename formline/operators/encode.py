"""Label indexes, target vectors and token sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from formline.operators.sequence import assign_sequence
from formline.operators.shaping import distinct_values

# Special tokens of an encoded text, in id order.
PAD, UNKNOWN, START, END = 0, 1, 2, 3
FIRST_TOKEN_ID = 4
# Fixed value: sequence length of the text model.
MAX_LENGTH = 512
HEAD = 1 << 17  # words of a vocabulary that travel with the tasks


def label_index(df: DataFrame, columns: Sequence[str], name: str = "label") -> DataFrame:
    """One index, from 0 in sorted order, over the values of several columns: ``name, idx``."""
    return assign_sequence(distinct_values(df, columns, name), [name], "idx", start=0)


def apply_label_index(df: DataFrame, index: DataFrame, columns: Sequence[str], name: str = "label") -> DataFrame:
    """Add ``<column>_enc`` for every column; a value missing from the index gives null."""
    for c in columns:
        keyed = index.select(F.col(name).alias("_label"), F.col("idx").alias(f"{c}_enc"))
        df = df.join(keyed, F.col(c) == F.col("_label"), "left").drop("_label")
    return df


def target_vector(columns: Sequence[str]) -> Column:
    """Targets as a nullable array in a fixed order."""
    return F.array(*[F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns])


def text_or_nan(column: str) -> Column:
    """Text as a string; a missing one becomes the word ``nan``."""
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, over the whole text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def pad(ids: Column, length: int = MAX_LENGTH, filler: int = PAD) -> Column:
    """Cut or fill a sequence to ``length``."""
    cut = F.slice(ids, 1, length)
    return F.concat(cut, F.array_repeat(F.lit(filler), F.lit(length) - F.size(cut)))


def pad_mask(ids: Column, length: int = MAX_LENGTH) -> Column:
    """1 for each real position of the padded sequence, 0 for filling."""
    used = F.least(F.size(ids), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(length) - used))


def vocabulary(docs: DataFrame, text: str = "text", size: int | None = None) -> DataFrame:
    """All words of all texts, or the most frequent that fit ``size`` ids: ``token, token_id``.

    Counting is map-side combined, and the words are numbered in sorted partitions, most frequent first.
    """
    counted = (
        docs.select(F.explode(words(text_or_nan(text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = assign_sequence(counted.withColumn("_fewer", -F.col("n")), ["_fewer", "token"], "_id", FIRST_TOKEN_ID)
    chosen = ranked.where(F.col("_id") < size) if size else ranked
    return chosen.select("token", F.col("_id").cast("int").alias("token_id"))


def encode_texts(
    docs: DataFrame, vocab: DataFrame, key: str, text: str = "text", length: int = MAX_LENGTH
) -> DataFrame:
    """Fixed-length token ids with start and end marks, and their mask, per unique ``key``.

    The words are spread by ``key`` once, as one text. The ``HEAD`` words with the lowest ids, which are the most
    frequent ones of ``vocabulary``, travel with the tasks; only occurrences of other words are shuffled to meet the
    rest of the vocabulary. How they meet it is left to Spark, which splits very frequent words.
    """
    first = F.slice(words(text_or_nan(text)), 1, length - 2)
    # As a struct a missing key equals itself, in groups and in joins.
    spread = docs.select(F.struct(key).alias("_key"), F.array_join(first, " ").alias("_words")).repartition("_key")
    listed = F.when(F.col("_words") != "", F.split("_words", " "))
    placed = spread.select("_key", F.posexplode_outer(listed).alias("_pos", "token"))
    in_head = F.col("token_id") < FIRST_TOKEN_ID + HEAD
    head, rest = F.broadcast(vocab.where(in_head)), vocab.where(~in_head)
    place = lambda i: F.when(i.isNotNull(), F.struct("_pos", i.alias("id")))
    frequent = placed.join(head, "token", "left").groupBy("_key").agg(F.collect_list(place(F.col("token_id"))).alias("_ids"))
    others = placed.where(F.col("token").isNotNull()).join(head, "token", "left_anti").join(rest, "token", "left")
    rare = others.groupBy("_key").agg(F.collect_list(place(F.coalesce("token_id", F.lit(UNKNOWN)))).alias("_rare"))
    found = frequent.join(rare, "_key", "left").select(
        F.col("_key")[key].alias(key),
        F.array_sort(F.when(F.col("_rare").isNull(), F.col("_ids")).otherwise(F.concat("_ids", "_rare"))).alias("_ids"),
    )
    ids = F.concat(F.array(F.lit(START)), F.transform("_ids", lambda x: x["id"]), F.array(F.lit(END)))
    return found.select(
        key,
        F.size(ids).alias("n_ids"),
        pad(ids, length).alias("input_ids"),
        pad_mask(ids, length).alias("attention_mask"),
    )
