"""Language ID by the nearest of several centroids per language.

A text becomes a vector of hashed character n-gram counts (1 to 3 characters, lower case, letters only with
one break between words), dampened, weighted by inverse document frequency and scaled to length one. Document
frequencies are counted over all training texts. Centroids come from spherical k-means inside each language,
fitted on about ``sample`` texts per language (those with the smallest hashes), so one language's fit is
bounded whatever its share. A text belongs to the language of the centroid with the highest cosine.

Rejection goes by distance (one less the cosine), which falls with a text's length. A fifth of the sample is kept
out of the centroids; these texts and pieces of them of each of ``SIZES`` letters are measured against the
centroids of their own language. The limit of a size is the distance at which the cosine is ``SHARE`` of that at the
``QUANTILE`` of the measured distances, all languages together, and no less than the limit of a larger size. A text
has the limit of the largest size it reaches; one under the smallest size is not rejected for its distance. With
fewer than ``CALIBRATION`` distances a size's limit is ``RADIUS``.

Defined results: a text that is null or has no letter (of any plane of Unicode) is ``und`` with score 0 and
rejected; ties go to the language first in order; repeated rows are scored alike and are one text of the sample;
texts of any length are read whole; without any training text every text is ``und``; an empty table gives an empty
result; other columns are ignored by ``predict`` and kept, under any name, by ``keep_known``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from formline.llm.common import slices, whole_row
from formline.session import store

DIMENSIONS = 4096
ORDERS = (1, 2, 3)
CENTROIDS = 4
SAMPLE = 1000
ROUNDS = 8
SIZES = (32, 64, 128, 256, 512, 1024, 2048, 4096)
QUANTILE = 0.99
SHARE = 0.7
CALIBRATION = 50
RADIUS = 0.85
LANGUAGES = 10_000
UNKNOWN = "und"


def _letter(code: int) -> int:
    """The lower-case code point of a letter, 0 for all else."""
    char = chr(code)
    if not char.isalpha():
        return 0
    low = char.lower()
    return ord(low) if len(low) == 1 else code


def _letters() -> np.ndarray:
    """``_letter`` of the first plane."""
    return np.array([_letter(code) for code in range(0x10000)], np.uint32)


class Grams:
    """Hashed n-gram counts of texts."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters = _letters()

    def codes(self, text: str) -> np.ndarray:
        """Lower-case letters with a 0 where anything else stands, runs of 0 as one; empty without letters."""
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        codes = self.letters[np.minimum(points, 0xFFFF)]
        far = np.flatnonzero(points >= 0x10000)
        if len(far):
            distinct, own = np.unique(points[far], return_inverse=True)
            codes[far] = np.array([_letter(int(p)) for p in distinct], np.uint32)[own]
        padded = np.concatenate(([0], codes, [0])).astype(np.uint64)
        keep = (padded != 0) | np.concatenate(([True], padded[:-1] != 0))
        padded = padded[keep]
        return padded if len(padded) > 2 or padded.any() else padded[:0]

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The dimensions present and how often."""
        return self.counts_of(self.codes(text or ""))

    def counts_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(codes):
            return np.zeros(0, np.int64), np.zeros(0)
        found = []
        with np.errstate(over="ignore"):
            mixed = codes * np.uint64(0x9E3779B97F4A7C15)
            rolled = np.zeros(len(codes), np.uint64)
            for n in range(1, max(ORDERS) + 1):
                length = len(codes) - n + 1
                if length <= 0:
                    break
                rolled = (rolled[:length] * np.uint64(0xD6E8FEB86659FD93)) ^ mixed[n - 1 :][:length]
                if n in ORDERS:
                    spread = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    found.append(spread >> np.uint64(64 - self.dimensions.bit_length() + 1))
        counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=self.dimensions)
        at = np.flatnonzero(counts)
        return at, counts[at].astype(float)


def document_frequencies(texts: DataFrame, text: str, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, int]:
    """Texts that hold each dimension, and texts with a letter. Summed per task, then ``dimensions`` + 1 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held = Grams(dimensions), np.zeros(dimensions + 1, np.int64)
        for batch in slices(batches, "_text"):
            for body in batch.column(0).to_pylist():
                at, _ = grams.counts(body)
                held[at] += 1
                held[dimensions] += len(at) > 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimensions + 1)), pa.array(held)], ["_at", "_n"])

    sums = texts.select(F.col(text).alias("_text")).mapInArrow(run, "_at bigint, _n bigint").groupBy("_at").agg(F.sum("_n").alias("_n"))
    held = np.zeros(dimensions + 1, np.int64)
    for row in sums.collect():  # dimensions + 1 rows, whatever the input
        held[row["_at"]] = row["_n"]
    return held[:dimensions], int(held[dimensions])


@dataclass
class Model:
    """``centroids`` has a row per centroid, ``languages`` the language of each, ``limits`` the distance limit of each size."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    limits: tuple[float, ...] = (RADIUS,) * len(SIZES)

    def too_far(self, letters: int, distance: float) -> bool:
        size = int(np.searchsorted(SIZES, letters, "right")) - 1
        return size >= 0 and distance > self.limits[size]


def _scaled(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.zeros(len(idf), np.float32)
    out[at] = np.log1p(counts) * idf[at]
    norm = float(np.linalg.norm(out))
    return out / norm if norm else out


def spherical_means(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k centroids of unit vectors; starts are chosen far apart, so equal input gives equal centroids."""
    chosen = [int((vectors @ vectors.mean(0)).argmax())]
    nearest = vectors @ vectors[chosen[0]]
    for _ in range(min(k, len(vectors)) - 1):
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-6:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, vectors @ vectors[far])
    means = vectors[chosen].copy()
    for _ in range(rounds):
        own = (vectors @ means.T).argmax(1)
        for j in range(len(means)):
            if (own == j).any():
                total = vectors[own == j].sum(0)
                means[j] = total / np.linalg.norm(total)
    return means


def fit(
    training: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    dimensions: int = DIMENSIONS,
    centroids: int = CENTROIDS,
    sample: int = SAMPLE,
) -> Model:
    """A model from the rows with a language; a row without a letter teaches nothing."""
    rows = training.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    held, total = document_frequencies(rows, text, dimensions)
    idf = np.log((1 + total) / (1 + held)) + 1
    picked = _sampled(rows, key, text, lang, sample)

    def centres(group: tuple, part: pd.DataFrame) -> pd.DataFrame:
        grams = Grams(dimensions)
        texts = [codes for codes in map(grams.codes, sorted(part["_text"])) if len(codes)]
        apart = [t for i, t in enumerate(texts) if i % 5 == 4]
        vectors = [_scaled(*grams.counts_of(t), idf) for i, t in enumerate(texts) if i % 5 < 4]
        vectors = np.array(vectors, np.float32).reshape(-1, dimensions)
        means = spherical_means(vectors, centroids) if len(vectors) else vectors
        rows = [(True, 0, m.tolist()) for m in means]
        for k, size in enumerate(SIZES):
            pieces = [t[at : at + size] for t in apart for at in {0, (len(t) - size) // 2} if len(t) >= size]
            pieces += [t for t in apart if size <= len(t) < 2 * size]
            far = [float(1 - (means @ _scaled(*grams.counts_of(p), idf)).max()) for p in pieces]
            rows.append((False, k, far))
        return pd.DataFrame(rows, columns=["_mean", "_size", "_values"]).assign(_lang=group[0])

    schema = "_mean boolean, _size int, _values array<float>, _lang string"
    fitted = picked.groupBy("_lang").applyInPandas(centres, schema).collect()
    found = sorted((row["_lang"], row["_values"]) for row in fitted if row["_mean"])
    limits = []
    for k in range(len(SIZES)):
        far = np.array([v for row in fitted if not row["_mean"] and row["_size"] == k for v in row["_values"]])
        known = len(far) >= CALIBRATION
        limits.append(1 - SHARE * (1 - float(np.quantile(far, QUANTILE))) if known else None)
    for k in range(len(SIZES) - 1, -1, -1):
        larger = limits[k + 1] if k + 1 < len(SIZES) else 0.0
        limits[k] = max(RADIUS if limits[k] is None else limits[k], larger)
    vectors = np.array([m for _, m in found], np.float32).reshape(-1, dimensions)
    return Model(idf, vectors, [language for language, _ in found], tuple(limits))


def _sampled(rows: DataFrame, key: str, text: str, lang: str, sample: int) -> DataFrame:
    """About ``sample`` rows per language, all if there are fewer: rows whose hash lies below sample / rows."""
    unit = F.pmod(F.xxhash64(F.lit("langid"), F.col(key), F.xxhash64(text)), F.lit(1 << 30)) / float(1 << 30)
    known = rows.select(
        F.col(lang).cast("string").alias("_lang"),
        F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("hash")).alias("_own"),
        F.col(text).alias("_text"),
        unit.alias("_unit"),
    )
    shares = known.groupBy("_lang").agg((F.lit(float(sample)) / F.count(F.lit(1))).alias("_share"))
    shares = store(shares, "languages")
    # Languages are few; only a checked number of rows is broadcast, else texts are shuffled to the join.
    side = F.broadcast(shares) if shares.count() <= LANGUAGES else shares
    drawn = known.join(side, "_lang").where(F.col("_unit") < F.col("_share"))
    # Copies of a row are drawn together; they are combined before the shuffle, so they count once.
    return drawn.groupBy("_lang", "_own").agg(F.first("_text").alias("_text")).select("_lang", "_text")


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, lang_pred, score, rejected`` of every row; reads nothing but the text."""
    schema = T.StructType([T.StructField("_key", docs.schema[key].dataType)])
    schema = schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, idf, order = Grams(len(model.idf)), model.idf, np.ascontiguousarray(model.centroids.T)
        for batch in slices(batches, "_text"):
            names, scores, rejected = [], [], []
            for body in batch.column(1).to_pylist():
                codes = grams.codes(body or "")
                at, counts = grams.counts_of(codes)
                if not len(at) or not model.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                weights = np.log1p(counts) * idf[at]
                cosines = weights @ order[at] / np.linalg.norm(weights)
                best = int(cosines.argmax())
                names.append(model.languages[best])
                scores.append(float(min(max(cosines[best], 0.0), 1.0)))
                rejected.append(model.too_far(len(codes), 1 - scores[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["_key", "lang_pred", "score", "rejected"],
            )

    scored = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, schema)
    return scored.withColumnRenamed("_key", key)


def keep_known(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    whole = docs.select(whole_row(docs).alias("_row"), F.col(text).alias("_body"))
    scored = predict(whole, model, "_row", "_body")
    return scored.where(~F.col("rejected")).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
