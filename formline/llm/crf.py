"""Line quality by a linear-chain conditional random field, and document quality from its marginals.

Every line with a word is a node with two labels (0 bad, 1 good). A node's features are measures of its line
and of the lines before and after it; the edges have one weight per pair of labels. Training maximises the
conditional likelihood with every line of a labelled document carrying the document's label (weak labels),
penalised, by gradient steps on all chains at once. The fit uses about ``sample`` labelled documents, those
with the smallest hashes, so it is bounded; everything else covers all rows. A document's score is the mean
of its lines' marginals of "good" from the forward-backward recursion, weighted by the lines' lengths.

Defined results: a text that is null or has no word scores 0; ties do not arise; repeated rows score alike;
without both labels in training all other texts score the only label's value (1 if there is none); an empty
table gives an empty result; columns other than id and text are ignored. Two labels of one id resolve to the
larger; of several texts with one id the fit takes the one with the smallest hash. Very long texts are one chain.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from formline.llm.common import slices

SAMPLE = 8000
STEPS = 150
PENALTY = 1e-3
CLASSES = 6  # upper, lower, other letters, digits, symbols, white space

LINE_FEATURES = (
    "log_words", "log_chars", "word_length", "upper", "digits", "symbols", "distinct", "doubled", "short_words", "marks", "repeats",
)


def _kinds() -> np.ndarray:
    """The class of each code point of the first plane; what lies beyond counts as a letter without case."""
    table = np.empty(0x10001, np.uint8)
    for code in range(0x10000):
        char = chr(code)
        table[code] = (
            5 if char.isspace() else 0 if char.isupper() else 1 if char.islower() else 2 if char.isalpha() else 3 if char.isdigit() else 4
        )
    table[0x10000] = 2
    return table


def line_measures(text: str, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of LINE_FEATURES per line with a word, and the lines' lengths in characters."""
    rows, lengths, seen = [], [], set()
    for line in text.split("\n"):
        words = line.split()
        if not words:
            continue
        n, chars = len(words), len(line)
        points = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32)
        upper, lower, plain, digits, symbols, _ = np.bincount(
            kinds[np.minimum(points, 0x10000)], minlength=CLASSES
        ).tolist()
        letters = max(upper + lower + plain, 1)
        doubled = sum(map(str.__eq__, words[1:], words))
        marks = sum(not w[-1].isalnum() for w in words)
        rows.append(
            (
                np.log1p(n), np.log1p(chars), min((chars - n + 1) / n, 30) / 10, upper / letters, digits / chars,
                symbols / chars, len(set(words)) / n, doubled / n, sum(len(w) < 2 for w in words) / n, marks / n,
                float(line in seen),
            )
        )
        seen.add(line)
        lengths.append(chars)
    return np.array(rows, np.float64).reshape(-1, len(LINE_FEATURES)), np.array(lengths, np.float64)


def with_neighbours(rows: np.ndarray) -> np.ndarray:
    """Each line's measures, those of the line before and after (the line's own at the ends), first and last."""
    before = np.vstack([rows[:1], rows[:-1]])
    after = np.vstack([rows[1:], rows[-1:]])
    edge = np.zeros((len(rows), 2))
    edge[0, 0] = edge[-1, 1] = 1
    return np.hstack([rows, rows**2, before, after, edge])


@dataclass
class Field:
    """Weights of "good" per scaled feature, the bias, and the 2 x 2 edge weights."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    edges: np.ndarray

    def evidence(self, features: np.ndarray) -> np.ndarray:
        return (features - self.mean) / self.scale @ self.weights + self.bias


def marginals(evidence: np.ndarray, edges: np.ndarray, chains: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over many chains at once.

    ``evidence`` is the log weight of "good" against "bad" per node, chains stand one after the other and
    ``chains`` has their starts and the end. Returns the marginals of "good", the expected count of every
    label pair on the edges, and the sum of the log partition functions.
    """
    lengths = np.diff(chains)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = chains[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(steps)]  # chains longer than t
    weight = np.stack([-evidence / 2, evidence / 2], 1)
    top = weight.max(1)
    node = np.exp(weight - top[:, None])
    moves = np.exp(edges - edges.max())
    forward, scale = np.empty_like(node), np.empty(len(node))
    for t in range(steps):
        at = starts[: active[t]] + t
        now = node[at] if t == 0 else forward[at - 1] @ moves * node[at]
        scale[at] = now.sum(1)
        forward[at] = now / scale[at, None]
    backward = np.ones_like(node)
    pairs = np.zeros((2, 2))
    for t in range(steps - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        ahead = node[at + 1] * backward[at + 1] / scale[at + 1, None]
        backward[at] = ahead @ moves.T
        pairs += (forward[at].T @ ahead) * moves
    good = forward[:, 1] * backward[:, 1]
    total = good + forward[:, 0] * backward[:, 0]
    edge_count = int(np.maximum(lengths - 1, 0).sum())
    log_z = float(np.log(scale).sum() + top.sum() + edge_count * edges.max()) if len(node) else 0.0
    return good / np.maximum(total, 1e-300), pairs, log_z


def fit_field(features: np.ndarray, labels: np.ndarray, chains: np.ndarray, steps: int = STEPS) -> Field:
    """Adam steps on the mean conditional log likelihood; ``labels`` has one value per node."""
    mean, scale = features.mean(0), features.std(0)
    scale[scale < 1e-9] = 1.0
    x = (features - mean) / scale
    n, width = x.shape
    inner = np.ones(n, bool)
    inner[chains[1:] - 1] = False
    left = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[left], labels[left + 1]), 1.0)
    # Chains count alike, however many lines they have.
    share = np.repeat(1.0 / np.diff(chains), np.diff(chains))
    theta, m, v = np.zeros(width + 5), np.zeros(width + 5), np.zeros(width + 5)
    for k in range(1, steps + 1):
        good, pairs, _ = marginals(x @ theta[:width] + theta[width], theta[width + 1 :].reshape(2, 2), chains)
        miss = (labels - good) * share
        grad = np.concatenate([x.T @ miss, [miss.sum()], (seen - pairs).ravel() * share.mean()]) / share.sum()
        grad -= PENALTY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Field(mean, scale, theta[:width], float(theta[width]), theta[width + 1 :].reshape(2, 2))


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Field | float:
    """A field from the labelled documents, or the only label's value where there are not two.

    Both labels get half of the sample if there are enough documents of both.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("_key")).agg(F.max(label).alias("_label"))
    counts = {row["_label"]: row["n"] for row in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return float(next(iter(counts), 1))
    unit = F.pmod(F.xxhash64(F.lit("crf"), F.col("_key")), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("_label") == 1, sample / 2 / counts[1]).otherwise(sample / 2 / counts[0])
    picked = known.where(unit < share)
    bodies = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("_own"), F.col(text).alias("_text"))
    # About ``sample`` keys are broadcast. A key gives one text, however many rows have it, so the sample stays bounded.
    one = F.min(F.struct(F.xxhash64("_text").alias("hash"), "_text"))
    chosen = (
        bodies.join(F.broadcast(picked), F.col("_own") == F.col("_key"))
        .groupBy("_key", "_label")
        .agg(one.alias("_one"))
        .select("_label", F.col("_one._text").alias("_text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _kinds()
        for batch in slices(batches, "_text"):
            rows = []
            for value, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                measured, _ = line_measures(body, kinds)
                if len(measured):
                    rows.append((int(value), measured.astype(np.float32).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["_label", "_rows"]
            )

    chains = chosen.mapInArrow(run, "_label int, _rows binary").collect()  # bounded by ``sample``
    chains = sorted((row["_label"], bytes(row["_rows"])) for row in chains)  # a fixed order gives a fixed fit
    found = [np.frombuffer(raw, np.float32).reshape(-1, len(LINE_FEATURES)).astype(np.float64) for _, raw in chains]
    if len({value for value, _ in chains}) < 2:
        return float(chains[0][0]) if chains else 1.0
    lengths = [len(f) for f in found]
    return fit_field(
        np.vstack([with_neighbours(f) for f in found]),
        np.repeat([value for value, _ in chains], lengths),
        np.concatenate(([0], np.cumsum(lengths))),
    )


def score_documents(docs: DataFrame, field: Field | float, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, n_lines, n_good_lines`` of every row; a line is good if its marginal is one half or more."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _kinds()
        for batch in slices(batches, "_text"):
            measured = [line_measures(body or "", kinds) for body in batch.column(1).to_pylist()]
            counts = np.array([len(m) for _, m in measured], np.int64)
            chains = np.concatenate(([0], np.cumsum(counts[counts > 0])))
            rows = [m for m, _ in measured if len(m)]
            if not rows:
                good = np.zeros(0)
            elif isinstance(field, float):
                good = np.full(chains[-1], field)
            else:
                good, _, _ = marginals(field.evidence(np.vstack([with_neighbours(r) for r in rows])), field.edges, chains)
            weights = np.concatenate([w for _, w in measured]) if measured else np.zeros(0)
            scores, fine = np.zeros(len(counts)), np.zeros(len(counts), np.int64)
            if rows:
                held = counts > 0
                scores[held] = np.add.reduceat(good * weights, chains[:-1]) / np.add.reduceat(weights, chains[:-1])
                fine[held] = np.add.reduceat((good >= 0.5).astype(np.int64), chains[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.clip(scores, 0, 1)), pa.array(counts), pa.array(fine)],
                ["_id", "score", "n_lines", "n_good_lines"],
            )

    scored = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(
        run, f"_id {kind}, score double, n_lines bigint, n_good_lines bigint"
    )
    return scored.withColumnRenamed("_id", doc_id)
