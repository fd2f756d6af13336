"""Hidden Markov language model with exact sequence likelihoods.

Tokens are lower-cased (A-Z) words and one end per text. Each word has a class, a hash of its last three
bytes; hidden states emit classes, and a class emits its words by their training counts:

    P(text) = sum over state paths of  start(z1) emit(c1 | z1) move(z2 | z1) ...  x  product of P(word | class)

A word never seen in training takes the share T / (N + T) of its class, N being the class's tokens and T one
more than its words seen once. Word counts cover all training texts. The classes of all training texts are
stored once; every Baum-Welch pass sums the expected counts of all of them, per task and over the tasks, and
passes go on until the log-likelihood gains less than ``TOLERANCE`` a token. A sample of texts
(``SEED_DOCUMENTS``) only serves to find where to start. Scores come from the scaled forward recursion.

Counts are those of whole texts: a text is cut into runs of ``RUN`` tokens whose transfer matrices carry the
forward and backward messages from run to run, so that long texts take few steps and nothing is lost at the
cuts; the text's start is counted once.

The vocabulary grows with the corpus, so it is never whole in one place: the ``HEAD`` most frequent words at
most travel with the tasks, the rarer words of each text are joined with the stored counts by their hash.
Words are told apart by 64-bit keys.

Defined results: a null or blank text is one end token; texts of any length are read whole; words tied at the
limit of ``HEAD`` are joined; repeated rows are scored each, and are one text of the sample; without training rows
every token is unknown and every state alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from formline.llm.common import slices, text_bytes, word_bounds, word_keys
from formline.session import store

STATES = 6
CLASS_BITS = 13
CLASSES = 1 << CLASS_BITS
RUN = 64
HEAD = 1 << 18
TOLERANCE = 0.002
SEED_DOCUMENTS = 1500
SEED_ROUNDS = 25
PRIOR = 0.02
SCORE_BYTES = 4_000_000
_MASK = np.uint64(CLASSES - 1)
_END = np.uint64(0)  # class 0 holds the end token alone


def token_keys(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key per token, its low bits the class, and where each text's tokens start (with the end as last entry)."""
    word_start, word_end, first = word_bounds(data, starts)
    keys = word_keys(data, word_start, word_end)
    tail = np.zeros(len(keys), np.uint64)
    with np.errstate(over="ignore"):
        for k in (1, 2, 3):
            byte = data[np.maximum(word_end - k, 0)].astype(np.uint64)
            byte += np.where((byte >= 65) & (byte <= 90), np.uint64(32), np.uint64(0))
            tail = np.where(word_end - k >= word_start, tail * np.uint64(257) + byte + np.uint64(1), tail)
        kind = (tail * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    kind = kind % np.uint64(CLASSES - 1) + np.uint64(1)
    keys = (keys & ~_MASK) | kind
    tokens = np.insert(keys, first[1:], _END)
    return tokens, first + np.arange(len(first))


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """``_word, _n`` of every distinct token key; each task adds up its own words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added() -> pa.RecordBatch:
            words, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["_word", "_n"])

        for batch in slices(batches, "_text"):
            tokens, _ = token_keys(*text_bytes(batch.column(0)))
            held.append(tokens)
            size += len(tokens)
            if size > 4_000_000:
                yield added()
                held, size = [], 0
        if held:
            yield added()

    counted = texts.select(F.col(text).alias("_text")).mapInArrow(run, "_word bigint, _n bigint")
    return counted.groupBy("_word").agg(F.sum("_n").alias("_n"))


@dataclass
class Chain:
    """start: S, move: S x S, emit: S x CLASSES; rows sum to one."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _normal(start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Chain:
    emit = emit + PRIOR
    start, move = start + 1.0, move + 1.0
    return Chain(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def classes_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens & _MASK).astype(np.int64)


@dataclass
class Runs:
    """Runs of at most ``RUN`` tokens that do not cross texts, longest first; ``after`` is the run's next one or -1."""

    begin: np.ndarray
    size: np.ndarray
    place: np.ndarray
    after: np.ndarray


def runs_of(starts: np.ndarray, run: int) -> Runs:
    lengths = np.diff(starts)
    pieces = -(-lengths // run)
    owner = np.repeat(np.arange(len(lengths)), pieces)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.minimum(lengths[owner] - place * run, run)
    order = np.argsort(-size, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    follows = np.append(place[1:] > 0, False) if len(place) else np.zeros(0, bool)
    after = np.where(follows, np.append(rank[1:], -1), -1) if len(place) else rank
    return Runs((starts[owner] + place * run)[order], size[order], place[order], after[order])


def _messages(chain: Chain, emit: np.ndarray, classes: np.ndarray, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """For every run the state distribution before its first token, and the weight of all tokens behind it."""
    states = len(chain.start)
    before, behind = np.tile(chain.start, (len(runs.size), 1)), np.ones((len(runs.size), states))
    long = np.flatnonzero((runs.after >= 0) | (runs.place > 0))
    if not len(long):
        return before, behind
    own = np.full(len(runs.size), -1)
    own[long] = np.arange(len(long))
    begin, size = runs.begin[long], runs.size[long]  # still longest first
    through = np.eye(states) * emit[classes[begin]][:, None, :]
    for t in range(1, int(size[0])):
        n = int(np.searchsorted(-size, -t, "left"))
        now = (through[:n].reshape(-1, states) @ chain.move).reshape(n, states, states)
        now *= emit[classes[begin[:n] + t]][:, None, :]
        if t % 8 == 0:
            now /= now.max((1, 2), keepdims=True)
        through[:n] = now
    through /= through.max((1, 2), keepdims=True)
    order = np.argsort(runs.place[long], kind="stable")
    steps = np.split(long[order], np.flatnonzero(np.diff(runs.place[long][order])) + 1)
    for rows in steps:
        rows = rows[runs.after[rows] >= 0]
        ended = np.einsum("ri,rij->rj", before[rows], through[own[rows]])
        before[runs.after[rows]] = (ended / ended.sum(1, keepdims=True)) @ chain.move
    for rows in reversed(steps):
        rows = rows[runs.after[rows] >= 0]
        next_rows = runs.after[rows]
        ahead = np.einsum("rij,rj->ri", through[own[next_rows]], behind[next_rows])
        behind[rows] = (ahead / ahead.sum(1, keepdims=True)) @ chain.move.T
    return before, behind


def expected_counts(
    chain: Chain, classes: np.ndarray, starts: np.ndarray, run: int = RUN
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Baum-Welch expected counts of starts, moves and emissions of whole texts, and their log-likelihood."""
    states = len(chain.start)
    runs = runs_of(starts, run)
    steps = int(runs.size[0]) if len(runs.size) else 0
    active = [int(np.searchsorted(-runs.size, -t, "left")) for t in range(steps)]
    emit = np.ascontiguousarray(chain.emit.T)
    before, behind = _messages(chain, emit, classes, runs)
    forward, node, likelihood = [], [], 0.0
    last = np.empty_like(before)
    for t in range(steps):
        n = active[t]
        seen = emit[classes[runs.begin[:n] + t]]
        now = (before if t == 0 else forward[-1][:n] @ chain.move) * seen
        total = now.sum(1, keepdims=True)
        now /= total
        likelihood += float(np.log(total).sum())
        forward.append(now)
        node.append(seen)
        last[:n] = now
    move = np.zeros((states, states))
    emitted = np.zeros((CLASSES, states))
    start, back, ahead = np.zeros(states), behind, behind
    for t in range(steps - 1, -1, -1):
        n, more = active[t], active[t + 1] if t + 1 < steps else 0
        pulled = behind[:n].copy()
        if more:
            pulled[:more] = ahead @ chain.move.T
        scale = (forward[t] * pulled).sum(1, keepdims=True)
        if more:
            move += (forward[t][:more].T @ (ahead / scale[:more])) * chain.move
        back = pulled / scale
        inside = forward[t] * back
        kind = classes[runs.begin[:n] + t]
        for z in range(states):
            emitted[:, z] += np.bincount(kind, inside[:, z], CLASSES)
        ahead = node[t] * back
        if t == 0:
            start = inside[runs.place == 0].sum(0)
            rows = np.flatnonzero(runs.after >= 0)  # moves from a run's last token to the next run's first
            into = ahead[runs.after[rows]]
            total = (last[rows] * (into @ chain.move.T)).sum(1, keepdims=True)
            move += (last[rows].T @ (into / total)) * chain.move
    return start, move, emitted.T, likelihood


def seed_chain(classes: np.ndarray, starts: np.ndarray, states: int, rounds: int = SEED_ROUNDS) -> Chain:
    """A starting point: noisy emissions, improved by Baum-Welch on a small set of texts."""
    noise = np.random.default_rng(11)
    base = np.bincount(classes, minlength=CLASSES) + 0.1
    emit = base * noise.gamma(1.0, 1.0, (states, CLASSES))
    sticky = np.full((states, states), 1.0) + np.eye(states) * 20 * states
    chain = Chain(np.full(states, 1 / states), sticky / sticky.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
    for _ in range(rounds if len(classes) else 0):
        chain = _normal(*expected_counts(chain, classes, starts)[:3])
    return chain


def class_rows(texts: DataFrame, text: str) -> DataFrame:
    """The classes of all texts, a slice of texts to a row: ``_kinds`` (two bytes each) and ``_lengths``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            tokens, starts = token_keys(*text_bytes(batch.column(0)))
            ends = pa.array([0, batch.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([classes_of(tokens).astype(np.int16).tobytes()], pa.binary()),
                    pa.ListArray.from_arrays(ends, pa.array(np.diff(starts))),
                ],
                ["_kinds", "_lengths"],
            )

    return texts.select(F.col(text).alias("_text")).mapInArrow(run, "_kinds binary, _lengths array<bigint>")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for kinds, lengths in zip(batch.column(0), batch.column(1)):
            starts = np.concatenate(([0], np.cumsum(lengths.values.to_numpy(zero_copy_only=False))))
            yield np.frombuffer(kinds.as_buffer(), np.int16).astype(np.int64), starts.astype(np.int64)


def baum_welch(chain: Chain, rows: DataFrame) -> tuple[Chain, float, float]:
    """One pass over all stored texts: the new chain, the old one's log-likelihood, and the number of tokens."""
    states = len(chain.start)
    width = 2 + states + CLASSES

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((width, states))
        for kinds, starts in _rows(batches):
            start, move, emit, likelihood = expected_counts(chain, kinds, starts)
            sums[0, :2] += likelihood, len(kinds)
            sums[1:] += np.vstack([start[None], move, emit.T])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width)), *(pa.array(sums[:, z]) for z in range(states))],
            ["_at", *(f"_s{z}" for z in range(states))],
        )

    schema = "_at bigint, " + ", ".join(f"_s{z} double" for z in range(states))
    added = rows.mapInArrow(gather, schema).groupBy("_at").agg(*[F.sum(f"_s{z}") for z in range(states)])
    sums = np.zeros((width, states))
    for row in added.collect():  # the size of the model, whatever the input
        sums[row[0]] = row[1:]
    return _normal(sums[1], sums[2 : 2 + states], sums[2 + states :].T), float(sums[0, 0]), float(sums[0, 1])


def train_chain(
    texts: DataFrame, key: str, text: str, total: int, states: int = STATES, tolerance: float = TOLERANCE
) -> Chain:
    """Baum-Welch over every training text (``total`` rows) until a pass gains less than ``tolerance`` a token."""
    unit = F.pmod(F.xxhash64(F.lit("hmm"), F.col(key), F.xxhash64(text)), F.lit(1 << 30)) / float(1 << 30)
    drawn = texts.where(unit < SEED_DOCUMENTS / max(total, 1))
    # Copies of a row are drawn together; they are combined before the shuffle, so they count once.
    drawn = drawn.groupBy(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash")).agg(F.first(text).alias("_text"))
    picked = class_rows(drawn.select("_text"), "_text").select("_kinds", "_lengths").collect()  # bounded by the sample
    found = sorted(bytes(k) for r in picked for k in _texts(bytes(r["_kinds"]), r["_lengths"]))
    starts = np.concatenate(([0], np.cumsum([len(k) // 2 for k in found]))).astype(np.int64)
    chain = seed_chain(np.frombuffer(b"".join(found), np.int16).astype(np.int64), starts, states)
    if not total:
        return chain
    rows, before = store(class_rows(texts, text), "hmm-classes"), -np.inf
    while True:
        chain, likelihood, tokens = baum_welch(chain, rows)
        if likelihood - before < tolerance * tokens:
            return chain
        before = likelihood


def _texts(kinds: bytes, lengths: list[int]) -> list[bytes]:
    ends = 2 * np.cumsum(lengths)
    return [kinds[b - 2 * n : b] for b, n in zip(ends.tolist(), lengths)]


def forward_log10(chain: Chain, classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text's class sequence, by the scaled forward recursion."""
    lengths = np.diff(starts)
    order = np.argsort(-lengths, kind="stable")
    begin, sizes = starts[:-1][order], lengths[order]
    emit = np.ascontiguousarray(chain.emit.T)
    logs = np.zeros(len(order))
    now = None
    falling = -sizes
    for t in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(falling, -t, "left"))
        now = (chain.start if t == 0 else now[:n] @ chain.move) * emit[classes[begin[:n] + t]]
        total = now.sum(1)
        now /= total[:, None]
        logs[:n] += np.log10(total)
    out = np.empty(len(order))
    out[order] = logs
    return out


def _head(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the most frequent words, at most ``most``: all above a count found from a histogram."""
    bin_of = F.floor(F.log2("_n") * 8).cast("int")
    histogram = sorted(counts.groupBy(bin_of.alias("_bin")).agg(F.count(F.lit(1)).alias("_k")).collect(), reverse=True)
    taken, least = 0, None
    for row in histogram:  # at most 8 x 64 rows
        if taken + row["_k"] > most:
            break
        taken, least = taken + row["_k"], row["_bin"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = counts.where(bin_of >= least).select("_word", "_n").collect()
    words = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    sizes = np.array([r[1] for r in rows], np.int64)
    order = np.argsort(words)
    return words[order], sizes[order]


def score_texts(
    docs: DataFrame,
    training: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    states: int = STATES,
    head: int = HEAD,
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``."""
    counts = store(word_counts(training, text), "hmm-words")
    of_class = F.col("_word").bitwiseAND(F.lit(CLASSES - 1))
    classes = counts.groupBy(of_class.alias("_class")).agg(
        F.sum("_n").alias("_tokens"), F.count(F.lit(1)).alias("_words"), F.sum(F.when(F.col("_n") == 1, 1).otherwise(0)).alias("_once")
    )
    class_tokens, class_once = np.zeros(CLASSES), np.zeros(CLASSES)
    tokens = words = 0
    for row in classes.collect():  # at most CLASSES rows
        class_tokens[row["_class"]], class_once[row["_class"]] = row["_tokens"], row["_once"]
        tokens, words = tokens + row["_tokens"], words + row["_words"]
    room = np.log10(class_tokens + class_once + 1)
    unseen = np.log10(class_once + 1)
    rows = training.count()
    chain = train_chain(training, doc_id, text, rows, states)
    top_words, top_counts = _head(counts, head)
    shared = docs.sparkSession.sparkContext.broadcast((chain, room, unseen, top_words, top_counts))
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, room, unseen, top_words, top_counts = shared.value
        log_n, log_n1 = np.log10(np.maximum(top_counts, 1)), np.log10(top_counts + 1)
        for batch in slices(batches, "_text", SCORE_BYTES):
            keys, starts = token_keys(*text_bytes(batch.column(1)))
            kinds = classes_of(keys)
            scores = forward_log10(chain, kinds, starts)
            place = np.minimum(np.searchsorted(top_words, keys), max(len(top_words) - 1, 0))
            top = top_words[place] == keys if len(top_words) else np.zeros(len(keys), bool)
            add = lambda values: np.add.reduceat(values, starts[:-1])
            # What is known now; the rare words' shares are added by the join.
            word_part = -room[kinds]
            base_part = np.zeros(len(keys))
            word_part[top] += log_n[place[top]]
            base_part[top] = log_n1[place[top]]
            rare = np.flatnonzero(~top)
            owner = np.searchsorted(starts, rare, "right") - 1
            lists = np.searchsorted(owner, np.arange(len(starts)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(starts)),
                    pa.array(add(top.astype(np.int64))),
                    pa.array(add(base_part)),
                    pa.array(scores + add(word_part)),
                    pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(keys[rare].view(np.int64))),
                ],
                ["_id", "_tokens", "_known", "_base", "_score", "_rare"],
            )

    schema = f"_id {kind}, _tokens bigint, _known bigint, _base double, _score double, _rare array<bigint>"
    parts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, schema)
    parts = store(parts.withColumn("_row", F.monotonically_increasing_id()), "hmm-texts")
    unseen_of = docs.sparkSession.createDataFrame(
        [(c, float(v)) for c, v in enumerate(unseen)], "_class bigint, _unseen double"
    )
    # One row per class: the broadcast side has a fixed size.
    rare = (
        parts.select("_row", F.explode("_rare").alias("_word"))
        .join(counts, "_word", "left")
        .join(F.broadcast(unseen_of), of_class == F.col("_class"))
        .groupBy("_row")
        .agg(
            F.count("_n").alias("_k"),
            F.sum(F.log10(F.coalesce("_n", F.lit(0)) + 1)).alias("_b"),
            F.sum(F.coalesce(F.log10("_n"), "_unseen")).alias("_s"),
        )
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return parts.drop("_rare").join(rare, "_row", "left").select(
        F.col("_id").alias(doc_id),
        F.col("_tokens").alias("n_tokens"),
        (F.col("_known") + zero("_k")).cast("long").alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("_base") + zero("_b") - F.col("_tokens") * F.lit(float(np.log10(tokens + words + 1)))).alias("base_score"),
        (F.col("_score") + zero("_s")).alias("score"),
    )
