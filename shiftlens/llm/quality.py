"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; documents labelled bad are never examples.  Unlabelled
documents are a sample of all documents of the training folds.  The class prior is the share of good
ones among the labels of the training folds.  Where all labels are good, a network that tells
positives from unlabelled text gives it by the best bin of its scores: the least ratio of the shares
of both samples above a threshold, with a margin for their size.  The classifier then minimises the non-negative unbiased risk ``prior * R+(P) + max(0, R-(U) - prior * R-(P))``: where the
second term falls below a small slack its gradient is reversed, so the network can't fit the
unlabelled text as all negative.

Features come from the text alone: bytes, transitions between kinds of characters, and words (length,
case, repetition, marks).  Both samples are bounded by ``SAMPLE`` documents, which are the smallest by
a hash; everything else, scoring above all, covers all rows.

Edge cases: null and empty texts have features of nothing and get a score; labels that are null,
repeated or of unknown documents are ignored; rows that repeat a doc_id are scored by their texts; a
null doc_id is in no training fold; without positives or unlabelled text every score is 0.5; an empty
table gives no rows; columns other than doc_id and text are ignored, and pass through ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.common import small_batches

#: Documents of each sample at most; units of the hidden layer; steps of training; rows of each sample in a step.
SAMPLE, HIDDEN, STEPS, BATCH = 12_000, 24, 800, 2048
RATE, DECAY, SLACK, SEED = 0.01, 1e-4, 0.03, 1
FOLDS, HELD_OUT = 3, 1
#: Kinds of bytes: control and space, lower, upper, digit, mark, line end, beyond ASCII.
KINDS = np.zeros(256, dtype=np.int64)
KINDS[33:127] = 4
KINDS[ord("a") : ord("z") + 1], KINDS[ord("A") : ord("Z") + 1], KINDS[ord("0") : ord("9") + 1] = 1, 2, 3
KINDS[10], KINDS[128:] = 5, 6
N_KINDS = 7
WIDTH = 128 + N_KINDS * N_KINDS + 14
SCORED = "doc_id long, score double"


def features(text: bytes) -> np.ndarray:
    out = np.zeros(WIDTH, dtype=np.float32)
    if not text:
        return out
    data = np.frombuffer(text, dtype=np.uint8)
    counts = np.bincount(data, minlength=256)
    out[:128] = np.sqrt(counts[:128] / len(data))
    kinds = KINDS[data]
    pairs = np.bincount(kinds[:-1] * N_KINDS + kinds[1:], minlength=N_KINDS * N_KINDS)
    out[128 : 128 + N_KINDS * N_KINDS] = np.sqrt(pairs / len(data))
    words, lines = text.split(), text.split(b"\n")
    n = max(len(words), 1)
    again = sum(map(eq, words, words[1:]))
    sizes = np.fromiter(map(len, words), dtype=np.float32, count=len(words)) if words else np.zeros(1, np.float32)
    letters = counts[65:91].sum() + counts[97:123].sum()
    upper = sum(map(bytes.isupper, words))
    title = sum(map(bytes.istitle, words))
    alpha = sum(map(bytes.isalpha, words))
    out[-14:] = (
        np.log1p(len(data)) / 10, np.log1p(len(words)) / 10, sizes.mean() / 10, sizes.std() / 10, again / n, len(set(words)) / n,
        len(set(words)) / np.sqrt(n) / 10, upper / n, title / n, alpha / n, counts[65:91].sum() / max(letters, 1), len(set(lines)) / len(lines),
        len(lines) / n, counts[128:].sum() / len(data),
    )
    return out


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(bytes(x.as_buffer() or b"")).tobytes() for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], ["doc_id", "trusted", "features"])


class Network:
    """One hidden layer on standardised features; its output is a log-odds."""

    def __init__(self, x: np.ndarray, rng: np.random.Generator):
        self.mean = x.mean(axis=0, dtype=np.float64)
        # a few rows at a time: the driver holds the samples in single precision only
        off = sum(((x[at : at + BATCH] - self.mean) ** 2).sum(axis=0) for at in range(0, len(x), BATCH))
        self.std = np.sqrt(off / len(x)) + 1e-3
        self.weights = [rng.normal(0, (2 / WIDTH) ** 0.5, (WIDTH, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self.moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights]
        self.steps = 0

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.std, -6, 6)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of rows that are scaled."""
        self.x, w = x, self.weights
        self.h = np.maximum(x @ w[0] + w[1], 0)
        return self.h @ w[2] + w[3][0]

    def learn(self, slope: np.ndarray) -> None:
        """One step of Adam for the derivative of the risk by each output of the last call."""
        back = np.outer(slope, self.weights[2]) * (self.h > 0)
        slopes = [self.x.T @ back, back.sum(axis=0), self.h.T @ slope, np.array([slope.sum()])]
        self.steps += 1
        for w, d, (m, v) in zip(self.weights, slopes, self.moments, strict=True):
            d = d + DECAY * w
            m += 0.1 * (d - m)
            v += 0.001 * (d * d - v)
            w -= RATE * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def batches_of(net: Network, p: np.ndarray, u: np.ndarray, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """STEPS pairs of scaled batches, each sample in random order again and again."""
    def endless(x: np.ndarray) -> Iterator[np.ndarray]:
        while True:
            for rows in np.array_split(rng.permutation(len(x)), -(-len(x) // BATCH)):
                yield net.scaled(x[rows])

    for _, a, b in zip(range(STEPS), endless(p), endless(u), strict=False):
        yield a, b


def tell_apart(p: np.ndarray, u: np.ndarray, rng: np.random.Generator) -> Network:
    """Positives against unlabelled text, both of weight one half, by logistic loss."""
    net = Network(np.concatenate([p, u]), rng)
    for a, b in batches_of(net, p, u, rng):
        odds = sigmoid(net(np.concatenate([a, b])))
        net.learn(np.concatenate([(odds[: len(a)] - 1) / (2 * len(a)), odds[len(a) :] / (2 * len(b))]))
    return net


def best_bin(p: np.ndarray, u: np.ndarray) -> float:
    """The prior from scores of positives and of unlabelled rows that no network has seen."""
    marks = np.unique(np.quantile(p, np.linspace(0, 0.99, 100)))
    above_p, above_u = ((x[None, :] >= marks[:, None]).mean(axis=1) for x in (p, u))
    margin = sum((np.log(4 / 0.1) / (2 * len(x))) ** 0.5 for x in (p, u))
    at = np.argmin((above_u + 1.01 * margin) / above_p)
    return float(np.clip(above_u[at] / above_p[at], 0.01, 0.99))


def estimated_prior(p: np.ndarray, u: np.ndarray, rng: np.random.Generator) -> float:
    """Two halves score each other."""
    scores: tuple[list, list] = ([], [])
    for half in (0, 1):
        net = tell_apart(p[half::2], u[half::2], rng)
        for own, x in zip(scores, (p[1 - half :: 2], u[1 - half :: 2]), strict=True):
            z = net(net.scaled(x))
            own.append(z)
    return float(np.mean([best_bin(a, b) for a, b in zip(*scores, strict=True)]))


def risks(z: np.ndarray, n: int, prior: float) -> tuple[float, float]:
    """Risk of the first ``n`` rows (positives) as such, and the unbiased risk of negatives, of log-odds ``z``."""
    negative = np.logaddexp(0, z)  # logistic loss of a row taken as negative
    return prior * (negative[:n] - z[:n]).mean(), negative[n:].mean() - prior * negative[:n].mean()


def descent(z: np.ndarray, n: int, prior: float) -> np.ndarray:
    """The derivative to follow: of the whole risk, or up the risk of negatives where that is below -SLACK."""
    odds = sigmoid(z)
    as_negative = np.concatenate([-prior * odds[:n] / n, odds[n:] / (len(z) - n)])
    if risks(z, n, prior)[1] < -SLACK:
        return -as_negative
    return as_negative + np.concatenate([prior * (odds[:n] - 1) / n, np.zeros(len(z) - n)])


def fit(p: np.ndarray, u: np.ndarray, prior: float | None = None, seed: int = SEED) -> tuple[Network, float]:
    """The classifier of least non-negative risk and the prior it used."""
    rng = np.random.default_rng(seed)
    prior = estimated_prior(p, u, rng) if prior is None else float(np.clip(prior, 0.01, 0.99))
    net = Network(u, rng)
    for a, b in batches_of(net, p, u, rng):
        net.learn(descent(net(np.concatenate([a, b])), len(a), prior))
    return net, prior


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def samples(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features of trusted positives and of unlabelled text of the training folds, at most ``sample`` of each."""
    seen = F.col("doc_id").isNotNull() & (fold() != HELD_OUT)
    ids = docs.filter(seen).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    drawn = [
        x.orderBy(F.xxhash64(F.lit(s), "doc_id"), "doc_id").limit(sample).select("doc_id", F.lit(t).alias("trusted"))
        for x, s, t in ((ids.join(good, "doc_id", "left_semi"), "positive", True), (ids, "unlabelled", False))
    ]
    chosen = drawn[0].unionByName(drawn[1]).withColumnRenamed("doc_id", "_id")  # twice ``sample`` rows at most
    rows = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "trusted", F.col("text").cast("binary"))
    table = rows.mapInArrow(feature_rows, "doc_id long, trusted boolean, features binary").toArrow().sort_by("doc_id")
    trusted = np.array(table["trusted"].to_pylist(), dtype=bool)
    x = np.empty((len(trusted), WIDTH), dtype=np.float32)
    for i, row in enumerate(table["features"]):
        x[i] = np.frombuffer(row.as_buffer(), dtype=np.float32)
    del table
    return x[trusted], x[~trusted]


def labelled_share(labels: DataFrame) -> float | None:
    """The share of good documents among the labels of the training folds; None if they are all good or there are none."""
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold() != HELD_OUT))
    good, n = known.agg(F.sum("quality"), F.count(F.lit(1))).first()
    return good / n if n and good < n else None


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, prior: float | None = None) -> "Scorer":
    small_batches(docs.sparkSession)
    prior = labelled_share(labels) if prior is None else prior
    p, u = samples(docs, labels, sample)
    return Scorer(fit(p, u, prior)[0] if len(p) > 1 and len(u) > 1 else None)


class Scorer:
    """Scores texts by the fitted network, or 0.5 without one."""

    def __init__(self, net: Network | None):
        self.parts = None if net is None else (net.mean, net.std, *net.weights)

    def of(self, texts: list[bytes]) -> np.ndarray:
        if self.parts is None or not texts:
            return np.full(len(texts), 0.5)
        mean, std, w0, b0, w1, b1 = self.parts
        x = np.clip((np.stack([features(t) for t in texts]) - mean) / std, -6, 6)
        return sigmoid(np.maximum(x @ w0 + b0, 0) @ w1 + b1[0])

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The batches with the score of their last column, a text, in its place."""
        for batch in batches:
            texts = [bytes(x.as_buffer() or b"") for x in batch.column(batch.num_columns - 1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(self.of(texts), pa.float64())], [*batch.schema.names[:-1], "score"])


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, prior: float | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    scorer = scores(docs, labels, sample, prior)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scorer.rows, SCORED)
    held_out = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    scorer = scores(docs, labels, sample)
    kept = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scorer.rows(batches):
            good = batch.column(batch.num_columns - 1).to_numpy() >= 0.5
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["_row"]).filter(pa.array(good))

    return kept.mapInArrow(judged, kept.select("_row").schema).select("_row.*")
