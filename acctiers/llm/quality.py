"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled texts are all it learns from; negative labels are never used.  Features are
shape statistics of whole texts (letter case, symbols, repetition, lengths), cut into quantile bins; the
score is a logistic function of the bins.

*Class prior.*  A first model tells positives from unlabelled texts.  Above any score threshold the share of
unlabelled texts is at least the prior times the share of positives, so the prior is estimated as the
smallest ratio of the two upper tails.

*Risk.*  The unbiased risk of the negatives is the unlabelled risk less the prior's share of positives; where
a batch makes it negative it is taken as zero and its gradient is turned around (non-negative correction).

The fit uses at most ``FIT_ROWS`` positives and ``FIT_ROWS`` unlabelled texts, chosen by hash; scoring reads
every text whole.  Null and empty texts have all statistics 0 and are scored like any other text.  Without
positives every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers.llm import words as W
from acctiers.llm.runtime import keyed_text

FIT_ROWS = 8_000
BINS = 24
NAMES = (
    "words",
    "word_bytes",
    "upper",
    "symbols",
    "marks",
    "digits",
    "repeated_next",
    "repeated_any",
    "commonest",
    "repeated_grams",
    "words_per_line",
    "stops",
    "pipes",
)


def _kind(text: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in text]] = True
    return out


UPPER, LOWER = _kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _kind("abcdefghijklmnopqrstuvwxyz")
DIGITS, MARKS, STOPS = _kind("0123456789"), _kind("!?"), _kind(".,;:")
SYMBOLS, LINES, PIPES = _kind("#$%&*+/<=>@[\\]^_`{}~"), _kind("\n"), _kind("|")


def _repeats(doc: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """By text: distinct values and the count of the commonest one."""
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    fresh = np.ones(len(d), bool)
    fresh[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    heads = np.flatnonzero(fresh)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, d[heads], np.diff(np.append(heads, len(d))))
    return np.bincount(d[heads], minlength=n), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of NAMES per text."""
    data, offsets = W.buffers(texts)
    words = W.split(data, offsets)
    n = words.n_docs
    size = np.maximum(np.diff(offsets), 1)

    def share(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[data])])
        return total[offsets[1:]] - total[offsets[:-1]]

    count = words.counts()
    some = np.maximum(count, 1)
    hashes = words.hashes(lower=True)
    distinct, most = _repeats(words.doc, hashes, n)
    same = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    grams = W.rolling(hashes, 4)
    whole = words.doc[: len(grams)] == words.doc[3 : 3 + len(grams)]
    gram_doc = words.doc[: len(grams)][whole]
    gram_distinct, _ = _repeats(gram_doc, grams[whole], n)
    gram_count = np.bincount(gram_doc, minlength=n)
    upper, lower = share(UPPER), share(LOWER)
    return np.stack(
        [
            np.log1p(count),
            np.diff(offsets) / some,
            upper / np.maximum(upper + lower, 1),
            share(SYMBOLS) / size,
            share(MARKS) / size,
            share(DIGITS) / size,
            np.bincount(words.doc[1:][same], minlength=n) / some,
            # long texts repeat words by themselves
            1 - distinct / some**0.85,
            most / some,
            1 - gram_distinct / np.maximum(gram_count, 1) - (gram_count == 0),
            np.log1p(count / (1 + share(LINES))),
            share(STOPS) / some,
            share(PIPES) / some,
        ],
        axis=1,
    )


@dataclass
class Model:
    edges: list[np.ndarray]
    weights: np.ndarray
    bias: float
    prior: float

    def bins(self, table: np.ndarray) -> np.ndarray:
        return np.stack([i * BINS + np.searchsorted(e, table[:, i], "right") for i, e in enumerate(self.edges)], axis=1)

    def score(self, table: np.ndarray) -> np.ndarray:
        return sigmoid(self.bias + self.weights[self.bins(table)].sum(axis=1))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Adam:
    def __init__(self, n: int, rate: float = 0.05):
        self.theta, self.first, self.second, self.step, self.rate = np.zeros(n), np.zeros(n), np.zeros(n), 0, rate

    def move(self, grad: np.ndarray) -> None:
        self.step += 1
        self.first, self.second = 0.9 * self.first + 0.1 * grad, 0.99 * self.second + 0.01 * grad**2
        up, down = 1 - 0.9**self.step, 1 - 0.99**self.step
        self.theta = self.theta - self.rate * (self.first / up) / (np.sqrt(self.second / down) + 1e-8)


def _gradient(bins: np.ndarray, slope: np.ndarray, n: int) -> np.ndarray:
    """Gradient over weights and bias (last) for d loss / d z by row."""
    out = np.bincount(bins.ravel(), weights=np.repeat(slope, bins.shape[1]), minlength=n)
    out[-1] = slope.sum()
    return out


def _z(theta: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return theta[-1] + theta[bins].sum(axis=1)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Smallest ratio of the upper tails of scores, over tails of at least 5 % of the positives."""
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.95, 96)))
    tail_p = np.array([(positive >= c).mean() for c in cuts])
    tail_u = np.array([(unlabelled >= c).mean() for c in cuts])
    return float(np.clip((tail_u / np.maximum(tail_p, 1e-9)).min(), 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, decay: float = 1e-5) -> Model:
    if not len(positive) or not len(unlabelled):
        return Model([np.empty(0)] * len(NAMES), np.zeros(len(NAMES) * BINS), 0.0, 0.5)
    both = np.concatenate([positive, unlabelled])
    edges = [np.unique(np.quantile(both[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) for i in range(both.shape[1])]
    model = Model(edges, np.zeros(len(NAMES) * BINS), 0.0, 0.5)
    p, u = model.bins(positive), model.bins(unlabelled)
    n = len(model.weights) + 1
    # positives against unlabelled texts, on one half; the prior from the other half
    rng = np.random.default_rng(7)
    half_p, half_u = rng.random(len(p)) < 0.5, rng.random(len(u)) < 0.5
    first = _Adam(n)
    for _ in range(300):
        zp, zu = _z(first.theta, p[half_p]), _z(first.theta, u[half_u])
        grad = _gradient(p[half_p], (sigmoid(zp) - 1) / max(half_p.sum(), 1), n) + _gradient(u[half_u], sigmoid(zu) / max(half_u.sum(), 1), n)
        first.move(grad + decay * first.theta)
    model.prior = prior = estimate_prior(_z(first.theta, p[~half_p]), _z(first.theta, u[~half_u]))
    # losses are sigmoid(-z) for positives and sigmoid(z) for negatives: bounded, so a slightly wrong prior
    # moves the risk little; it starts from the first model, shifted to where negatives begin to prevail
    main = _Adam(n, 0.03)
    main.theta = first.theta.copy()
    main.theta[-1] -= np.quantile(_z(first.theta, u), 1 - prior)
    for _ in range(steps):
        sp, su = sigmoid(_z(main.theta, p)), sigmoid(_z(main.theta, u))
        slope_p, slope_u = sp * (1 - sp) / len(p), su * (1 - su) / len(u)
        toward = _gradient(u, slope_u, n) - prior * _gradient(p, slope_p, n)
        negative = su.mean() - prior * sp.mean()
        grad = toward - prior * _gradient(p, slope_p, n) if negative >= 0 else -toward
        main.move(grad + decay * main.theta)
    return Model(edges, main.theta[:-1], float(main.theta[-1]), prior)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.chunks(batches):
        table = statistics(batch["text"])
        flat = pa.FixedSizeListArray.from_arrays(pa.array(table.ravel()), table.shape[1])
        yield pa.RecordBatch.from_arrays([batch["doc_id"], flat.cast(pa.list_(pa.float64()))], names=["doc_id", "stats"])


def _matrix(df: DataFrame) -> np.ndarray:
    rows = df.mapInArrow(_stats, "doc_id bigint, stats array<double>").toArrow().sort_by("doc_id")
    return rows["stats"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def train(docs: DataFrame, positives: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """``positives``: ids of trusted texts; all of ``docs`` are unlabelled.  Both samples are bounded."""
    texts = keyed_text(docs, id_col, text_col)
    order = F.xxhash64("doc_id")
    trusted = positives.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id")).orderBy(order, "doc_id").limit(FIT_ROWS)
    anyone = texts.select("doc_id").orderBy(F.xxhash64(F.lit(1), "doc_id"), "doc_id").limit(FIT_ROWS)
    positive, unlabelled = (_matrix(texts.join(F.broadcast(ids), "doc_id", "left_semi")) for ids in (trusted, anyone))
    return fit(positive, unlabelled)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(shared.value.score(statistics(batch["text"])))], names=["doc_id", "score"]
            )

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double")
