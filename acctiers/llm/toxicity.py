"""Toxicity by multiple-instance learning: a text is toxic when one of its sentences is.

A sentence's score is a logistic function of the words and word beginnings in it; a text's score is their
noisy-or, 1 - prod(1 - p).  Only texts have labels; the gradient of the noisy-or shares a text's label out
among its sentences, so training also tells which sentences offend, and ``offending`` lists them.

The model is fitted, in one task, on a bounded, hash-ordered sample of labelled rows (``FIT_ROWS`` rows of at
most ``FIT_BYTES`` each) and holds at most ``FEATURES`` weights, so what is collected and broadcast does not grow.
Scoring reads every text whole.

Null and empty texts, and texts without words, have score 0 and no sentences.  A label of null is no label;
without labels of both kinds every sentence gets the share of toxic labels (0 without any).  Rows that repeat an id are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers.llm import words as W
from acctiers.llm.runtime import extended, keyed_text

U = np.uint64
FIT_ROWS = 8_000
FIT_BYTES = 32_768
FEATURES = 6_000
SLICE = 256  # texts of the sample worked on at a time
PREFIXES = (4, 5, 6)  # bytes of the word beginnings used beside whole words
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n\r"]] = True


@dataclass
class Sentences:
    """Words of several texts with the number of their sentence; texts' numbers by sentence."""

    words: W.Words
    of_word: np.ndarray
    doc: np.ndarray  # by sentence
    begin: np.ndarray
    end: np.ndarray


def sentences(data: np.ndarray, offsets: np.ndarray) -> Sentences:
    words = W.split(W.LOWER[data], offsets, W.PLAIN)
    passed = np.concatenate([[0], np.cumsum(ENDS[data])])[words.starts] if len(words.starts) else np.empty(0, np.int64)
    fresh = np.ones(len(passed), bool)
    fresh[1:] = (passed[1:] != passed[:-1]) | (words.doc[1:] != words.doc[:-1])
    heads = np.flatnonzero(fresh)
    last = np.append(heads[1:], len(fresh)) - 1 if len(heads) else heads
    return Sentences(words, np.cumsum(fresh) - 1, words.doc[heads], words.starts[heads], words.ends[last])


def features(words: W.Words) -> np.ndarray:
    """One row of feature hashes per word: the word and its beginnings."""
    columns = [words.hashes()]
    for n in PREFIXES:
        cut = W.Words(words.data, words.offsets, words.starts, np.minimum(words.ends, words.starts + n), words.doc)
        long = words.ends - words.starts > n
        columns.append(np.where(long, W.mix(cut.hashes() + U(n)), columns[0]))
    return np.stack(columns, axis=1) if len(words.starts) else np.empty((0, len(PREFIXES) + 1), np.uint64)


@dataclass
class Model:
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    bias: float = -30.0
    known: np.ndarray | None = None

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``hashes``, number of the feature) of known features."""
        if not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if self.known is None:  # a small table that turns away most words at once
            self.known = np.zeros(1 << 18, bool)
            self.known[(self.keys & U((1 << 18) - 1)).astype(np.int64)] = True
        at = np.flatnonzero(self.known[(hashes & U((1 << 18) - 1)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[number] == hashes[at]
        return at[same], number[same]

    def incidence(self, s: Sentences) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (sentence, feature) pairs."""
        table = features(s.words)
        at, number = self.find(table.ravel())
        pair = np.unique(s.of_word[at // table.shape[1]] * len(self.keys) + number) if len(at) else np.empty(0, np.int64)
        return pair // max(len(self.keys), 1), pair % max(len(self.keys), 1)

    def sentence_scores(self, sentence: np.ndarray, number: np.ndarray, n: int) -> np.ndarray:
        """Sentences without a known feature score 0, so that they do not add up in long texts."""
        if not len(self.keys):
            return np.full(n, 1 / (1 + np.exp(-self.bias)))
        z = self.bias + np.bincount(sentence, weights=self.weights[number], minlength=n)
        return np.where(np.bincount(sentence, minlength=n) > 0, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0)


def noisy_or(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return 0.0 - np.expm1(np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n))


def _slices(texts: pa.Array) -> Iterator[tuple[int, Sentences]]:
    """A few texts at a time, so that word arrays stay small."""
    for low in range(0, len(texts), SLICE):
        yield low, sentences(*W.buffers(texts.slice(low, SLICE)))


def select_features(texts: pa.Array, labels: np.ndarray) -> np.ndarray:
    """Features most associated with the labels of the texts they stand in (chi square), in hash order."""
    hashes, toxic = [], []
    for low, s in _slices(texts):
        table = features(s.words)
        doc, value = np.repeat(s.words.doc, table.shape[1]), table.ravel()
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
        hashes.append(value[fresh])
        toxic.append(labels[low + doc[fresh]].astype(bool))
    value, toxic = np.concatenate(hashes), np.concatenate(toxic)
    order = np.argsort(value)
    value, toxic = value[order], toxic[order]
    heads = np.flatnonzero(np.concatenate([np.ones(min(len(value), 1), bool), value[1:] != value[:-1]]))
    if not len(heads):
        return value
    seen = np.diff(np.append(heads, len(value))).astype(float)
    hit = np.add.reduceat(toxic.astype(np.float64), heads)
    share = labels.mean()
    excess = (hit - seen * share) ** 2 / (seen * share * (1 - share)) * len(labels) / np.maximum(len(labels) - seen, 1)
    excess[seen < 3] = 0
    best = np.argsort(-excess, kind="stable")[:FEATURES]
    return np.sort(value[heads[best[excess[best] > 6]]])


def fit(texts: pa.Array, labels: np.ndarray, steps: int = 250, decay: float = 2e-4) -> Model:
    """Gradient descent (Adam) on the log loss of the noisy-or."""
    labels = labels.astype(np.int64)
    if len(np.unique(labels)) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        return Model(bias=float(np.log(share / (1 - share))) if 0 < share < 1 else (30.0 if share else -30.0))
    model = Model(select_features(texts, labels))
    model.weights = np.zeros(len(model.keys))
    parts, docs, n_sentences = [], [], 0
    for low, s in _slices(texts):
        of, number = model.incidence(s)
        parts.append((of + n_sentences, number))
        docs.append(s.doc + low)
        n_sentences += len(s.doc)
    sentence, number = (np.concatenate(x) for x in zip(*parts, strict=True))
    doc, n = np.concatenate(docs), len(labels)
    bias, theta = -4.0, np.zeros(len(model.keys))
    first, second, bias_first, bias_second = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0
    for step in range(1, steps + 1):
        model.weights, model.bias = theta, bias
        p = model.sentence_scores(sentence, number, n_sentences)
        whole = np.clip(noisy_or(p, doc, n), 1e-9, 1 - 1e-9)
        pull = np.where(labels == 1, (1 - whole) / whole, -1.0)  # d log likelihood / d z, over p
        slope = -p * pull[doc] / n
        grad = np.bincount(number, weights=slope[sentence], minlength=len(theta)) + decay * theta / max(len(theta), 1)
        bias_grad = slope.sum()
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        bias_first, bias_second = 0.9 * bias_first + 0.1 * bias_grad, 0.99 * bias_second + 0.01 * bias_grad**2
        up, down = 1 - 0.9**step, 1 - 0.99**step
        theta = theta - 0.1 * (first / up) / (np.sqrt(second / down) + 1e-8)
        bias = bias - 0.1 * (bias_first / up) / (np.sqrt(bias_second / down) + 1e-8)
    return Model(model.keys, theta, bias)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, size: int) -> DataFrame:
    """(label, text) of at most ``rows`` labelled rows, chosen by the hash of their id."""
    chosen = labels.where("label is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.where(F.octet_length("text") <= size).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def _fit_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of the whole sample as rows (key, weight); the row without a key is the bias."""
    parts = [b for b in batches if b.num_rows]
    model = Model()
    if parts:
        sample = pa.Table.from_batches(parts).sort_by("doc_id")
        model = fit(sample["text"].combine_chunks(), sample["label"].to_numpy())
    keys = pa.array([None, *W.signed(model.keys).tolist()], pa.int64())
    yield pa.RecordBatch.from_arrays([keys, pa.array([model.bias, *model.weights.tolist()])], names=["key", "weight"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit in one task on the bounded sample; the driver gets the weights only."""
    known = labels.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    sample = labelled_sample(keyed_text(docs, id_col, text_col), known, FIT_ROWS, FIT_BYTES)
    rows = sample.repartition(1).mapInArrow(_fit_sample, "key bigint, weight double").collect()  # FEATURES + 1 at most
    weights = sorted((np.uint64(r["key"] & 0xFFFFFFFFFFFFFFFF), r["weight"]) for r in rows if r["key"] is not None)
    bias = next((r["weight"] for r in rows if r["key"] is None), Model().bias)
    return Model(np.array([k for k, _ in weights], np.uint64), np.array([w for _, w in weights]), bias)


def score(
    docs: DataFrame, model: Model, offends: float = 0.5, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> DataFrame:
    """(doc_id, score, offending) of every row; ``offending``: byte spans of sentences with their scores.

    With ``carry`` a struct ``carried`` of all columns of ``docs`` comes along.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            data, offsets = W.buffers(batch["text"])
            s = sentences(data, offsets)
            p = shared.value.sentence_scores(*shared.value.incidence(s), len(s.doc))
            bad = np.flatnonzero(p >= offends)
            counts = np.concatenate([[0], np.cumsum(np.bincount(s.doc[bad], minlength=batch.num_rows))])
            rows = pa.StructArray.from_arrays(
                [
                    pa.array((s.begin[bad] - offsets[s.doc[bad]]).astype(np.int32)),
                    pa.array((s.end[bad] - offsets[s.doc[bad]]).astype(np.int32)),
                    pa.array(p[bad]),
                ],
                fields=list(span),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(noisy_or(p, s.doc, batch.num_rows)),
                    pa.ListArray.from_arrays(pa.array(counts, pa.int32()), rows),
                    *([batch["carried"]] if carry else []),
                ],
                names=["doc_id", "score", "offending", *(["carried"] if carry else [])],
            )

    more = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("carried")] if carry else []
    rows = keyed_text(docs, id_col, text_col, *more)
    ddl = "doc_id bigint, score double, offending array<struct<begin:int,end:int,score:double>>"
    return rows.mapInArrow(run, extended(ddl, *([rows.schema["carried"]] if carry else [])))
