"""Vectorised word work on Arrow batches of texts: spans, 64-bit hashes, rolling windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
CHUNK_BYTES = 1 << 20  # texts of one vectorised step; a longer text is a step of its own

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True  # separators of the words [^\x20\x09-\x0D]+
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
# separators of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing
PLAIN = np.zeros(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    PLAIN[_low : _high + 1] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


_STEP = U(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
    _BYTE_LOWER = _BYTE[LOWER]
_BASE = U(0xD6E8FEB86659FD93)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
PLACES = 64  # bytes of a block of ``Words.keys``
_PLACED = np.random.default_rng(20_240_229).integers(0, 1 << 64, PLACES * 256, np.uint64)
_PLACED_LOWER = _PLACED.reshape(PLACES, 256)[:, LOWER].ravel()
_POWERS = {False: np.ones(1, np.uint64), True: np.ones(1, np.uint64)}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base ** 0 .. base ** (n-1) modulo 2**64, or of the inverse of the base."""
    if len(_POWERS[inverse]) < n:
        step = np.full(max(n, 1024), _INVERSE if inverse else _BASE)
        step[0] = 1
        with np.errstate(over="ignore"):
            _POWERS[inverse] = np.cumprod(step)
    return _POWERS[inverse][:n]


@dataclass
class Words:
    """Words of several texts.  ``data`` holds their bytes, ``doc`` each word's text number."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def firsts(self) -> np.ndarray:
        """Number of the first word of each text, and the number of words at the end."""
        return np.concatenate([[0], np.cumsum(self.counts())])

    def hashes(self, lower: bool = False) -> np.ndarray:
        out = np.empty(len(self.starts), np.uint64)
        table = _BYTE_LOWER if lower else _BYTE
        lengths = self.ends - self.starts
        edges = np.searchsorted(self.starts, np.arange(CHUNK_BYTES, len(self.data) + CHUNK_BYTES, CHUNK_BYTES))
        low = 0
        for high in [*edges.tolist(), len(out)]:
            high = min(max(high, low), len(out))
            if high > low:
                out[low:high] = self._hash(low, high, lengths[low:high], table)
            low = high
        return out

    def keys(self, lower: bool = False) -> np.ndarray:
        """64-bit hashes that may stand for the words: a random table by place and byte, blocks mixed with their number.

        Unlike the polynomials of ``hashes``, which words of some regular forms share, they have no structure.
        """
        lengths = self.ends - self.starts
        out = np.empty(len(lengths), np.uint64)
        edges = np.searchsorted(self.starts, np.arange(CHUNK_BYTES, len(self.data) + CHUNK_BYTES, CHUNK_BYTES))
        low = 0
        for high in [*edges.tolist(), len(out)]:
            high = min(max(high, low), len(out))
            if high > low:
                out[low:high] = self._keys(low, high, lengths[low:high], _PLACED_LOWER if lower else _PLACED)
            low = high
        return out

    def _keys(self, low: int, high: int, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
        firsts = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum()), dtype=np.int32) - np.repeat(firsts.astype(np.int32), lengths)  # of each byte in its word
        base = self.starts[low]
        data = self.data[base:][place + np.repeat((self.starts[low:high] - base).astype(np.int32), lengths)]
        begins = np.flatnonzero(place % PLACES == 0)
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(table[(place % PLACES) * 256 + data], begins)
            if len(begins) > len(lengths):
                block = place[begins] // PLACES
                sums = np.add.reduceat(mix(sums + block.astype(np.uint64) * _BASE), np.searchsorted(begins, firsts))
            else:
                sums = mix(sums)
            return mix(sums + lengths.astype(np.uint64) * _STEP)

    def _hash(self, low: int, high: int, lengths: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Polynomials of the bytes from prefix sums: one multiplication per byte, one per word."""
        first = self.starts[low]
        starts, ends = self.starts[low:high] - first, self.ends[low:high] - first
        n = int(ends.max())
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(table[self.data[first : first + n]] * powers(n), out=sums[1:])
            return mix((sums[ends] - sums[starts]) * powers(n, inverse=True)[starts] + lengths.astype(np.uint64) * _STEP)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive entries; shorter than the input by k - 1."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    weight = powers(k + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total += hashes[j : j + n] * weight[j + 1]
        return mix(total)


def split(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i+1]]``; no word crosses texts."""
    inside = ~separators[data]
    begins, finishes = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        finishes[:-1] &= ~inside[1:]
        edge = offsets[(offsets > 0) & (offsets < len(data))]
        begins[edge] = inside[edge]
        finishes[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(begins)
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Words(data, offsets, starts, np.flatnonzero(finishes) + 1, doc)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about CHUNK_BYTES of text each."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).cumsum()
        low = 0
        while low < batch.num_rows:
            done = size[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(size, done + CHUNK_BYTES, "right")))
            yield batch.slice(low, high - low)
            low = high


def batch_words(batch: pa.RecordBatch, column: str = "text", separators: np.ndarray = SPACE) -> Words:
    return split(*buffers(batch[column]), separators)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def respaced(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words, one space between the words of a text, and the offsets of the texts."""
    starts, ends, doc = words.starts[keep], words.ends[keep], words.doc[keep]
    size = ends - starts
    gap = np.zeros(len(doc), np.int64)
    gap[:-1] = doc[1:] == doc[:-1]
    edge = np.zeros(len(words.data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1  # words that touch are in different texts; there both marks cancel
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    at = np.concatenate([[0], np.cumsum(size + gap)])
    out = np.full(int(at[-1]), 0x20, np.uint8)
    target = np.ones(int(at[-1]), bool)
    target[(at[1:] - 1)[gap > 0]] = False
    out[target] = words.data[inside]
    counts = np.bincount(doc, minlength=words.n_docs)
    return out, at[np.concatenate([[0], np.cumsum(counts)])]


def text_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A text column from UTF-8 bytes and offsets."""
    where = pa.py_buffer(np.ascontiguousarray(offsets, np.int32))
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, where, pa.py_buffer(np.ascontiguousarray(data))])


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all entries of an integer list column; null lists have none."""
    counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return np.repeat(np.arange(len(lists)), counts), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
