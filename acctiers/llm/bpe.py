"""Byte-level BPE by prefix dynamic programming.

For a fixed vocabulary the encoding of a byte string ends in one token, and cutting that token off leaves
the encoding of the shorter prefix.  So it is enough to keep, for every prefix, its last token: the one
token that ends there and forms a *valid pair* with the last token of the prefix before it.  A pair is
valid when merging the two tokens' bytes anew gives the two tokens back.

``PrefixEncoder`` keeps that table: appending bytes only adds entries, an edit recomputes entries from the
edit on and stops once they agree with the old ones for as long as the longest token.

``encode``/``decode`` are the DataFrame operators.  Null and empty texts have no ids; very long texts cost
time in proportion to their length; ids that the vocabulary lacks raise an error in ``decode``.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from acctiers.llm import words as W
from acctiers.llm.pieces import Cache, find_all
from acctiers.llm.runtime import keyed_text

CACHED_PIECES = 700_000
CACHED_PAIRS = 1_000_000
CACHED_HEADS = 200_000
HEAD, LEVELS = 2, 6  # bytes by which the heads shared between pieces grow, and how often they do


def read_ranks(path: str) -> list[bytes]:
    """Token bytes in rank order from a tiktoken file."""
    pairs = []
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                pairs.append((int(rank), base64.b64decode(token)))
    pairs.sort()
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must run from 0 without gaps")
    return [t for _, t in pairs]


class BytePairs:
    """A vocabulary whose ids are merge ranks, with the two halves of every token."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens)}
        self.longest = max(map(len, tokens), default=0)
        self.reach: dict[bytes, int] = {}  # length of the longest token by its last three bytes
        for token in tokens:
            if len(token) > self.reach.get(token[-3:], 2):
                self.reach[token[-3:]] = len(token)
        self.halves: list[tuple[int, int]] = []
        self.merged: dict[tuple[int, int], int] = {}
        self._valid: dict[int, bool] = {}
        self._heads: dict[bytes, list[int]] = {}
        for token_id, token in enumerate(tokens):
            self.halves.append(self._halves_of(token_id, token))

    def _halves_of(self, token_id: int, token: bytes) -> tuple[int, int]:
        """The last merge that makes the token: two lower tokens that are neighbours without it."""
        for cut in range(len(token) - 1, 0, -1):
            left, right = self.ids.get(token[:cut], token_id), self.ids.get(token[cut:], token_id)
            if left < token_id and right < token_id and self._neighbours(left, right):
                self.merged[left, right] = token_id
                return left, right
        return -1, -1  # a single byte, or a token that no merge reaches

    def _neighbours(self, left: int, right: int) -> bool:
        """Undo merges at the border, latest first; a merge across it that came earlier breaks the pair."""
        limit, find, halves = len(self.tokens), self.merged.get, self.halves
        while True:
            made = find((left, right))
            if made is not None and made < limit:
                return False
            # the side made by the later merge is undone; at equal ranks the left one was made first
            inner_left, inner_right = halves[left][1], halves[right][0]
            if (left > right and inner_left >= 0) or inner_right < 0:
                if inner_left < 0:
                    return True
                limit, left = left, inner_left
            else:
                limit, right = right + 1, inner_right

    def valid_pair(self, left: int, right: int) -> bool:
        key = left << 24 | right
        known = self._valid.get(key)
        if known is None:
            if len(self._valid) >= CACHED_PAIRS:
                self._valid.clear()
            known = self._valid[key] = self._neighbours(left, right)
        return known

    def last_token(self, data: bytes, end: int, lasts: list[int]) -> int:
        """Last token of the encoding of data[:end], given those of all shorter prefixes."""
        find, known = self.ids.get, self._valid.get
        reach = self.reach.get(data[end - 3 : end], 2) if end > 2 else end
        for start in range(end - reach if end > reach else 0, end):
            token = find(data[start:end])
            if token is not None:
                if not start:
                    return token
                fits = known(lasts[start] << 24 | token)
                if fits or fits is None and self.valid_pair(lasts[start], token):
                    return token
        raise ValueError(f"no token of the vocabulary ends the bytes before {end}")

    def lasts_of(self, head: bytes) -> list[int]:
        """Last tokens of all prefixes of the head of a piece; many pieces begin alike."""
        lasts = self._heads.get(head)
        if lasts is None:
            lasts = list(self.lasts_of(head[:-HEAD])) if head else [-1]
            for end in range(len(lasts), len(head) + 1):
                lasts.append(self.last_token(head, end, lasts))
            if len(self._heads) >= CACHED_HEADS:
                self._heads.clear()
            self._heads[head] = lasts
        return lasts

    def encode(self, data: bytes) -> tuple[int, ...]:
        whole = self.ids.get(data)
        return (whole,) if whole is not None else PrefixEncoder(self, data, min((len(data) - 1) // HEAD, LEVELS) * HEAD).ids()


class PrefixEncoder:
    """A byte string with the last token of each of its prefixes; those of its first ``head`` bytes are looked up."""

    def __init__(self, vocabulary: BytePairs, data: bytes = b"", head: int = 0):
        self.vocabulary, self.data, self.lasts = vocabulary, data[:head], list(vocabulary.lasts_of(data[:head]))
        self.append(data[head:])

    def append(self, more: bytes) -> None:
        begin, self.data = len(self.data), self.data + more
        for end in range(begin + 1, len(self.data) + 1):
            self.lasts.append(self.vocabulary.last_token(self.data, end, self.lasts))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of data[start:stop]; returns how many prefixes were computed anew."""
        old, shift = self.lasts, start + len(new) - stop
        self.data = self.data[:start] + new + self.data[stop:]
        self.lasts = old[: start + 1]
        agreed = done = 0
        for end in range(start + 1, len(self.data) + 1):
            self.lasts.append(self.vocabulary.last_token(self.data, end, self.lasts))
            done += 1
            agreed = agreed + 1 if end - shift > stop and self.lasts[end] == old[end - shift] else 0
            if agreed >= self.vocabulary.longest:
                self.lasts += old[end - shift + 1 :]
                break
        return done

    def ids(self) -> tuple[int, ...]:
        out, end, lengths = [], len(self.data), self.vocabulary.tokens
        while end:
            out.append(self.lasts[end])
            end -= len(lengths[out[-1]])
        return tuple(reversed(out))


_KEPT: dict[tuple, tuple] = {}  # one vocabulary with its caches per worker process, reused by later tasks


def _encoder(tokens: list[bytes], key: tuple) -> tuple[BytePairs, Cache]:
    if key not in _KEPT:
        _KEPT.clear()
        pairs = BytePairs(tokens)
        _KEPT[key] = pairs, Cache(lambda piece: pairs.encode(piece.encode()), CACHED_PIECES)
    return _KEPT[key]


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False
) -> DataFrame:
    """(doc_id, ids array<int>) of every row, with ``keep_text`` the text too (null as empty); each match of
    ``pattern`` is encoded by itself.

    The vocabulary is read on the driver and broadcast; its size is that of the file, not of the data.
    """
    spark: SparkSession = docs.sparkSession
    tokens = read_ranks(ranks_path)
    shared, key = spark.sparkContext.broadcast(tokens), (ranks_path, len(tokens), hash(tuple(tokens[-64:])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cache = _encoder(shared.value, key)
        look = cache.__getitem__
        for batch in W.chunks(batches):
            flat, counts = [], np.zeros(batch.num_rows + 1, np.int64)
            for i, text in enumerate(batch["text"].to_pylist()):
                flat.extend(chain.from_iterable(map(look, find_all(pattern, text))))
                counts[i + 1] = len(flat)
            ids = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.array(np.array(flat, np.int32)))
            more = {"text": batch["text"]} if keep_text else {}
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "ids": ids} | more)

    schema = "doc_id bigint, ids array<int>" + (", text string" if keep_text else "")
    return keyed_text(docs, id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows of ``encoded`` with the bytes of their ids; null ids give no bytes."""
    tokens = read_ranks(ranks_path)
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            lists = batch[ids_col]
            flat = lists.flatten()  # skips what null rows may hold
            counts = np.concatenate([[0], np.cumsum(np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)))]).astype(np.int64)
            taken = table.take(flat)
            ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
            data = taken.buffers()[2] if len(taken) else pa.py_buffer(b"")
            offsets = ends[counts].astype(np.int64)
            out = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(offsets.tobytes()), data]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, out_col])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out_col, T.BinaryType())]))
