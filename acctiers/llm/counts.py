"""Token counts of a byte-level BPE with word ends, by heap-and-linked-list merging.

A piece starts as one symbol per byte, the last one marked as the word's end.  A heap holds the ranks of
neighbouring pairs, a linked list the symbols still there; the lowest rank is popped again and again, ties
from the left.  The count is the number of symbols less the number of merges; no ids are emitted.

Null and empty texts have no tokens.  The special strings of the vocabulary count as one token each and
separate what stands before and after them.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from acctiers.llm import words as W
from acctiers.llm.pieces import Cache, find_all
from acctiers.llm.runtime import keyed_text

CACHED_PIECES = 700_000


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """Merge table of one tokenizer file: symbols by byte, and (rank, merged symbol) by pair."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        suffix, vocabulary = model["end_of_word_suffix"] or "", model["vocab"]
        self.inner = [vocabulary[s] for s in byte_symbols()]
        self.final = [vocabulary[s + suffix] for s in byte_symbols()]
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocabulary[left] << 24 | vocabulary[right]] = rank, vocabulary[left + right]
        self.pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.special = [t["content"] for t in spec["added_tokens"]]

    def count(self, piece: bytes) -> int:
        """Symbols of the piece after all merges."""
        n = len(piece)
        if n < 2:
            return n
        symbols = [self.inner[b] for b in piece]
        symbols[-1] = self.final[piece[-1]]
        get = self.pairs.get
        heap = [
            found[0] << 40 | i for i in range(n - 1) if (found := get(symbols[i] << 24 | symbols[i + 1])) is not None
        ]
        heapify(heap)
        before, after, merges = list(range(-1, n - 1)), list(range(1, n + 1)), 0
        place = (1 << 40) - 1
        while heap:
            top = heappop(heap)
            i = top & place
            j = after[i]
            if j >= n or symbols[i] < 0:
                continue
            found = get(symbols[i] << 24 | symbols[j])
            if found is None or found[0] != top >> 40:
                continue  # the pair has changed since it was pushed
            symbols[i], symbols[j] = found[1], -1
            after[i] = k = after[j]
            merges += 1
            if k < n:
                before[k] = i
                if (new := get(symbols[i] << 24 | symbols[k])) is not None:
                    heappush(heap, new[0] << 40 | i)
            h = before[i]
            if h >= 0 and (new := get(symbols[h] << 24 | symbols[i])) is not None:
                heappush(heap, new[0] << 40 | h)
        return n - merges


def lowered(text: str) -> str:
    """Composed form in lower case, character by character (no rule for a final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


_KEPT: dict[str, Cache] = {}


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    The merge table is read on the driver and broadcast; its size is that of the file, not of the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Merges(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges: Merges = shared.value
        if tokenizer_path not in _KEPT:
            _KEPT.clear()
            _KEPT[tokenizer_path] = Cache(lambda piece: merges.count(piece.encode()), CACHED_PIECES)
        look = _KEPT[tokenizer_path].__getitem__
        marks = re.compile("|".join(map(re.escape, merges.special))) if merges.special else None

        def total(text: str) -> int:
            if marks is None or not marks.search(text):
                return sum(map(look, find_all(merges.pattern, lowered(text))))
            parts = marks.split(text)
            return len(parts) - 1 + sum(sum(map(look, find_all(merges.pattern, lowered(p)))) for p in parts)

        for batch in W.chunks(batches):
            tokens = np.array([total(t) for t in batch["text"].to_pylist()], np.int64)
            size = np.diff(W.buffers(batch["text"])[1]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
