"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The different words of a block of text lie one after the other in a flat array of symbols.  A round looks up
the rank of every pair of neighbours, takes the minimum of each word (a segmented reduction), merges in all
words at once every pair of that rank, from the left, and compacts the arrays.  Words without a pair leave
the arrays; the rounds end when none remains.

Words end before a space symbol that follows another character: no piece of a usual vocabulary goes across
such a place.  For a vocabulary that has such a piece a whole text is one word.  A piece whose rank is shared,
or that can be part of a piece of no higher rank, is merged one place at a time, as the order of the merges
then matters; long words with such pieces (runs of thousands of spaces) are finished with a heap.

Models: BPE with byte fallback and without a character map, extra white-space removal or user-defined pieces;
``Vocabulary`` raises ValueError on others.  Null and empty texts have the begin and end ids alone.  A text's
length costs time in proportion; blocks bound the memory of the rounds.  Decoding maps null ids to an empty
text, unknown ids raise an error.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from acctiers.llm import words as W
from acctiers.llm.runtime import keyed_text

SPACE = "\u2581"
BLOCK_CHARS = 1 << 20  # characters of one set of merge rounds, up to the end of a word
HEAP_CHARS = 256  # words above this many symbols whose merges depend on their order go through a heap
NONE = np.iinfo(np.int32).max

# Fixed values of the public model format: field numbers and piece types.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _number(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = raw[at]
        at += 1
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            return value, at


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one message in the protocol-buffer wire format."""
    at = 0
    while at < len(raw):
        key, at = _number(raw, at)
        kind = key & 7
        if kind == 0:
            value, at = _number(raw, at)
        else:
            if kind == 2:
                size, at = _number(raw, at)
            else:
                size = {5: 4, 1: 8}[kind]
            value, at = raw[at : at + size], at + size
        yield key >> 3, value


class Vocabulary:
    """Pieces of one model file and the table of their merges."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(_fields(f.read()))
        trainer = dict(v for k, raw in parts if k == TRAINER for v in _fields(raw))
        normalizer = dict(v for k, raw in parts if k == NORMALIZER for v in _fields(raw))
        self.pieces, self.types, scores = [], [], []
        for k, raw in parts:
            if k == PIECES:
                piece = dict(_fields(raw))
                self.pieces.append(piece.get(1, b"").decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.types.append(piece.get(3, NORMAL))
        # 3: kind (2 is BPE), 35: byte fallback, 24: space as suffix; 2: character map, 3: leading space, 4: fewer spaces, 5: space symbol
        plain = trainer.get(3, 1) == 2 and trainer.get(35, 0) == 1 and not trainer.get(24, 0)
        plain = plain and not normalizer.get(2, b"") and not normalizer.get(4, 1) and normalizer.get(5, 1)
        if not plain or {USER_DEFINED, UNUSED} & set(self.types):
            raise ValueError("only BPE models with byte fallback, plain text and no special pieces are supported")
        self.leading = bool(normalizer.get(3, 1))
        self.bytes = np.zeros(256, np.int32)
        for i, (piece, kind) in enumerate(zip(self.pieces, self.types, strict=True)):
            if kind == BYTE:
                self.bytes[int(piece[3:5], 16)] = i
        self.begin, self.end = (trainer.get(k, default) for k, default in ((41, 1), (42, 2)))
        self._tables(scores)

    def _tables(self, scores: list[float]) -> None:
        ids = {p: i for i, (p, kind) in enumerate(zip(self.pieces, self.types, strict=True)) if kind == NORMAL}
        self.n = n = len(self.pieces)
        # characters that stand in pieces but are none get symbols above the ids; all other ones share the last symbol
        names = {**ids}
        for c in sorted({c for p in ids for c in p}):
            names.setdefault(c, n + len(names) - len(ids))
        self.other = n + len(names) - len(ids)
        self.symbol = np.full(0x110000, self.other, np.int32)
        for name, i in names.items():
            if len(name) == 1:
                self.symbol[ord(name)] = i
        order = np.unique(np.array([-scores[i] for i in ids.values()]), return_inverse=True)[1]
        self.rank = np.full(self.other + 1, NONE, np.int32)
        self.rank[list(ids.values())] = order
        rows = [
            (names[p[:cut]], names[p[cut:]], i) for p, i in ids.items() for cut in range(1, len(p)) if p[:cut] in names and p[cut:] in names
        ]
        left, right, made = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else ((), (), ())))
        self.base = self.other + 1
        keys = left * self.base + right
        by = np.argsort(keys)
        self.keys, self.made = keys[by], made[by].astype(np.int32)
        # pieces whose merges depend on their order
        self.ordered = np.zeros(self.other + 1, bool)
        for side in (left, right):
            self.ordered[side[self.rank[made] <= self.rank[side]]] = True
        sharing = np.bincount(order, minlength=1)
        self.ordered[list(ids.values())] |= sharing[order] > 1
        self.ordered[self.other] = False
        self.cut = not any(SPACE in p.lstrip(SPACE) for p in ids)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        keys = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == keys, self.made[at], -1) if len(self.keys) else np.full(len(keys), -1, np.int32)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(kept positions, their symbols) after all merges; ``word`` numbers the words in rising order."""
        place = np.arange(len(symbols))
        made = np.full(len(symbols), -1, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        made[inner] = self.pairs(symbols[inner], symbols[inner + 1])
        done_places, done_symbols = [], []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(first, len(symbols)))
            rank = np.where(made >= 0, self.rank[made], NONE)
            least = np.repeat(np.minimum.reduceat(rank, first), sizes)
            live = least < NONE
            hit = np.flatnonzero(live & (rank == least))
            # leftmost first: of pairs that overlap every other one; where order matters the first of the word
            run = np.flatnonzero(np.concatenate([[True], hit[1:] != hit[:-1] + 1])) if len(hit) else hit
            along = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
            front = np.concatenate([[True], word[hit][1:] != word[hit][:-1]]) if len(hit) else np.empty(0, bool)
            slow = self.ordered[made[hit]]
            late = slow & front & (np.repeat(sizes, sizes)[hit] > HEAP_CHARS)
            if late.any():
                for w in word[hit[late]]:
                    low, high = np.searchsorted(word, [w, w + 1])
                    kept, finished = self._by_heap(symbols[low:high], made[low:high])
                    done_places.append(place[low:high][kept])
                    done_symbols.append(finished)
                stay = ~np.isin(word, word[hit[late]])
                symbols, word, place, made = symbols[stay], word[stay], place[stay], made[stay]
                continue
            # one slow pair makes its whole word slow
            slow = np.repeat(np.logical_or.reduceat(slow, np.flatnonzero(front)), np.diff(np.append(np.flatnonzero(front), len(hit)))) if len(hit) else slow
            hit = hit[np.where(slow, front, along % 2 == 0)]
            if not len(hit) or live.sum() * 4 < len(live) * 3:
                done_places.append(place[~live])
                done_symbols.append(symbols[~live])
            if not len(hit):
                break
            symbols[hit] = made[hit]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            at = np.cumsum(stay)[hit] - 1
            if live.sum() * 4 < len(live) * 3:
                stay &= live
                at = np.cumsum(stay)[hit] - 1
            symbols, word, place, made = symbols[stay], word[stay], place[stay], made[stay]
            changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
            made[changed] = -1
            inner = changed[changed < len(symbols) - 1]
            inner = inner[word[inner] == word[inner + 1]]
            made[inner] = self.pairs(symbols[inner], symbols[inner + 1])
        place, symbols = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (done_places, done_symbols))
        by = np.argsort(place)
        return place[by], symbols[by]

    def _by_heap(self, symbols: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for one word: the lowest rank first, ties from the left."""
        found, rank, n = symbols.tolist(), self.rank, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(rank[m]), i, m) for i, m in enumerate(made.tolist()) if m >= 0]
        heapify(heap)

        def look(i: int) -> int:
            key = found[i] * self.base + found[after[i]]
            at = int(np.searchsorted(self.keys, key))
            return int(self.made[at]) if at < len(self.keys) and self.keys[at] == key else -1

        known: dict[tuple[int, int], int] = {}
        while heap:
            _, i, m = heappop(heap)
            j = after[i]
            if found[i] < 0 or j >= n or known.setdefault((found[i], found[j]), look(i)) != m:
                continue
            found[i], found[j], after[i] = m, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    pair = found[k], found[after[k]]
                    new = known[pair] if pair in known else known.setdefault(pair, look(k))
                    if new >= 0:
                        heappush(heap, (int(rank[new]), k, new))
        kept = np.array([i for i, s in enumerate(found) if s >= 0])
        return kept, np.array(found, np.int32)[kept]

    def ids(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that start at ``starts`` in an array of code points, and the number of ids of each."""
        word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(points))))
        place, symbols = self.merge(self.symbol[points], word)
        lost = symbols >= self.n
        raw = "".join(map(chr, points[place[lost]])).encode("utf-8", "surrogatepass")
        width = np.ones(len(symbols), np.int64)
        code = points[place[lost]]
        width[lost] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        out = np.repeat(symbols, width)
        out[np.repeat(lost, width)] = self.bytes[np.frombuffer(raw, np.uint8)]
        return out, np.bincount(np.repeat(word[place], width), minlength=len(starts))

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text between the begin and end ids."""
        data, offsets = W.buffers(texts)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]  # in characters
        sizes = np.diff(ends)
        if self.leading:
            points = np.insert(points, ends[:-1][sizes > 0], ord(" "))
            sizes = sizes + (sizes > 0)
        points = np.where(points == 0x20, np.uint32(ord(SPACE)), points)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        begin = np.zeros(len(points) + 1, bool)
        begin[ends] = True
        begin = begin[:-1]
        if self.cut and len(points):
            begin[1:] |= (points[1:] == ord(SPACE)) & (points[:-1] != ord(SPACE))
        starts = np.flatnonzero(begin)
        blocks = [self._block(points, starts, low, high) for low, high in _blocks(starts, len(points))]
        flat = np.concatenate([b[0] for b in blocks]) if blocks else np.empty(0, np.int32)
        upto = np.concatenate([[0], np.cumsum(np.concatenate([b[1] for b in blocks]))]) if blocks else np.zeros(1, np.int64)
        bounds = upto[np.searchsorted(starts, ends)]
        flat = np.insert(flat, np.concatenate([bounds[:-1], bounds[1:]]), np.repeat([self.begin, self.end], len(sizes)))
        lists = bounds + 2 * np.arange(len(bounds))
        # an empty text's end id must follow its begin id, and each end id precede the next begin id
        flat[lists[:-1]], flat[lists[1:] - 1] = self.begin, self.end
        return pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(flat, pa.int32()))

    def _block(self, points: np.ndarray, starts: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and ids per word, of the words low..high, each different word merged once."""
        stop = starts[high] if high < len(starts) else len(points)
        inside = points[starts[low] : stop]
        at = np.append(starts[low:high], stop) - starts[low]
        raw = pa.Array.from_buffers(pa.large_binary(), high - low, [None, pa.py_buffer((at * 4).tobytes()), pa.py_buffer(inside.tobytes())])
        coded = raw.dictionary_encode()
        which = coded.indices.to_numpy().astype(np.int64)
        data, offsets = _flat_bytes(coded.dictionary)
        ids, counts = self.ids(np.frombuffer(data, np.uint32), offsets[:-1] // 4)
        return _gather(ids, counts, which), counts[which]

    def decode(self, lists: pa.Array) -> pa.Array:
        """Texts of lists of ids."""
        row, flat = W.flat(lists)
        if len(flat) and (flat.min() < 0 or flat.max() >= self.n):
            raise ValueError("an id is not in the vocabulary")
        kinds = np.array(self.types)
        surface = [
            b"" if k == CONTROL else bytes([int(p[3:5], 16)]) if k == BYTE else " \u2047 ".encode() if k == UNKNOWN else p.replace(SPACE, " ").encode()
            for p, k in zip(self.pieces, self.types, strict=True)
        ]
        shown = np.flatnonzero(kinds[flat] != CONTROL)
        first = shown[np.concatenate([[True], row[shown][1:] != row[shown][:-1]])] if len(shown) else shown
        spaced = np.array([p.startswith(SPACE) and k == NORMAL for p, k in zip(self.pieces, self.types, strict=True)])
        strip = np.zeros(len(lists), bool)
        if self.leading:
            strip[row[first]] = spaced[flat[first]]
        data, offsets = _flat_bytes(pa.array(surface, pa.large_binary()).take(pa.array(flat)))
        ends = offsets[np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))])]
        raw = data.tobytes()
        # bytes on both sides of a control id are never of one character
        one, two = shown[:-1], shown[1:]
        apart = (row[one] == row[two]) & (two - one > 1) & (kinds[flat[one]] == BYTE) & (kinds[flat[two]] == BYTE)
        cuts: dict[int, list[int]] = {}
        for at in two[apart].tolist():
            cuts.setdefault(int(row[at]), []).append(int(offsets[at]))
        texts = []
        for i, skip in enumerate(strip.tolist()):
            if i in cuts:
                bounds = [ends[i] + skip, *cuts[i], ends[i + 1]]
                texts.append("".join(_mended(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)))
                continue
            part = raw[ends[i] + skip : ends[i + 1]]
            try:
                texts.append(part.decode())
            except UnicodeDecodeError:
                texts.append(_mended(part))
        return pa.array(texts, pa.string())


def _mended(raw: bytes) -> str:
    """Text with one replacement character for each byte that is part of no character."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode())
            out.append("\ufffd")
            at += e.start + 1
    return "".join(out)


def _flat_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large binary array."""
    n = len(values)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + n + 1]
    raw = values.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _gather(values: np.ndarray, counts: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The lists number ``which``, one after the other, of the lists of ``counts`` values."""
    begin, size = (np.cumsum(counts) - counts)[which], counts[which]
    shift = np.repeat(begin - (np.cumsum(size) - size), size)
    return values[np.arange(len(shift)) + shift]


def _blocks(starts: np.ndarray, total: int) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + BLOCK_CHARS)))
        yield low, high
        low = high


_KEPT: dict[str, Vocabulary] = {}  # one vocabulary per worker process, reused by later tasks


def _vocabulary(shared, path: str) -> Vocabulary:
    if path not in _KEPT:
        _KEPT.clear()
        _KEPT[path] = shared.value
    return _KEPT[path]


def encode(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: str | None = None, packed: str | None = None
) -> DataFrame:
    """(doc_id, ids array<int>) of every row, with begin and end ids.

    ``decoded`` names a column for the text decoded from the ids, ``packed`` one for the ids as little-endian
    unsigned 32-bit integers, both from the same pass.  The model is read on the driver and broadcast; its
    size is that of the file.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared, model_path)
        for batch in W.chunks(batches):
            ids = vocabulary.encode(batch["text"])
            columns = {"doc_id": batch["doc_id"], "ids": ids}
            if decoded:
                columns[decoded] = vocabulary.decode(ids)
            if packed:
                raw = pa.py_buffer(ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes())
                columns[packed] = pa.Array.from_buffers(
                    pa.large_binary(), len(ids), [None, pa.py_buffer((ids.offsets.to_numpy().astype(np.int64) * 4).tobytes()), raw]
                ).cast(pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    fields = [T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(decoded, T.StringType())] if decoded else []
    fields += [T.StructField(packed, T.BinaryType())] if packed else []
    return keyed_text(docs, id_col, text_col).mapInArrow(run, T.StructType(fields))


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows of ``encoded`` with the texts of their ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared, model_path)
        for batch in batches:
            out = vocabulary.decode(batch[ids_col])
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, out_col])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())]))
