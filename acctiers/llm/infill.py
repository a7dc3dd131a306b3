"""Fill-in-the-middle transformation on a piece table.

The texts of a batch and the three sentinels are two immutable byte buffers.  A document is a short list of
descriptors (buffer, start, size) over them: cutting splits a descriptor, an arrangement permutes the cut
pieces and puts sentinel descriptors before them, the inverse permutation brings the pieces back.  Hashes are
streamed descriptor by descriptor; bytes are copied only where an output text is asked for.

Cuts fall between code points and come from the hash of a seed and the document's id, so a row's form does
not depend on the partitioning.  Plain form: empty and null texts, texts that hold a sentinel, null ids
(which have no draw), and the share that is to stay plain.  Rows that repeat an id are cut by the same draws.
Long texts are a chunk of their own; their cost is in proportion to their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from acctiers.llm import words as W
from acctiers.llm.runtime import keyed_text

SENTINELS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle (fixed values)
MARKS = np.frombuffer("".join(SENTINELS).encode(), np.uint8)
TEXT, MARK = 0, 1  # the two buffers
PREFIX, MIDDLE, SUFFIX = 0, 1, 2  # the pieces in the text's own order
MARK_OF = np.array([0, 2, 1])  # sentinel of each piece
# forms by the order of their pieces; the last piece is the middle in both
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
FORMS = ("plain", *ORDERS)


@dataclass
class PieceTable:
    """Descriptors of several documents: row, buffer, start and size, one array each, in document order."""

    buffers: tuple[np.ndarray, np.ndarray]
    n: int
    row: np.ndarray
    buffer: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> PieceTable:
        """One descriptor for each text."""
        data, offsets = W.buffers(texts)
        n = len(offsets) - 1
        return cls((data, MARKS), n, np.arange(n), np.full(n, TEXT), offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64))

    def _with(self, pick: np.ndarray, start: np.ndarray, size: np.ndarray) -> PieceTable:
        return PieceTable(self.buffers, self.n, self.row[pick], self.buffer[pick], start, size)

    def cut(self, which: np.ndarray, at: np.ndarray) -> PieceTable:
        """Descriptor number ``which[i]`` becomes two at byte ``at[i]`` of it; ``which`` has no repeats."""
        copies = np.ones(len(self.row), np.int64)
        copies[which] = 2
        pick = np.repeat(np.arange(len(self.row)), copies)
        start, size = self.start[pick].copy(), self.size[pick].copy()
        second = np.cumsum(copies)[which] - 1
        size[second - 1] = at
        size[second] -= at
        start[second] += at
        return self._with(pick, start, size)

    def permuted(self, order: np.ndarray) -> PieceTable:
        """The descriptors in another order, each row's own ones staying together."""
        return self._with(order, self.start[order], self.size[order])

    def marked(self, sentinel: np.ndarray) -> PieceTable:
        """A sentinel descriptor before every descriptor with a sentinel number of 0 or more."""
        begins = np.cumsum([0, *(len(s.encode()) for s in SENTINELS)])
        copies = 1 + (sentinel >= 0)
        pick = np.repeat(np.arange(len(self.row)), copies)
        table = self._with(pick, self.start[pick].copy(), self.size[pick].copy())
        at = (np.cumsum(copies) - copies)[sentinel >= 0]
        which = sentinel[sentinel >= 0]
        table.buffer[at], table.start[at], table.size[at] = MARK, begins[which], np.diff(begins)[which]
        return table

    def without(self, gone: np.ndarray) -> PieceTable:
        pick = np.flatnonzero(~gone)
        return self._with(pick, self.start[pick], self.size[pick])

    def hashes(self) -> list[str]:
        """sha256 of each row, streamed over its descriptors."""
        views, made = [memoryview(np.ascontiguousarray(b)) for b in self.buffers], [sha256() for _ in range(self.n)]
        for row, buffer, start, size in zip(self.row.tolist(), self.buffer.tolist(), self.start.tolist(), self.size.tolist(), strict=True):
            made[row].update(views[buffer][start : start + size])
        return [m.hexdigest() for m in made]

    def texts(self) -> pa.Array:
        """The rows written out."""
        sizes = np.bincount(self.row, weights=self.size, minlength=self.n).astype(np.int64)
        out, at = np.empty(int(sizes.sum()), np.uint8), 0
        for buffer, start, size in zip(self.buffer.tolist(), self.start.tolist(), self.size.tolist(), strict=True):
            out[at : at + size] = self.buffers[buffer][start : start + size]
            at += size
        return W.text_array(out, np.concatenate([[0], np.cumsum(sizes)]))


def arrange(texts: pa.Array, low: np.ndarray, high: np.ndarray, form: np.ndarray) -> PieceTable:
    """Texts cut at code points ``low`` <= ``high`` and arranged by form (a number in FORMS); plain ones stay whole."""
    table = PieceTable.of(texts)
    data = table.buffers[TEXT]
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(lead, table.start)  # code points before each text
    place = np.append(lead, len(data))
    cut_rows = np.flatnonzero(form > 0)
    second, third = (np.where(x > 0, place[(first + x)], table.start) - table.start for x in (low, high))
    table = table.cut(cut_rows, third[cut_rows])
    whole = np.flatnonzero(np.isin(table.row, cut_rows))[::2]
    table = table.cut(whole, second[table.row[whole]])
    # number of each piece in its text, -1 for the single piece of a plain one
    piece = np.full(len(table.row), -1)
    pieces = np.flatnonzero(form[table.row] > 0)
    piece[pieces] = np.tile([PREFIX, MIDDLE, SUFFIX], len(cut_rows))
    spot = np.zeros((len(FORMS), 3), np.int64)
    for name, order in ORDERS.items():
        spot[FORMS.index(name), list(order)] = range(3)
    order = np.lexsort((np.where(piece >= 0, spot[form[table.row], piece], 0), table.row))
    return table.permuted(order).marked(np.where(piece >= 0, MARK_OF[piece], -1)[order])


def restore_pieces(outputs: pa.Array, form: np.ndarray) -> PieceTable:
    """The table of the original texts, from outputs and forms: cut around the sentinels, inverse order, sentinels left out."""
    table = PieceTable.of(outputs)
    raw = table.buffers[TEXT]
    order = np.array([[MARK_OF[p] for p in ORDERS[f]] if f in ORDERS else [0, 0, 0] for f in FORMS])
    begins = np.cumsum([0, *(len(s.encode()) for s in SENTINELS)])
    data = raw.tobytes()
    for step in range(3):  # the last descriptor of each arranged row is cut before and after its next sentinel
        last = np.flatnonzero(np.append(table.row[1:] != table.row[:-1], True)) if len(table.row) else table.row
        last = last[form[table.row[last]] > 0]
        found, width = [], []
        for start, size, mark in zip(table.start[last].tolist(), table.size[last].tolist(), order[form[table.row[last]], step].tolist(), strict=True):
            at = data.find(MARKS[begins[mark] : begins[mark + 1]].tobytes(), start, start + size)
            if at < 0:
                raise ValueError("a sentinel is missing from an arranged text")
            found.append(at - start)
            width.append(begins[mark + 1] - begins[mark])
        table = table.cut(last, np.array(found, np.int64))
        table = table.cut(last + np.arange(len(last)) + 1, np.array(width, np.int64))
    # rows are now: (empty, mark, piece, mark, piece, mark, piece)
    spread = np.flatnonzero(form[table.row] > 0)
    slot = np.full(len(table.row), -1)
    slot[spread] = np.tile(np.arange(7), len(spread) // 7)
    gone = (slot >= 0) & ((slot == 0) | (slot % 2 == 1))
    pieces = table.without(gone)
    slot = slot[~gone]
    own = np.array([[ORDERS[f][i] for i in range(3)] if f in ORDERS else [0, 0, 0] for f in FORMS])
    return pieces.permuted(np.lexsort((np.where(slot >= 0, own[form[pieces.row], slot // 2 - 1], 0), pieces.row)))


def _draws(doc_ids: list[int | None], seed: int) -> np.ndarray:
    """Four unsigned 32-bit numbers for each id."""
    raw = b"".join(sha256(f"{seed}:{d}".encode()).digest()[:16] for d in doc_ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def _chosen(batch: pa.RecordBatch, seed: int, arranged: int, suffix_first: int) -> tuple[np.ndarray, ...]:
    """(n, low, high, form) of each row: its code points, cuts and form."""
    texts = batch["text"]
    n = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    h = _draws(batch["doc_id"].to_pylist(), seed)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    plain = (n == 0) | (h[:, 2] % 100 >= arranged) | batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
    for mark in SENTINELS:
        plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
    form = np.where(plain, 0, np.where(h[:, 3] % 100 < suffix_first, FORMS.index("spm"), FORMS.index("psm")))
    return n, np.minimum(one, two), np.maximum(one, two), form


def transform(
    docs: DataFrame,
    seed: int = 1,
    arranged: int = 90,
    suffix_first: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: str | None = None,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    ``arranged``: percent of the texts that are arranged; ``suffix_first``: percent of these in the spm form.
    ``digest`` names a column for the sha256 of the output, streamed from the descriptors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            n, low, high, form = _chosen(batch, seed, arranged, suffix_first)
            made, plain = arrange(batch["text"], low, high, form), form == 0
            columns = {
                "doc_id": batch["doc_id"],
                "n": pa.array(n),
                "form": pa.array(np.array(FORMS, object)[form], pa.string()),
                "prefix_chars": pa.array(low, mask=plain),
                "middle_chars": pa.array(high - low, mask=plain),
                "output": made.texts(),
            }
            if digest:
                columns[digest] = pa.array(made.hashes(), pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = T._parse_datatype_string("doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return keyed_text(docs, id_col, text_col).mapInArrow(run, _extended(schema, digest))


def restore(made: DataFrame, text: str | None = "restored", digest: str | None = None, form_col: str = "form", output_col: str = "output") -> DataFrame:
    """The rows of ``made`` with the texts rebuilt from output and form alone.

    ``text`` and ``digest`` name the columns for the text and for its sha256; None leaves one out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches, output_col):
            form = np.array([FORMS.index(f) for f in batch[form_col].to_pylist()], np.int64)
            table = restore_pieces(batch[output_col], form)
            more = ([table.texts()] if text else []) + ([pa.array(table.hashes(), pa.string())] if digest else [])
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *filter(None, (text, digest))])

    return made.mapInArrow(run, _extended(made.schema, text, digest))


def _extended(schema: T.StructType, *names: str | None) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, T.StringType()) for n in names if n)])
