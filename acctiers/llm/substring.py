"""Substring dedup: FM-indexes per shard find passages that also start in a document with a smaller id.

A window is ``width`` consecutive words.  To send only what can match, and only where it can match, each
window is represented by its *anchor*: the smallest hash among its ``anchor_words``-grams.  Equal windows
have equal anchors, and consecutive windows with the same anchor travel as one segment.

1. Anchors that occur in one document only are dropped (their windows have no copy).
2. Equal segments of a shared anchor become one row with the smallest doc_id.  Segments are sharded by
   anchor; an anchor with more than ``HOT_ANCHOR`` occurrences is instead cut into single windows, sharded
   by their own content, so no shard grows with a hot passage.
3. Each shard builds a compressed FM-index (wavelet matrix over the BWT) of its segments and streams them
   through it: backward search gives matching statistics, and a match of ``width`` words names an interval
   of suffixes, whose smallest doc_id is looked up.
4. Windows with a smaller owner go back to their documents as spans; covered words are cut out.

Comparison inside a shard is on the words themselves; the way back to the documents joins on the anchor and
a 64-bit hash of a segment's words, which two different segments of one anchor would have to share.  Null and
empty texts, and texts of fewer than ``width`` words, keep all their words.  Rows with a null id keep
theirs and own nothing.  doc_id names a text: rows that repeat an id are one document, and copies under
the same id are not each other's duplicates.  A long text is many segments; nothing depends on its length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctiers.llm import words as W
from acctiers.llm.fmindex import FMIndex
from acctiers.llm.runtime import extended, partitions, stored, temporary

ANCHOR_WORDS = 4
HOT_ANCHOR = 5_000  # occurrences above which an anchor's windows are sharded one by one
RUN_WINDOWS = 32  # windows of one segment at most
SHARD_BYTES = 4 << 20  # input text per shard


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    current, size = x, 1
    while size * 2 <= width:
        current = np.minimum(current[:-size], current[size:])
        size *= 2
    n = len(x) - width + 1
    return np.minimum(current[:n], current[width - size : width - size + n])


def anchor_runs(words: W.Words, width: int, anchor_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first word of the first window, windows, anchor) of runs of windows with one anchor."""
    none = np.empty(0, np.int64)
    n = len(words.starts) - width + 1
    if n <= 0:
        return none, none, none, none.astype(np.uint64)
    least = sliding_min(W.rolling(words.hashes(), anchor_words), width - anchor_words + 1)[:n]
    whole = np.flatnonzero(words.doc[:n] == words.doc[width - 1 : width - 1 + n])
    if not len(whole):
        return none, none, none, none.astype(np.uint64)
    anchor, doc = least[whole], words.doc[whole]
    fresh = np.ones(len(whole), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    heads = np.flatnonzero(fresh)
    inside = np.arange(len(whole)) - np.repeat(heads, np.diff(np.append(heads, len(whole))))
    heads = np.flatnonzero(fresh | (inside % RUN_WINDOWS == 0))
    lengths = np.diff(np.append(heads, len(whole)))
    first = whole[heads] - words.firsts()[doc[heads]]
    return doc[heads], first, lengths, anchor[heads]


def _count_anchors(width: int, anchor_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            doc, _, _, anchor = anchor_runs(W.batch_words(batch), width, anchor_words)
            order = np.lexsort((anchor, doc))
            doc, anchor = doc[order], anchor[order]
            fresh = np.ones(len(doc), bool)
            fresh[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
            heads = np.flatnonzero(fresh)
            counts = np.diff(np.append(heads, len(doc)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(anchor[heads])), pa.array(counts.astype(np.int32))], names=["anchor", "runs"]
            )

    return run


def _place_anchors(width: int, anchor_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            doc, first, _, anchor = anchor_runs(W.batch_words(batch), width, anchor_words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(anchor)), batch["doc_id"].take(pa.array(doc)), pa.array(first.astype(np.int32))],
                names=["anchor", "doc_id", "first"],
            )

    return run


def _cut_segments(width: int, anchor_words: int):
    """Word sequences of the runs listed with each text; runs of hot anchors window by window.

    ``runs`` holds twice the first word of a run, plus one if its anchor is hot.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            words = W.batch_words(batch)
            firsts, hashes, n = words.firsts(), words.hashes(), len(words.starts)
            owner, first, windows, anchor = anchor_runs(words, width, anchor_words)
            listed, coded = W.flat(batch["runs"])
            place = firsts[listed] + (coded >> 1)
            place, coded = place[place < firsts[listed + 1]], coded[place < firsts[listed + 1]]
            marked = np.zeros(n, np.int8)
            marked[place] = 1 + (coded & 1)
            mark = marked[firsts[owner] + first]
            owner, first, windows, anchor, hot = (x[mark > 0] for x in (owner, first, windows, W.signed(anchor), mark == 2))
            copies = np.where(hot, windows, 1)
            shift = np.arange(int(copies.sum())) - np.repeat(np.cumsum(copies) - copies, copies)
            owner, anchor, hot, first, windows = (np.repeat(x, copies) for x in (owner, anchor, hot, first, windows))
            first = first + np.where(hot, shift, 0)
            length = np.where(hot, width, windows + width - 1)
            low = firsts[owner] + first
            own = W.signed(W.rolling(hashes, width))
            if len(own) and hot.any():
                anchor = np.where(hot, own[np.minimum(low, len(own) - 1)], anchor)
            # one text of all words, one space apart, in which every segment is a slice
            spaced, _ = W.respaced(replace(words, doc=np.zeros(n, np.int64)), np.ones(n, bool))
            flat = spaced.tobytes()
            at = np.concatenate([[0], np.cumsum(words.ends - words.starts + 1)])
            texts = [flat[a:b] for a, b in zip(at[low].tolist(), (at[low + length] - 1).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.astype(np.int64)),
                    batch["doc_id"].take(pa.array(owner)),
                    pa.array(first.astype(np.int32)),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["anchor", "doc_id", "first", "words"],
            )

    return run


def symbols_of(words: W.Words) -> tuple[np.ndarray, int]:
    """Numbers of the words from 2 on, equal for equal words; compared byte by byte."""
    size = words.ends - words.starts
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data = words.data[~W.SPACE[words.data]]
    column = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 2, len(coded.dictionary)


def shard_owners(texts: pa.Array, owners: np.ndarray, width: int) -> list[np.ndarray]:
    """For each segment the smallest owner of each of its windows, over all segments of the shard."""
    words = W.split(*W.buffers(texts))
    symbols, _ = symbols_of(words)
    lengths = words.counts()
    # each segment is followed by a separator
    place = np.arange(len(symbols)) + words.doc
    sequences = np.full(len(symbols) + len(lengths), FMIndex.SEPARATOR, np.int64)
    sequences[place] = symbols
    index = FMIndex(sequences, width)
    segment_of = np.repeat(np.arange(len(lengths)), lengths + 1)
    by_suffix = np.append(owners[segment_of], np.iinfo(np.int64).max)[index.suffixes]
    starts = index.groups(width)[:-1]
    smallest = np.minimum.reduceat(by_suffix, starts)
    matched, rank = index.matching_statistics(symbols, lengths)
    owner = np.where(matched >= width, smallest[np.searchsorted(starts, rank, "right") - 1], np.iinfo(np.int64).max)
    firsts = words.firsts()
    return [owner[firsts[i] : firsts[i] + max(0, n - width + 1)] for i, n in enumerate(lengths.tolist())]


def _search_shard(width: int):
    """Owners by window, of the segments that have a copy or a window with a smaller owner than their own."""

    def run(shard: pa.Table) -> pa.Table:
        own, copies = shard["owner"].to_numpy().astype(np.int64), shard["copies"].to_numpy()
        found = shard_owners(shard["words"].combine_chunks(), own, width)
        told = np.array([c > 1 or (f < o).any() for f, o, c in zip(found, own, copies, strict=True)], bool)
        found = [f for f, t in zip(found, told, strict=True) if t]
        counts = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(counts), pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))
        kept = shard.filter(pa.array(told))
        return pa.table({"anchor": kept["anchor"], "key": kept["key"], "owners": lists})

    return run


def duplicate_windows(docs: DataFrame, width: int = 13, anchor_words: int = ANCHOR_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, cuts array<int>): first words of the windows that also start in a smaller doc_id; docs(doc_id, text)."""
    spark = docs.sparkSession
    if not 1 <= anchor_words <= width:
        raise ValueError("anchor_words must be between 1 and width")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(partitions(spark), -(-size // shard_bytes))

    shared = (
        docs.select("text")
        .mapInArrow(_count_anchors(width, anchor_words), "anchor bigint, runs int")
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum("runs").alias("runs"))
        .where("texts > 1")
        .select("anchor", (F.col("runs") > HOT_ANCHOR).alias("hot"))
    )
    placed = docs.mapInArrow(_place_anchors(width, anchor_words), "anchor bigint, doc_id bigint, first int")
    suspects = (
        placed.join(shared, "anchor")
        .groupBy("doc_id")
        .agg(F.collect_list(F.col("first") * 2 + F.col("hot").cast("int")).alias("runs"))  # bounded by the text's length
    )
    # three jobs, so that the shuffle files of one are gone when the next one writes its own
    suspects = stored(suspects, "suspects")
    segments = docs.join(suspects, "doc_id").mapInArrow(
        _cut_segments(width, anchor_words), "anchor bigint, doc_id bigint, first int, words string"
    )
    segments = stored(segments.withColumn("key", F.xxhash64("words")), "segments")
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    owners = (
        segments.groupBy("anchor", "words")
        .agg(F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("copies"))
        .where("owner is not null")
        .select("anchor", F.xxhash64("words").alias("key"), "words", "owner", "copies", shard.alias("shard"))
        .groupBy("shard")
        .applyInArrow(_search_shard(width), "anchor bigint, key bigint, owners array<bigint>")
    )
    flagged = F.filter(
        F.transform("owners", lambda o, i: F.when(o < F.col("doc_id"), i + F.col("first"))), lambda i: i.isNotNull()
    )
    return (
        segments.select("anchor", "key", "doc_id", "first")
        .join(owners, ["anchor", "key"])
        .select("doc_id", flagged.alias("cuts"))
        .where(F.size("cuts") > 0)
        .groupBy("doc_id")
        .agg(F.flatten(F.collect_list("cuts")).alias("cuts"))  # bounded by the text's length
    )


def _remove(width: int, respace: bool, carried: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            words = W.batch_words(batch)
            firsts, n = words.firsts(), len(words.starts)
            owner, first = W.flat(batch["cuts"])
            low = firsts[owner] + first
            low = low[low + width <= firsts[owner + 1]]  # rows may repeat an id with another text
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, low, 1)
            np.add.at(edge, low + width, -1)
            removed = np.cumsum(edge[:n]) > 0
            cut = np.bincount(words.doc[removed], minlength=batch.num_rows)
            texts = W.text_array(*W.respaced(words, ~removed))
            if not respace:
                texts = pc.if_else(pa.array(cut > 0), texts, batch["text"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(words.counts().astype(np.int64)),
                    pa.array(cut.astype(np.int64)),
                    texts,
                    *([batch["carried"]] if carried else []),
                ],
                names=["doc_id", "n_words", "n_removed", "kept", *(["carried"] if carried else [])],
            )

    return run


def remove_repeats(
    docs: DataFrame,
    width: int = 13,
    respace: bool = True,
    carry: Sequence[str | Column] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row, and a struct ``carried`` of the columns ``carry`` of ``docs``.

    ``kept`` holds the words that stay, joined by one space; with ``respace`` off a text without cuts stays as it is.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        *([F.struct(*[F.col(f"`{c}`") if isinstance(c, str) else c for c in carry]).alias("carried")] if carry else []),
    )
    with temporary(docs.sparkSession) as outlive:
        cuts = outlive(duplicate_windows(rows.select("doc_id", "text"), width), "cuts")
    schema = extended("doc_id bigint, n_words bigint, n_removed bigint, kept string", *([rows.schema["carried"]] if carry else []))
    return rows.join(cuts, "doc_id", "left").mapInArrow(_remove(width, respace, bool(carry)), schema)
