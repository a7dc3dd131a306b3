"""Importance resampling towards a target distribution, over hashed bags of n-grams.

1. An untrained regex ``Split`` pre-tokenizer cuts the ASCII-lowered text into words with offsets.  Windows of
   the offset pairs are the features (runs of ``sizes`` words, joined by one space); the crc32 of a feature
   picks its bucket.  The buckets of each document are stored once, so texts are tokenised in one pass.
2. Bucket histograms of the documents and of the target give every bucket a gain (1000 x log of the smoothed
   ratio, floored).  A document's weight is the floored mean of its features' gains.
3. A Gumbel draw from the hash of the document's id is added; the highest scores are drawn without
   replacement.  The cut comes from the histogram of scores, the ranks from a range-partitioned order.

Statistics cover all rows.  Null and empty texts have no features and weight 0; texts of fewer than
``min_words`` words are never drawn.  A null id has no draw: its score and rank are null, and it is not among
those drawn from, but its features count.  Rows that repeat an id are drawn one by one, in any order.  Long
texts are cut between words and pre-tokenised in parts.  An empty target or an empty table has no counts;
the gains stay defined.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from acctiers.llm import words as W
from acctiers.llm.pieces import Cache
from acctiers.llm.runtime import keyed_text, partitions, stored
from acctiers.operators.rank import ordinal_rank

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # words of a text whose A-Z are lowered
PART_CHARS = 1 << 18  # characters pre-tokenised at a time
CACHED_WORDS = 500_000


class Featurizer:
    """Buckets of the features of a text."""

    def __init__(self, low: int, high: int, buckets: int):
        if not 1 <= low <= high:
            raise ValueError("sizes must be rising and positive")
        self.low, self.high, self.buckets = low, high, buckets
        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.gap = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
        self.bucket = Cache(lambda feature: crc32(feature.encode()) % buckets, CACHED_WORDS)

    def parts(self, text: str) -> Iterator[tuple[int, str]]:
        """(offset, part) of the text, cut at separators."""
        low = 0
        while low < len(text):
            gap = self.gap.search(text, low + PART_CHARS)
            high = gap.start() if gap else len(text)
            yield low, text[low:high]
            low = high

    def words(self, text: str) -> Iterator[tuple[int, int]]:
        """Offset pairs of the words of a lowered text."""
        for start, part in self.parts(text):
            for _, (a, b) in self.split.pre_tokenize_str(part):
                yield start + a, start + b

    def features(self, text: str) -> tuple[int, list[int]]:
        """(number of words, bucket of every feature)."""
        lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
        look, out = self.bucket.__getitem__, []
        if self.high == 1:
            for _, part in self.parts(lowered):
                out += [look(word) for word, _ in self.split.pre_tokenize_str(part)]
            return len(out), out
        pairs = list(self.words(lowered))
        for size in range(self.low, self.high + 1):
            lasts = islice(pairs, size - 1, None)
            for i, (first, last) in enumerate(zip(pairs, lasts)):  # a window is its first and last offset pair
                run = pairs[i : i + size]
                joined = all(b + 1 == c and lowered[b] == " " for (_, b), (c, _) in zip(run, run[1:]))
                out.append(look(lowered[first[0] : last[1]] if joined else " ".join(lowered[a:b] for a, b in run)))
        return len(pairs), out


def features(docs: DataFrame, sizes: tuple[int, int], buckets: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_words, buckets array<int>) of every row."""
    low, high = sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Featurizer(low, high, buckets)
        for batch in W.chunks(batches):
            counts, flat, ends = [], [], [0]
            for text in batch["text"].to_pylist():
                n, found = made.features(text)
                counts.append(n)
                flat += found
                ends.append(len(flat))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(flat, np.int32)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "n_words": pa.array(counts, pa.int64()), "buckets": lists})

    return keyed_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, n_words bigint, buckets array<int>")


def histogram(found: DataFrame, buckets: int) -> list[int]:
    """Count of every bucket; ``buckets`` numbers, whatever the number of rows."""
    counts = found.select(F.explode("buckets").alias("bucket")).groupBy("bucket").count()
    out = [0] * buckets
    for row in counts.collect():
        out[row["bucket"]] = row["count"]
    return out


def bucket_gains(ours: Sequence[int], target: Sequence[int]) -> list[int]:
    """1000 x log of each bucket's smoothed share in the target over that in our documents, floored."""
    s_all, t_all = float(sum(ours) + len(ours)), float(sum(target) + len(target))
    return [math.floor(1000.0 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(ours, target, strict=True)]


def weighted(found: DataFrame, gains: Sequence[int]) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean of the gains of a row's features, 0 without any."""
    shared = found.sparkSession.sparkContext.broadcast(np.array(gains, np.int64))  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, bucket = W.flat(batch["buckets"])
            n = np.bincount(row, minlength=batch.num_rows)
            total = np.concatenate([[0], np.cumsum(shared.value[bucket])])
            ends = np.cumsum(n)
            weight = (total[ends] - total[ends - n]) // np.maximum(n, 1)
            columns = [batch["doc_id"], batch["n_words"], pa.array(n.astype(np.int64)), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def gumbel(id_col: str, seed: int) -> Column:
    """1000 x a Gumbel draw, floored, from the hash of ``seed`` and the id."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000.0 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame,
    target: DataFrame,
    sizes: tuple[int, int] = (1, 1),
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_id: str = "item_id",
    target_text: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``rank`` is null for rows not drawn."""
    spark = docs.sparkSession
    found = stored(features(docs, sizes, buckets, id_col, text_col), "features")
    goal = features(target.withColumn(target_id, F.lit(None).cast("bigint")), sizes, buckets, target_id, target_text)
    gains = bucket_gains(histogram(found, buckets), histogram(goal, buckets))
    scored = weighted(found, gains).withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    scored = stored(scored, "scores")
    able = F.col("score").isNotNull() & (F.col("n_words") >= min_words)
    # scores are whole numbers between the least and the largest gain plus draw: tens of thousands at any size
    ladder = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    steps = sorted(((r["score"], r["n"]) for r in ladder.collect()), reverse=True)
    draw, above, cut = sum(n for _, n in steps) * percent // 100, 0, None
    for score, n in steps:
        if above >= draw:
            break
        above, cut = above + n, score
    if cut is None:
        return scored.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    drawn = F.coalesce(able & (F.col("score") >= cut), F.lit(False))
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("_row").asc()]  # ``_row`` tells repeated rows apart
    first = scored.where(drawn).withColumn("_row", F.monotonically_increasing_id())
    first = ordinal_rank(first, order, rank="rank", partitions=partitions(spark)).drop("_row")
    first = first.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")).cast("bigint"))
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("bigint"))
    return first.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
