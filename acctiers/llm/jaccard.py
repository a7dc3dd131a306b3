"""N-gram Jaccard join by universe partitioning, exact, with components of the linked documents.

A document's set holds the 64-bit hashes of its distinct word n-grams.  Two sets of sizes s <= t with
similarity at least num/den differ in at most H = (den-num)/(den+num) * (s+t) entries.

*Pigeonhole.*  The universe of hashes is cut into m segments.  Give each segment a weight: 1 if only equal
parts of two sets match there, 2 if parts that differ by one entry match too (one-deletion neighbourhoods).
Segments that do not match hold at least their weight in differences, so weights of more than H in total
leave at least one match.  Schemes are made by size band; a set takes part in the scheme of its own band
and of the band its larger partners may be in, with as many leading segments as its own H asks for.

*Allocation.*  ``allocate`` chooses per band how many segments to use, how many of them get deletion
neighbourhoods, and the slack E: with weights of H + 1 + E at least E + 1 segments match, so a set with at
most E empty segments need not index empty ones, which all small sets share.  A set with more indexes pairs
of its empty segments (for large E each of them), which the partner then does too.  The cost is the number of index entries plus a price for sets
beyond the slack.

*No pairs inside a group.*  Equal sets are one class.  Classes that share an index entry are first compared
with a random class of the entry (a hub), the few hubs they share most entries with; links make components.
In further rounds classes meet hubs of other components, and the few with the nearest sketches (small, and
bounding the difference from below) are compared.  Hubs are drawn evenly, so the close ones also tell how many
pairs have close sketches; rounds go on while these are many and enough of the compared ones link.
Then all pairs of classes that are still in different components and share an entry are compared in full,
sketches first.  Linked sets share several entries of the
larger one's scheme, so that set leaves its most frequent ones out.  So copies cost a
few comparisons each, while no link between components is missed.

Null, empty and wordless texts have empty sets, link with nothing and are their own components; texts of
fewer than n words have one entry, the whole sequence.  doc_id names a text: rows that repeat an id repeat
its text.  Rows with a null id get a null component when nothing smaller is linked.  An n-gram is known by a
64-bit hash of random tables (``Words.keys``): two different ones in one pair of sets of a million entries each
agree with a chance of 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctiers.llm import words as W
from acctiers.llm.components import components
from acctiers.llm.runtime import keyed_text, stored, temporary

U = np.uint64
BAND_RATIO = 1.5
OVERFLOW_PRICE = 1e5  # index entries that one set beyond the slack is worth: such sets are to be very rare
HUBS = 3
FULL_PAIRS = 0.25  # all pairs are compared once about so many per index row have close sketches
SLOW = 0.05  # or once at most this share of the pairs of a round of hubs link
SKETCH = 16  # 64-bit words of a set's sketch
BROADCAST_IDS = 500_000


@dataclass(frozen=True)
class Scheme:
    high: int  # largest size of the band
    segments: int
    paired: int  # leading segments with one-deletion neighbourhoods
    slack: int

    @property
    def together(self) -> int:
        """How many empty segments make an index entry of a set beyond the slack."""
        return 2 if 1 <= self.slack <= 40 else 1

    def used(self, errors: np.ndarray) -> np.ndarray:
        """Leading segments whose weights exceed the errors by 1 + slack."""
        need = errors + 1 + self.slack
        return np.maximum(-(-need // 2), need - self.paired)


def tail(mean: float, k: int) -> float:
    """P(more than k) of a Poisson number."""
    term = total = exp(-mean)
    for i in range(1, k + 1):
        term *= mean / i
        total += term
    return max(0.0, 1.0 - total)


def allocate(low: int, high: int, num: int, den: int) -> Scheme:
    """The cheapest scheme for sets of ``low`` to ``high`` entries."""
    errors = (den - num) * 2 * high // (den + num)
    fewest = (den - num) * 2 * low // (den + num)
    usual = (errors + 1) * exp(-low / (errors + 1))  # empty segments to expect
    slacks = sorted({*range(9), *(int(usual * 1.5 + z * sqrt(usual)) for z in range(2, 12))})
    best, cheapest = None, float("inf")
    for paired in range(min(4, errors + 1)):
        for slack in slacks:
            segments = int(Scheme(high, 0, paired, slack).used(np.array([errors]))[0])
            scheme = Scheme(high, segments, paired, slack)
            own = int(scheme.used(np.array([fewest]))[0])
            empty = (1 - 1 / segments) ** low
            deleted = min(paired, own)
            cost = own + deleted * low / segments + OVERFLOW_PRICE * (tail((own - deleted) * empty, slack) + deleted * empty)
            if cost < cheapest - 1e-9:
                best, cheapest = scheme, cost
    return best


@lru_cache(maxsize=8)
def schemes(num: int, den: int, largest: int) -> tuple[Scheme, ...]:
    out, low = [], 1
    while not out or out[-1].high < largest:
        high = max(low, int(low * BAND_RATIO))
        out.append(allocate(low, high, num, den))
        low = high + 1
    return tuple(out)


@dataclass
class Sets:
    """Distinct n-gram hashes of several texts, by text and in order."""

    doc: np.ndarray
    entry: np.ndarray
    sizes: np.ndarray

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each set."""
        out = []
        for salt in (U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)):
            total = np.zeros(len(self.sizes), np.uint64)
            np.add.at(total, self.doc, W.mix(self.entry ^ salt))
            out.append(W.mix(total))
        return out[0], out[1]


def batch_sets(batch: pa.RecordBatch, n: int) -> Sets:
    words = W.batch_words(batch)
    hashes, counts, firsts = words.keys(lower=True), words.counts(), words.firsts()
    grams = W.rolling(hashes, n)
    whole = words.doc[: len(grams)] == words.doc[n - 1 : n - 1 + len(grams)]
    doc, entry = words.doc[: len(grams)][whole], grams[whole]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        alone = np.array([W.rolling(hashes[firsts[i] : firsts[i + 1]], int(counts[i]))[0] for i in short], np.uint64)
        doc, entry = np.concatenate([doc, short]), np.concatenate([entry, alone])
        order = np.argsort(doc, kind="stable")
        doc, entry = doc[order], entry[order]
    edges = np.searchsorted(doc, np.arange(words.n_docs + 1)).tolist()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        entry[a:b].sort()
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (entry[1:] != entry[:-1])
    doc, entry = doc[fresh], entry[fresh]
    return Sets(doc, entry, np.bincount(doc, minlength=words.n_docs))


def index_entries(sets: Sets, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, index key, least) of every set in its schemes.

    ``least``: how many keys of its own band's scheme a smaller set that links with it shares at least; 0 for
    keys of the next band's scheme.
    """
    table = schemes(num, den, int(sets.sizes.max(initial=1)) * den // num + 1)
    highs = np.array([s.high for s in table])
    largest = sets.sizes * den // num  # partners are at most so large
    starts = sets.starts()
    docs, keys, leasts = [], [], []
    for number, scheme in enumerate(table):
        low = highs[number - 1] + 1 if number else 1
        part = np.flatnonzero((sets.sizes > 0) & (sets.sizes <= scheme.high) & (largest >= low))
        if not len(part):
            continue
        with np.errstate(over="ignore"):
            d, k, hollow = _entries_in(sets, starts, part, scheme, U(number), np.minimum(largest[part], scheme.high), num, den)
        docs.append(d)
        keys.append(k)
        shared = np.zeros(len(sets.sizes), np.int64)
        shared[part] = np.maximum(1, -(-(scheme.slack + 1 - hollow) // (2 if scheme.paired else 1)))
        leasts.append(np.where(sets.sizes[d] >= low, shared[d], 0))
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(docs), np.concatenate(keys), np.concatenate(leasts)


def _entries_in(sets, starts, part, scheme: Scheme, number, partner, num: int, den: int):
    used = scheme.used((den - num) * (sets.sizes[part] + partner) // (den + num))
    used = np.minimum(used, scheme.segments)
    sizes = sets.sizes[part]
    row = np.repeat(np.arange(len(part)), sizes)
    entry = sets.entry[np.arange(len(row)) + np.repeat(starts[part] - np.cumsum(sizes) + sizes, sizes)]
    spread = W.mix(entry ^ W.mix(number + U(77)))
    segment = ((spread >> U(32)) * U(scheme.segments) >> U(32)).astype(np.int64)
    value = W.mix(entry + number * U(0x9E3779B97F4A7C15))
    cell = row * scheme.segments + segment
    total, filled = np.zeros(len(part) * scheme.segments, np.uint64), np.bincount(cell, minlength=len(part) * scheme.segments)
    np.add.at(total, cell, value)
    salt = W.mix((number << U(32)) + np.arange(scheme.segments, dtype=np.uint64) + U(1))
    live = np.arange(scheme.segments)[None, :] < used[:, None]
    full = filled.reshape(live.shape) > 0
    paired = np.arange(scheme.segments)[None, :] < scheme.paired
    emit = np.flatnonzero((live & (full | paired)).ravel())
    docs, keys = [part[emit // scheme.segments]], [W.mix(total[emit] + salt[emit % scheme.segments])]
    if scheme.paired:
        drop = np.flatnonzero((segment < scheme.paired) & (segment < used[row]))
        docs.append(part[row[drop]])
        keys.append(W.mix(total[cell[drop]] - value[drop] + salt[segment[drop]]))
    empty = live & ~full & ~paired
    hollow = empty.sum(axis=1)
    for i in np.flatnonzero(hollow > scheme.slack):
        # any such set that matches here shares more than slack empty segments with this one, so some pair
        groups = list(combinations(np.flatnonzero(empty[i]).tolist(), scheme.together))
        place = W.mix(np.array(groups, np.uint64) + (number << U(40)))
        keys.append(W.mix((place * U(2_654_435_761)).sum(axis=1, dtype=np.uint64) + U(13)))
        docs.append(np.full(len(groups), part[i]))
    return np.concatenate(docs), np.concatenate(keys), hollow


def odd_sketch(sets: Sets) -> np.ndarray:
    """One row of SKETCH 64-bit words per set: the parity of the entries in each of its bits.

    An entry that only one of two sets holds changes one bit, so their sketches differ in at most as many
    bits as the sets in entries.
    """
    mixed = W.mix(sets.entry ^ U(0xA0761D6478BD642F))
    cell = sets.doc * SKETCH + (mixed & U(SKETCH - 1)).astype(np.int64)
    out = np.zeros(len(sets.sizes) * SKETCH, np.uint64)
    np.bitwise_xor.at(out, cell, U(1) << (mixed >> U(58)))
    return out.reshape(-1, SKETCH)


def _describe(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            sets = batch_sets(batch, n)
            one, two = sets.digests()
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sets.sizes.astype(np.int64)), pa.array(W.signed(one)), pa.array(W.signed(two))],
                names=["doc_id", "size", "one", "two"],
            )

    return run


def _index(n: int, num: int, den: int):
    """Index entries; a set seen before in the same task is left to its class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in W.chunks(batches):
            sets = batch_sets(batch, n)
            one, two = sets.digests()
            new = np.zeros(len(one), bool)
            for i, digest in enumerate(zip(one.tolist(), two.tolist(), strict=True)):
                if digest not in seen:
                    seen.add(digest)
                    new[i] = True
            keep = new[sets.doc]
            fresh = Sets(sets.doc[keep], sets.entry[keep], np.where(new, sets.sizes, 0))
            doc, key, least = index_entries(fresh, num, den)
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(key)), batch["doc_id"].take(pa.array(doc)), pa.array(least.astype(np.int32))],
                names=["key", "doc_id", "least"],
            )

    return run


def _entries(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.chunks(batches):
            sets = batch_sets(batch, n)
            offsets = (sets.starts() * 8).astype(np.int32)
            blobs = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(sets.entry.tobytes())])
            bits = pa.FixedSizeListArray.from_arrays(pa.array(W.signed(odd_sketch(sets).ravel())), SKETCH).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], blobs, bits], names=["id", "entries", "sketch"])

    return run


def _verify(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                left, right = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([left, right]))
                same = int((both[1:] == both[:-1]).sum())
                common.append(den * same >= num * (len(left) + len(right) - same) and same > 0)
            keep = pa.array(common, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(keep), batch["b"].filter(keep)], names=["a", "b"])

    return run


class _Join:
    """One run of the join: classes, shared index entries, and comparisons of pairs of classes."""

    def __init__(self, docs: DataFrame, n: int, num: int, den: int):
        self.docs, self.n, self.num, self.den = docs, n, num, den
        described = docs.mapInArrow(_describe(n), "doc_id bigint, size bigint, one bigint, two bigint")
        classes = described.where("size > 0").groupBy("one", "two", "size").agg(F.min("doc_id").alias("class"))
        self.members = stored(
            described.join(classes, ["one", "two", "size"], "left").select(
                "doc_id", "size", F.coalesce("class", "doc_id").alias("class")
            ),
            "members",
        )
        # a null id names no class; as the first row of a set it would keep its copies out of the index
        rows = docs.where("doc_id is not null").mapInArrow(_index(n, num, den), "key bigint, doc_id bigint, least int")
        # a job of its own: its shuffle files are gone when the index is joined
        shared = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("key"), "shared")
        known = self.members.where("doc_id is not null").select("doc_id", "class", "size")
        named = rows.join(shared, "key").join(known, "doc_id").select("key", "class", "size", "least")
        self.rows = stored(named.distinct(), "index")
        ids = self.rows.select(F.col("class").alias("doc_id")).distinct()
        small = ids.count() <= BROADCAST_IDS  # else both sides are shuffled by doc_id
        texts = docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
        sets = texts.mapInArrow(_entries(n), "id bigint, entries binary, sketch array<bigint>")
        self.sets = stored(sets.dropDuplicates(["id"]), "sets")

    def close(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose sketches leave a link possible, and in how many bits these differ (``apart``)."""
        size = F.octet_length("entries") / 8
        light = self.sets.select("id", "sketch", size.alias("size"))
        one, two = (light.select(F.col("id").alias(i), F.col("sketch").alias(k), F.col("size").alias(n)) for i, k, n in (("a", "x", "s"), ("b", "y", "t")))
        apart = sum(F.bit_count(F.col("x")[i].bitwiseXOR(F.col("y")[i])) for i in range(SKETCH))
        met = pairs.join(one, "a").join(two, "b").withColumn("apart", apart)
        return met.where(F.col("apart") * (self.den + self.num) <= (F.col("s") + F.col("t")) * (self.den - self.num)).drop("x", "y", "s", "t")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that link."""
        one, two = (self.sets.select(F.col("id").alias(i), F.col("entries").alias(e)) for i, e in (("a", "x"), ("b", "y")))
        return pairs.select("a", "b").join(one, "a").join(two, "b").mapInArrow(_verify(self.num, self.den), "a bigint, b bigint")

    def similar_sizes(self, one, two):
        return self.den * F.least(one, two) >= self.num * F.greatest(one, two)

    def met(self, rows: DataFrame, salt: int) -> DataFrame:
        """Each class with the hubs of its keys, as pairs (a, b); with components known, hubs of other ones.

        ``entries`` counts the keys where they meet, ``classes`` the classes of these keys.
        """
        order = F.xxhash64(F.lit(salt), "class", "key")
        known = [c for c in ("component",) if c in rows.columns]
        hubs = rows.groupBy("key").agg(
            F.min_by("class", order).alias("hub"),
            F.min_by("size", order).alias("hub_size"),
            F.count(F.lit(1)).alias("classes"),
            *[F.min_by(c, order).alias(f"hub_{c}") for c in known],
        )
        apart = [F.col(c) != F.col(f"hub_{c}") for c in known] or [F.col("class") != F.col("hub")]
        return (
            rows.join(hubs.where("classes > 1"), "key")
            .where(apart[0] & self.similar_sizes("size", "hub_size"))
            .groupBy("class", "hub")
            .agg(F.count(F.lit(1)).alias("entries"), F.sum("classes").alias("classes"))
            .select("*", F.least("class", "hub").alias("a"), F.greatest("class", "hub").alias("b"))
        )

    def best(self, met: DataFrame, *order) -> DataFrame:
        """Pairs of each class with its first few hubs."""
        best = Window.partitionBy("class").orderBy(*order, "hub")
        top = met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= HUBS)
        return top.select("a", "b").distinct()

    def divided(self, labels: DataFrame) -> DataFrame:
        """Index rows of the keys that still meet several components, with each class's component."""
        rows = self.rows.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))
        several = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        return rows.join(several.select("key"), "key")

    def labels(self) -> DataFrame:
        """(class, component) of the classes that link, but for the smallest of each component."""
        spark = self.docs.sparkSession
        tested = stored(self.best(self.met(self.rows, 0), F.desc("entries")), "pairs")
        labels = components(self.linked(self.close(tested))).withColumnRenamed("node", "class")
        for salt in range(1, 100):
            with temporary(spark) as outlive:  # a round leaves the pairs it tested and the labels
                rows = stored(self.divided(labels), "divided")
                size = rows.count()
                if not size:
                    return labels
                close = stored(self.close(self.met(rows, salt)).select("class", "hub", "a", "b", "classes", "apart"), "close")
                # a hub stands for all classes of its key: about twice the rows that the join of all pairs would make
                if close.agg(F.coalesce(F.sum("classes"), F.lit(0))).first()[0] <= 2 * FULL_PAIRS * size:
                    break
                pairs = outlive(self.best(close.join(tested, ["a", "b"], "left_anti"), "apart"), "pairs")
                more = stored(self.linked(pairs), "links")
                tested = tested.union(pairs)
                few = more.count() <= SLOW * pairs.count()
                labels = outlive(self.merged(labels, more), "labels")
            if few:
                break
        # sketches come in once, for the rows that are left
        bits = [F.col("sketch")[i].alias(f"b{i}") for i in range(SKETCH)]
        rows = stored(self.divided(labels).join(self.sets.select(F.col("id").alias("class"), *bits), "class"), "divided")
        apart = sum(F.bit_count(F.col(f"b{i}1").bitwiseXOR(F.col(f"b{i}2"))) for i in range(SKETCH))
        # the larger set of a pair looks with its own band's keys, all but the least - 1 most frequent ones
        usual = rows.join(rows.groupBy("key").agg(F.count(F.lit(1)).alias("met")), "key").where("least > 0")
        rarest = Window.partitionBy("class").orderBy("met", "key")
        looking = (
            usual.withColumn("place", F.row_number().over(rarest))
            .withColumn("own", F.count(F.lit(1)).over(Window.partitionBy("class")))
            .where(F.col("place") <= F.col("own") - F.col("least") + 1)
        )
        columns = ("class", "size", "component", *[f"b{i}" for i in range(SKETCH)])
        large, small = (df.select("key", *[F.col(c).alias(c + i) for c in columns]) for df, i in ((looking, "1"), (rows, "2")))
        ordered = (F.col("size1") > F.col("size2")) | ((F.col("size1") == F.col("size2")) & (F.col("class1") < F.col("class2")))
        pairs = (
            large.join(small, "key")
            .where(ordered & (F.col("component1") != F.col("component2")) & self.similar_sizes("size1", "size2"))
            .where(apart * (self.den + self.num) <= (F.col("size1") + F.col("size2")) * (self.den - self.num))
            .select(F.least("class1", "class2").alias("a"), F.greatest("class1", "class2").alias("b"))
            .distinct()
            .join(tested, ["a", "b"], "left_anti")
        )
        return self.merged(labels, self.linked(stored(pairs, "pairs")))

    def merged(self, labels: DataFrame, links: DataFrame) -> DataFrame:
        """Labels after more links."""
        edges = labels.select(F.col("class").alias("a"), F.col("component").alias("b")).union(links)
        return components(edges).withColumnRenamed("node", "class")


def linked_components(
    docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every row.

    Documents link when den * intersection >= num * union of their sets of n-grams.  ``class_id`` is the
    smallest doc_id with an equal set, ``component_id`` the smallest one reachable by links.
    """
    if not 0 < num <= den:
        raise ValueError("the threshold num/den must be in (0, 1]")
    with temporary(docs.sparkSession) as outlive:
        run = _Join(keyed_text(docs, id_col, text_col), n, num, den)
        found = run.members.join(run.labels(), "class", "left").select(
            "doc_id",
            F.col("size").alias("n_shingles"),
            F.col("class").alias("class_id"),
            F.coalesce("component", "class").alias("component_id"),
        )
        return outlive(found, "components")
