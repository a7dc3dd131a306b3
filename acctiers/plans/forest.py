"""Random forests for several fits at once, from histograms of bins.

Every fit leaves out one fold (or none) and has its own trees.  A tree draws its rows with replacement, a node
draws its features, and a node is cut where the weighted Gini impurity falls most.

* A table of at most GROUP_ROWS rows (23 bytes each) goes whole to every task; a task grows TREES_PER_TASK trees of one
  fit and adds up the scores of the rows the fit leaves out, so neither rows nor scores move once per tree.
* Beyond, a node of more than GROUP_ROWS drawn rows is cut from counts per (node, feature, bin) that tasks sum over the
  whole table; the driver sees a table of fixed size.  The rows of a smaller node go to one task, which grows the rest,
  and the rows that a fit leaves out travel with its nodes and are scored where they end.  Trees are grown in batches of
  about BATCH_ROWS drawn rows, which bounds what one shuffle holds.
* Inside a task rows lie in the order of their nodes, one sum per cell holds both classes, only cells that hold rows are
  judged, and a child that cannot be cut again (one class, too few rows) is closed at once.
* Values become bins of one byte, bin 0 for null and NaN, which count as the median of the fit's rows.
* Draws are hashes of (seed, fit, tree, row or node) and sums are whole numbers, so the trees depend neither on
  partitions, order and retried tasks nor on GROUP_ROWS.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers.plans import boosting
from acctiers.plans.boosting import _doubles, _edges, _square, _to_bins
from acctiers.session import freeze, scratch_path

GROUP_ROWS = 4_000_000
TREES_PER_TASK = 20
BATCH_ROWS = 50_000_000
ROWS_PER_TASK = 50_000
PACKED = "tree int, node bigint, bins binary, label binary, n binary, id binary"
GROWN = "kind string, a bigint, b bigint, value double, body binary"
BLOCK = 32_768  # rows a task looks at together
_ONE = 26  # a drawn row of class 1 counts 1 + 2^26: one sum holds the rows of both classes, up to 2^26 drawn rows
# number of times a row is drawn: Poisson with mean 1
_DRAWS = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


@dataclass(frozen=True)
class Settings:
    numTrees: int = 300
    maxDepth: int = 30
    minInstancesPerNode: int = 5
    bins: int = 32


@dataclass(frozen=True)
class Plan:
    """What a task has to know to grow trees."""

    left_out: list[int]
    fills: np.ndarray  # fits x features: the bin that stands for a missing value
    weights: np.ndarray  # fits x 2: weight of either class
    width: int
    seed: int
    settings: Settings

    def fit(self, tree: int) -> int:
        return tree // self.settings.numTrees

    def salt(self, tree: int, kind: int) -> np.uint64:
        return np.random.default_rng([self.seed, self.fit(tree), tree % self.settings.numTrees, kind]).integers(0, 1 << 63, dtype=np.uint64)

    def drawn(self, key: np.ndarray, tree: int) -> np.ndarray:
        """How often every row is drawn for a tree."""
        return np.searchsorted(_DRAWS, _mix(key.view(np.uint64) ^ self.salt(tree, 0)) / 2.0**64).astype(np.uint8)

    def chosen(self, heap: np.ndarray, tree: int) -> np.ndarray:
        """Features of some nodes: nodes x (root of the feature count)."""
        some = max(1, math.ceil(math.sqrt(self.width)))
        cell = heap.astype(np.uint64)[:, None] * np.uint64(64) + np.arange(self.width, dtype=np.uint64)
        return np.sort(np.argsort(_mix(cell ^ self.salt(tree, 1)), axis=1)[:, :some], axis=1)


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _counts(bins: np.ndarray, label: np.ndarray, n: np.ndarray, place: np.ndarray, chosen: np.ndarray, cuts: int) -> np.ndarray:
    """Drawn rows per (class, node, chosen feature, bin); ``place`` is the node of every row."""
    shape, row = (2, *chosen.shape, cuts), np.arange(len(place))
    total = np.zeros((2, chosen.size * cuts), np.int64)
    one = (n * label).astype(float)
    parts = n - one, one
    for j in range(chosen.shape[1]):
        cell = (place * chosen.shape[1] + j) * cuts + bins[row, chosen[place, j]]
        for kind in (0, 1):
            total[kind] += np.bincount(cell, parts[kind], total.shape[1]).astype(np.int64)
    return total.reshape(shape)


def _cut(counts: np.ndarray, chosen: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Per node: gain (0: no cut), feature, last bin to the left, share of class 1."""
    whole = counts[:, :, 0].sum(2)  # class x node
    left = counts.cumsum(3)
    right = whole[:, :, None, None] - left

    def purity(side: np.ndarray) -> np.ndarray:
        a, b = side[0] * weights[0], side[1] * weights[1]
        return (a * a + b * b) / np.maximum(a + b, 1e-300)

    base = purity(whole)
    gain = purity(left) + purity(right) - base[:, None, None]
    gain[(left.sum(0) < least) | (right.sum(0) < least)] = 0
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(1)
    row = np.arange(len(best))
    gains = flat[row, best]
    gains[gains <= 1e-9 * np.maximum(base, 1)] = 0
    a, b = whole[0] * weights[0], whole[1] * weights[1]
    return gains, chosen[row, best // counts.shape[3]], best % counts.shape[3], b / np.maximum(a + b, 1e-300)


@dataclass
class Nodes:
    """Part of a tree, nodes in the order they were made; an end has no feature (-1) and a share of class 1."""

    heap: np.ndarray
    feature: np.ndarray
    upto: np.ndarray
    left: np.ndarray  # the right child follows it
    share: np.ndarray

    @classmethod
    def start(cls, heap: int) -> Nodes:
        return cls(np.array([heap]), np.array([-1]), np.array([0]), np.array([0]), np.array([np.nan]))

    def split(self, at: np.ndarray, feature: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Give some ends two children each; returns the children."""
        first = len(self.heap) + 2 * np.arange(len(at))
        self.feature[at], self.upto[at], self.left[at] = feature, upto, first
        more, heap = 2 * len(at), self.heap[at]
        self.heap = np.concatenate([self.heap, np.stack([2 * heap + 1, 2 * heap + 2], 1).ravel()])
        self.feature = np.concatenate([self.feature, np.full(more, -1)])
        self.upto, self.left = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (self.upto, self.left))
        self.share = np.concatenate([self.share, np.full(more, np.nan)])
        return np.arange(len(self.heap) - more, len(self.heap))

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The end that every row reaches."""
        ends = self.feature < 0
        # (left child, feature, last bin to the left) in one number; an end leads to itself (bins are below 128)
        node = np.where(ends, np.arange(len(ends)) << 16 | 0xFF, self.left << 16 | self.feature << 8 | self.upto)
        out, width, flat = np.zeros(len(bins), np.int64), bins.shape[1], np.ascontiguousarray(bins).ravel()
        for start in range(0, len(bins), BLOCK):
            rows = np.arange(start, min(start + BLOCK, len(bins)))
            at, first = np.zeros(len(rows), np.int64), rows * width
            while len(rows):
                here = node.take(at)
                after = (here >> 16) + (flat.take(first + (here >> 8 & 0xFF), mode="clip") > (here & 0xFF))
                out[rows] = after
                going = np.flatnonzero(after != at)
                rows, at, first = rows.take(going), after.take(going), first.take(going)
        return out


def _words(bins: np.ndarray) -> np.ndarray:
    """Bins of rows, eight to a word: words x rows, so that rows move as few numbers."""
    wide = np.zeros((len(bins), -(-bins.shape[1] // 8) * 8), np.uint8)
    wide[:, : bins.shape[1]] = bins
    return np.ascontiguousarray(wide.view(np.uint64).T)


def _cuts(words: np.ndarray, amount: np.ndarray, sizes: np.ndarray, whole: np.ndarray, chosen: np.ndarray, weights: np.ndarray, settings: Settings) -> tuple[np.ndarray, ...]:
    """Per node: gain (0: no cut), feature, last bin to the left, amount to the left; as ``_cut`` over all cells.

    ``sizes`` rows of a node follow each other in ``words``.  A cell without rows cuts like the one before it, so it
    is never the first best one and need not be looked at.
    """
    nodes, bins, least, mask = len(sizes), settings.bins, settings.minInstancesPerNode, (1 << _ONE) - 1

    def purity(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
        a, b = zero * weights[0], one * weights[1]
        return (a * a + b * b) / np.maximum(a + b, 1e-300)

    ones, drawn = whole >> _ONE, whole & mask
    base, before = purity(drawn - ones, ones), np.cumsum(whole) - whole
    cell, flat, offset = np.repeat(np.arange(nodes) * bins, sizes), *_bytes(words)
    first = np.arange(words.shape[1]) * 8
    gains, features, uptos, lefts = np.zeros(nodes), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    for j in range(chosen.shape[1]):
        total = np.bincount(cell + flat.take(first + np.repeat(offset(chosen[:, j]), sizes), mode="clip"), amount, nodes * bins)
        some = np.flatnonzero(total)
        node = some // bins
        left = np.cumsum(total[some].astype(np.int64)) - before[node]
        n = left & mask
        fit = np.flatnonzero((n >= least) & (drawn[node] - n >= least))
        if not len(fit):
            continue
        some, node, left, n = some[fit], node[fit], left[fit], n[fit]
        one = left >> _ONE
        zero = n - one
        gain = purity(zero, one) + purity((drawn - ones)[node] - zero, ones[node] - one) - base[node]
        runs = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        most = np.maximum.reduceat(gain, runs)
        hit = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(runs, len(gain)))))
        hit = hit[np.concatenate([[True], node[hit][1:] != node[hit][:-1]])]  # the first of a node
        at = node[hit]
        better = gain[hit] > gains[at]
        hit, at = hit[better], at[better]
        gains[at], features[at], uptos[at], lefts[at] = gain[hit], chosen[at, j], some[hit] % bins, left[hit]
    gains[gains <= 1e-9 * np.maximum(base, 1)] = 0
    return gains, features, uptos, lefts


def _bytes(words: np.ndarray) -> tuple[np.ndarray, Callable]:
    """All bins one by one, and where those of a feature begin; the next row's is 8 further on."""
    rows = words.shape[1]
    return words.view(np.uint8).ravel(), lambda feature: (feature >> 3) * (8 * rows) + (feature & 7)


def _grow(plan: Plan, tree: int, heap: int, bins: np.ndarray, label: np.ndarray, n: np.ndarray) -> tuple[Nodes, np.ndarray]:
    """The tree below a node, level by level, and the gain of each feature's cuts."""
    settings, gains, weights = plan.settings, np.zeros(plan.width), plan.weights[plan.fit(tree)]
    least, mask = settings.minInstancesPerNode, (1 << _ONE) - 1
    nodes, rows = Nodes.start(heap), np.flatnonzero(n)
    words, amount = _words(bins[rows]), n[rows] * (1.0 + label[rows] * float(1 << _ONE))
    depth = int(heap + 1).bit_length() - 1

    def met(ends: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Notes the share of class 1 of new nodes; whether they may be cut again."""
        ones, drawn = whole >> _ONE, whole & mask
        a, b = (drawn - ones) * weights[0], ones * weights[1]
        nodes.share[ends] = b / np.maximum(a + b, 1e-300)
        return (depth < settings.maxDepth) & (drawn >= 2 * least) & (ones > 0) & (ones < drawn)

    whole, sizes, open_ = np.array([int(amount.sum())]), np.array([len(rows)]), np.array([0])
    if not met(open_, whole)[0]:
        return nodes, gains
    while len(open_):
        chosen, ends = plan.chosen(nodes.heap[open_], tree), np.cumsum(sizes)
        parts, start = [], 0
        while start < len(open_):  # some nodes at a time: what is worked on stays near
            row = ends[start] - sizes[start]
            stop = max(start + 1, int(np.searchsorted(ends, row + BLOCK, "right")))
            take = slice(row, ends[stop - 1])
            parts.append(_cuts(np.ascontiguousarray(words[:, take]), amount[take], sizes[start:stop], whole[start:stop], chosen[start:stop], weights, settings))
            start = stop
        gain, feature, upto, left = (np.concatenate(part) for part in zip(*parts, strict=True))
        cut = np.flatnonzero(gain)
        gains += np.bincount(feature[cut], gain[cut], plan.width)
        children = nodes.split(open_[cut], feature[cut], upto[cut])
        depth += 1
        both = np.stack([left[cut], whole[cut] - left[cut]], 1).ravel()
        again = met(children, both)
        sides = np.zeros((2, len(open_)), bool)
        sides[:, cut] = again.reshape(-1, 2).T
        flat, offset = _bytes(words)
        right = flat.take(np.arange(len(amount)) * 8 + np.repeat(offset(feature), sizes), mode="clip") > np.repeat(upto.astype(np.uint8), sizes)
        kept = np.concatenate([np.flatnonzero(side & np.repeat(more, sizes)) for side, more in zip((~right, right), sides, strict=True)])
        starts = ends - sizes
        rights = np.add.reduceat(right.astype(np.int64), starts)
        sizes = np.concatenate([(sizes - rights)[sides[0]], rights[sides[1]]])
        # the children to the left come first, then those to the right
        open_ = np.concatenate([children[0::2][again[0::2]], children[1::2][again[1::2]]])
        whole = np.concatenate([both[0::2][again[0::2]], both[1::2][again[1::2]]])
        words, amount = words.take(kept, axis=1), amount.take(kept)
    return nodes, gains


def _read(batch: pa.RecordBatch, plan: Plan) -> tuple[dict[str, np.ndarray], list[np.ndarray]]:
    """Columns, and the bins as every fit sees them."""
    rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if c != "bins"}
    bins = _square(batch.column("bins"), plan.width)
    return rows, [np.where(bins == 0, fill, bins).astype(np.uint8) for fill in plan.fills]


def _level(plan: Plan, tops: dict[int, Nodes], open_: dict[int, np.ndarray]):
    """Task: counts of the open nodes, numbered in the order of ``open_``, one row per cell that holds rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            rows, bins = _read(batch, plan)
            for tree, ends in open_.items():
                top, fit = tops[tree], plan.fit(tree)
                n = np.where(rows["fold"] == plan.left_out[fit], 0, plan.drawn(rows["key"], tree))
                rank = np.full(len(top.heap), -1)
                rank[ends] = np.arange(len(ends))
                place = rank[top.place(bins[fit])]
                some = np.flatnonzero((place >= 0) & (n > 0))
                found = _counts(bins[fit][some], rows["label"][some], n[some], place[some], plan.chosen(top.heap[ends], tree), plan.settings.bins)
                total[tree] = total.get(tree, 0) + found
        start = 0
        for tree, ends in open_.items():
            if tree in total:
                zero, one = total[tree].reshape(2, -1)
                some = np.flatnonzero(zero + one)
                columns = [pa.array(start + some), pa.array(zero[some]), pa.array(one[some])]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "zero", "one"])
            start += len(ends) * _some(plan) * plan.settings.bins

    return run


def _some(plan: Plan) -> int:
    return plan.chosen(np.array([0]), 0).shape[1]


def _pack(plan: Plan, tops: dict[int, Nodes], every: bool):
    """Task: the rows of every end of the top trees, packed; with ``every`` all rows, to be scored only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, bins = _read(batch, plan)
            for tree, top in tops.items():
                fit = plan.fit(tree)
                out = np.ones(batch.num_rows, bool) if every else rows["fold"] == plan.left_out[fit]
                n = np.zeros(batch.num_rows, np.uint8) if every else np.where(out, 0, plan.drawn(rows["key"], tree)).astype(np.uint8)
                end = top.place(bins[fit])
                done = ~np.isnan(top.share[end])  # nothing left to grow there
                some = np.flatnonzero(out | ((n > 0) & ~done))
                some = some[np.argsort(end[some], kind="stable")]
                cuts = np.flatnonzero(np.diff(end[some])) + 1
                parts = [p for p in np.split(some, cuts) if len(p)]
                label = np.zeros(batch.num_rows, np.uint8) if every else rows["label"].astype(np.uint8)
                columns = [
                    pa.array([tree] * len(parts), pa.int32()),
                    pa.array([int(end[p[0]]) for p in parts], pa.int64()),
                    *[pa.array([x[p].tobytes() for p in parts], pa.binary()) for x in (bins[fit], label, n, rows["id"])],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "bins", "label", "n", "id"])

    return run


def _unpack(packed: pa.Table, width: int) -> list[np.ndarray]:
    bins, label, n, ids = (
        np.frombuffer(b"".join(packed.column(c).to_pylist()), kind)
        for c, kind in (("bins", np.uint8), ("label", np.uint8), ("n", np.uint8), ("id", np.int64))
    )
    return [bins.reshape(-1, width), label, n, ids]


def _finish(plan: Plan, tops: dict[int, Nodes]):
    """Group: grows one end of a top tree and scores the rows left out; the last fit's trees and gains are kept."""

    def run(packed: pa.Table) -> pa.Table:
        tree, end = packed.column("tree")[0].as_py(), packed.column("node")[0].as_py()
        bins, label, n, ids = _unpack(packed, plan.width)
        top, kept = tops[tree], plan.fit(tree) == len(plan.left_out) - 1
        nodes, gains = Nodes.start(int(top.heap[end])), np.zeros(plan.width)
        if np.isnan(top.share[end]):
            nodes, gains = _grow(plan, tree, int(top.heap[end]), bins, label, n)
        else:
            nodes.share[:] = top.share[end]
        held = np.flatnonzero(n == 0)
        score = nodes.share[nodes.place(bins[held])]
        named = np.flatnonzero(gains) if kept else np.array([], np.int64)
        trees, ends = ([tree], [end]) if kept else ([], [])
        parts = [
            ["score"] * len(held) + ["gain"] * len(named) + ["nodes"] * len(trees),
            np.concatenate([ids[held], np.full(len(named), tree), trees]).astype(np.int64),
            np.concatenate([np.zeros(len(held)), named, ends]).astype(np.int64),
            np.concatenate([score, gains[named], np.zeros(len(trees))]),
            [None] * (len(held) + len(named)) + [pickle.dumps(vars(nodes)) for _ in trees],
        ]
        return pa.Table.from_arrays([pa.array(p, f.type) for p, f in zip(parts, _SCHEMA, strict=True)], schema=_SCHEMA)

    return run


def _whole(plan: Plan, pieces: list[range]):
    """Group: grows the trees of a piece over the whole table and adds up the scores of the rows left out."""

    def run(packed: pa.Table) -> pa.Table:
        trees = pieces[packed.column("piece")[0].as_py()]
        fit = plan.fit(trees[0])
        kept = fit == len(plan.left_out) - 1
        rows = boosting.unpacked(packed, plan.width)
        rows["bins"] = np.where(rows["bins"] == 0, plan.fills[fit], rows["bins"]).astype(np.uint8)
        held = np.flatnonzero(rows["fold"] == plan.left_out[fit])
        held = held[np.argsort(rows["id"][held])]  # the same order in all pieces of a fit
        own = np.flatnonzero(rows["fold"] != plan.left_out[fit])
        bins, label, key, left = rows["bins"][own], rows["label"][own], rows["key"][own], rows["bins"][held]
        total, found = np.zeros(len(held)), []
        for tree in trees:
            nodes, gains = _grow(plan, tree, 0, bins, label, plan.drawn(key, tree))
            total += nodes.share[nodes.place(left)]
            if kept:
                found += [("gain", tree, int(j), float(gains[j]), None) for j in np.flatnonzero(gains)]
                found.append(("nodes", tree, 0, 0.0, pickle.dumps(vars(nodes))))
        found.append(("sums", fit, len(trees), 0.0, rows["id"][held].tobytes() + total.tobytes()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)

    return run


def _added(settings: Settings):
    """Group: (id, value) of the rows a fit leaves out, from the sums of its pieces."""

    def run(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(body, np.int64).reshape(2, -1) for body in table.column("body").to_pylist()]
        total = sum(part[1].view(float) for part in parts)
        return pa.table({"id": parts[0][0], "value": total / settings.numTrees})

    return run


_SCHEMA = pa.schema([("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.float64()), ("body", pa.binary())])


def _apply(width: int, tops: dict[int, Nodes]):
    """Cogroup: packed rows of an end with the tree grown below it; an end without one has its share in the top tree."""

    def run(packed: pa.Table, grown: pa.Table) -> pa.Table:
        if not packed.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
        bins, _, _, ids = _unpack(packed, width)
        if not grown.num_rows:
            share = tops[packed.column("tree")[0].as_py()].share[packed.column("node")[0].as_py()]
            return pa.table({"id": ids, "value": np.full(len(ids), share)})
        nodes = Nodes(**pickle.loads(grown.column("body")[0].as_py()))
        return pa.table({"id": ids, "value": nodes.share[nodes.place(bins)]})

    return run


@dataclass
class Forest:
    """The fit on all rows: top trees, and where the trees below them are stored."""

    inputs: list[str]
    edges: list[np.ndarray]
    plan: Plan
    tops: dict[int, Nodes]
    path: str
    gains: np.ndarray  # trees x inputs

    def importances(self) -> np.ndarray:
        """Mean over the trees of a feature's share of the tree's gain."""
        whole = self.gains.sum(1, keepdims=True)
        return (self.gains / np.where(whole > 0, whole, 1)).mean(0)

    def transform(self, df: DataFrame, column: str = "probability") -> DataFrame:
        """``df`` with the probability of class 1."""
        rows = freeze(df.withColumn("id", F.monotonically_increasing_id()))
        coded = _coded(rows.select("id", *_doubles(self.inputs)), "id bigint", self.edges, 1)
        packed = coded.mapInArrow(_pack(self.plan, self.tops, True), PACKED).groupBy("tree", "node")
        grown = df.sparkSession.read.parquet(self.path).select(F.col("a").cast("int").alias("tree"), F.col("b").alias("node"), "body")
        scored = packed.cogroup(grown.groupBy("tree", "node")).applyInArrow(_apply(len(self.inputs), self.tops), "id bigint, value double")
        mean = scored.groupBy("id").agg((F.sum("value") / len(self.tops)).alias(column))
        return rows.join(mean, "id").drop("id")


def _coded(rows: DataFrame, carried: str, edges: list[np.ndarray], count: int) -> DataFrame:
    return rows.mapInArrow(_to_bins(edges, count, None), f"{carried}, bins array<tinyint>")


def fit(
    data: DataFrame, inputs: Sequence[str], left_out: Sequence[int | None], key: str, settings: Settings | None = None, seed: int = 42
) -> tuple[Forest, DataFrame]:
    """A forest per entry of ``left_out`` over ``data`` (key, label 0 or 1, fold from 0, inputs); classes weigh the same.

    Rows without a label are left out.  Returns the last entry's forest and (key, value) with the probability under
    the fit that left the row's fold out; fit i must leave out fold i.
    """
    settings, inputs, spark = settings or Settings(), list(inputs), data.sparkSession
    out = [-1 if f is None else f for f in left_out]
    data = data.where(F.col("label").isNotNull())
    sizes = data.groupBy("fold", "label").count().collect()  # folds x 2
    total = sum(r["count"] for r in sizes)
    rows = data.select(key, F.col("label").cast("double"), F.col("fold").cast("int"), F.xxhash64(key).alias("key"), *_doubles(inputs))
    tasks = max(1, math.ceil(total / ROWS_PER_TASK))
    rows = freeze(rows.repartition(max(tasks, min(total // 1000, spark.sparkContext.defaultParallelism))).withColumn("id", F.monotonically_increasing_id()))
    edges = _edges(rows, inputs, settings.bins)

    medians = [F.percentile_approx(F.when(F.col("fold") != f, F.col(c)), 0.5, F.lit(10_000)) for f in out for c in inputs]
    found = rows.agg(*[m.alias(f"m{i}") for i, m in enumerate(medians)]).first()  # fits x inputs
    fills, weights = np.zeros((len(out), len(inputs)), np.uint8), np.ones((len(out), 2))
    for i, fold in enumerate(out):
        for j in range(len(inputs)):
            m = found[i * len(inputs) + j]
            fills[i, j] = 0 if m is None else 1 + np.searchsorted(edges[j], m, side="left")
        n = [sum(r["count"] for r in sizes if r["fold"] != fold and r["label"] == y) for y in (0, 1)]
        weights[i] = [sum(n) / (sum(x > 0 for x in n) * x) if x else 1.0 for x in n]
    plan = Plan(out, fills, weights, len(inputs), seed, settings)
    state = freeze(_coded(rows.select("id", "label", "fold", "key", *inputs), "id bigint, label double, fold int, key bigint", edges, 4))

    every, path = len(out) * settings.numTrees, scratch_path(spark, "forest")
    first, gains = every - settings.numTrees, np.zeros((settings.numTrees, len(inputs)))
    whole = total <= GROUP_ROWS
    if whole:
        tops = {tree: Nodes.start(0) for tree in range(first, every)}
        fits = [range(i * settings.numTrees, (i + 1) * settings.numTrees) for i in range(len(out))]
        pieces = [trees[start : start + TREES_PER_TASK] for trees in fits for start in range(0, settings.numTrees, TREES_PER_TASK)]
        copies = boosting.dealt(boosting.blocks(state, plan.width, ROWS_PER_TASK), len(pieces), "piece")
        copies.groupBy("piece").applyInArrow(_whole(plan, pieces), GROWN).write.partitionBy("kind").parquet(path)
    else:
        batch, tops = max(1, BATCH_ROWS // max(total, 1)), {}
        for start in range(0, every, batch):
            some = _tops(state, plan, range(start, min(every, start + batch)), total, gains, first)
            packed = state.mapInArrow(_pack(plan, some, False), PACKED)
            packed.groupBy("tree", "node").applyInArrow(_finish(plan, some), GROWN).write.mode("append").partitionBy("kind").parquet(path)
            tops |= {tree: top for tree, top in some.items() if tree >= first}
    grown = spark.read.schema(GROWN).parquet(path)
    for r in grown.where("kind = 'gain'").groupBy("a", "b").agg(F.sum("value").alias("v")).collect():  # trees x inputs
        gains[r["a"] - first, r["b"]] += r["v"]
    if whole:
        mean = grown.where("kind = 'sums'").select("a", "body").groupBy("a").applyInArrow(_added(settings), "id bigint, value double")
    else:
        mean = grown.where("kind = 'score'").groupBy(F.col("a").alias("id")).agg((F.sum("value") / settings.numTrees).alias("value"))
    return Forest(inputs, edges, plan, tops, f"{path}/kind=nodes", gains), rows.select(key, "id").join(mean, "id").drop("id")


def _tops(state: DataFrame, plan: Plan, trees: Sequence[int], total: int, gains: np.ndarray, first: int) -> dict[int, Nodes]:
    """The upper part of some trees: cut until no end holds more than GROUP_ROWS drawn rows."""
    tops, settings = {tree: Nodes.start(0) for tree in trees}, plan.settings
    open_ = {tree: np.array([0]) for tree in trees} if total > GROUP_ROWS else {}
    for depth in range(settings.maxDepth + 1):
        if not open_:
            break
        cells = state.mapInArrow(_level(plan, tops, open_), "cell bigint, zero bigint, one bigint")
        found = cells.groupBy("cell").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one")).toArrow()
        size, start = _some(plan) * settings.bins, 0
        counts = np.zeros((2, sum(map(len, open_.values())) * size), np.int64)
        for kind, name in enumerate(("zero", "one")):
            counts[kind][found["cell"].to_numpy()] = found[name].to_numpy()
        following = {}
        for tree, ends in open_.items():
            top, here = tops[tree], counts[:, start : start + len(ends) * size].reshape(2, len(ends), -1, settings.bins)
            start += len(ends) * size
            chosen = plan.chosen(top.heap[ends], tree)
            gain, feature, upto, share = _cut(here, chosen, plan.weights[plan.fit(tree)], settings.minInstancesPerNode)
            cut = np.flatnonzero(gain) if depth < settings.maxDepth else np.array([], np.int64)
            whole = np.setdiff1d(np.arange(len(ends)), cut)
            top.share[ends[whole]] = share[whole]
            if tree >= first:
                np.add.at(gains[tree - first], feature[cut], gain[cut])
            children = top.split(ends[cut], feature[cut], upto[cut])
            picked = here[:, cut, (feature[cut, None] == chosen[cut]).argmax(1)].cumsum(2)[:, np.arange(len(cut)), upto[cut]].sum(0)
            sizes = np.stack([picked, here[:, cut, 0].sum((0, 2)) - picked], 1).ravel()
            if (sizes > GROUP_ROWS).any():
                following[tree] = children[sizes > GROUP_ROWS]
        open_ = following
    return tops
