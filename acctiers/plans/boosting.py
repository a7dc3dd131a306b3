"""Gradient-boosted trees for several fits at once, from histograms.

Every fit leaves out one fold (or none).  One pass over the rows serves one tree level of *all* fits: tasks sum
first and second derivatives of the logistic loss per (fit, node, feature, bin), a grouped sum adds the tasks up,
and the driver, which sees a table of fixed size (fits x nodes x features x bins), chooses the splits.  Passes are
rounds x depth however many fits there are.

* Values become bins of one byte, bin 0 for null and NaN; every split learns the side that takes them.
* Derivatives are whole numbers of 1 / SCALE, so sums do not depend on partitions, order or retried tasks.
* The row draw of a tree is a hash of (seed, round, fit, row id), the feature draw a seeded generator.
* Margins are stored every ``keep`` rounds; in between a pass applies the few newest trees itself.
* A table of at most ROWS_IN_ONE_TASK rows goes whole (23 bytes a row) to one task per fit, which takes all passes of
  that fit itself: a job per level would be mostly waiting there.  Sums are exact, so the trees do not depend on the way.
* In such a task the sums of a node's larger child are those of the node less those of the smaller child.
* An empty table, or one class only, gives trees without splits and the class share as probability.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DoubleType, LongType, StructField, StructType

from acctiers.session import freeze

SCALE = float(1 << 30)
ROWS_PER_TASK = 20_000
ROWS_IN_ONE_TASK = 4_000_000  # up to here one task grows all rounds of a fit; the trees are the same either way
BLOCK = 16_384  # rows a task looks at together
PACKED = "id binary, label binary, fold binary, key binary, bins binary"
HIST = "cell int, g bigint, h bigint"


@dataclass(frozen=True)
class Settings:
    rounds: int = 300
    depth: int = 4
    step: float = 0.05
    rows: float = 0.8  # share of the rows drawn for a tree
    features: float = 0.8  # share of the features drawn for a tree
    bins: int = 64
    ridge: float = 1.0  # added to the second derivatives of a node
    least: float = 1.0  # second derivatives a child must hold
    keep: int = 10


@dataclass
class Trees:
    """The trees of one round, one per fit, in heap order: node 0 is the root, 2i+1 and 2i+2 its children."""

    feature: np.ndarray  # fits x (2^depth - 1)
    upto: np.ndarray  # the last bin that goes left
    missing: np.ndarray  # whether bin 0 goes left
    leaf: np.ndarray  # fits x 2^depth

    def place(self, fit: int, bins: np.ndarray, levels: int) -> np.ndarray:
        """Place of every row among the 2^levels nodes of a level."""
        at, first = np.zeros(len(bins), np.int64), np.arange(len(bins)) * bins.shape[1]
        flat = np.ascontiguousarray(bins).ravel()
        for level in range(levels):
            at = 2 * at + self.right(fit, level, flat, first, at)
        return at

    def right(self, fit: int, level: int, flat: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether rows go to the right child of their node; a row's bins begin at ``first`` in ``flat``."""
        here = slice((1 << level) - 1, (2 << level) - 1)
        b = flat.take(first + self.feature[fit, here].take(at), mode="clip")
        return (b > self.upto[fit, here].take(at)) | ((b == 0) & ~self.missing[fit, here].take(at))


def _empty(fits: int, settings: Settings) -> Trees:
    """Trees that send every row to the left."""
    inner, shape = (1 << settings.depth) - 1, (fits, 1 << settings.depth)
    return Trees(
        np.zeros((fits, inner), np.int64), np.full((fits, inner), settings.bins), np.ones((fits, inner), bool), np.zeros(shape)
    )


def _drawn(key: np.ndarray, seed: int, turn: int, fit: int, share: float) -> np.ndarray:
    """Whether a row takes part in a tree: a 64-bit mix of its key, uniform for every (seed, turn, fit)."""
    if share >= 1:
        return np.ones(len(key), bool)
    salt = np.random.default_rng([seed, turn, fit]).integers(0, 1 << 63, dtype=np.uint64)
    x = key.view(np.uint64) ^ salt
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(share * (1 << 64)))


def _chosen(count: int, seed: int, turn: int, fit: int, share: float) -> np.ndarray:
    """Features of a tree."""
    some = max(1, round(share * count))
    return np.sort(np.random.default_rng([seed, turn, fit, 1]).permutation(count)[:some])


def _square(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _flat(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.ravel(), kind))


def _to_bins(edges: list[np.ndarray], carried: int, starts: np.ndarray | None) -> Callable:
    """Task: feature columns, which follow ``carried`` others, become one array of bins (and margins)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, bins = batch.num_rows, np.zeros((batch.num_rows, len(edges)), np.int8)
            for j, cuts in enumerate(edges):
                x = batch.column(carried + j).to_numpy(zero_copy_only=False).astype(float)  # null: nan
                bins[:, j] = np.where(np.isnan(x), 0, 1 + np.searchsorted(cuts, x, side="left"))
            out = [*batch.columns[:carried], _flat(bins, pa.int8())]
            names = [*batch.schema.names[:carried], "bins"]
            if starts is not None:
                out, names = [*out, _flat(np.tile(starts, (n, 1)), pa.float64())], [*names, "margins"]
            yield pa.RecordBatch.from_arrays(out, names)

    return run


def blocks(state: DataFrame, width: int, size: int) -> DataFrame:
    """Rows of ``state`` (id, label 0 or 1, fold, key, bins), ``size`` at most to a packed row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = {"id": np.int64, "label": np.uint8, "fold": np.int32, "key": np.int64}
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(kind) for c, kind in kinds.items()}
            rows["bins"] = _square(batch.column("bins"), width).astype(np.uint8)
            for start in range(0, batch.num_rows, size):
                parts = [pa.array([column[start : start + size].tobytes()], pa.binary()) for column in rows.values()]
                yield pa.RecordBatch.from_arrays(parts, [*rows])

    return state.select("id", "label", "fold", "key", "bins").mapInArrow(run, PACKED)


def unpacked(packed: pa.Table, width: int) -> dict[str, np.ndarray]:
    kinds = {"id": np.int64, "label": np.uint8, "fold": np.int32, "key": np.int64, "bins": np.uint8}
    rows = {c: np.frombuffer(b"".join(packed.column(c).to_pylist()), kind) for c, kind in kinds.items()}
    return rows | {"bins": rows["bins"].reshape(-1, width)}


def dealt(packed: DataFrame, copies: int, name: str) -> DataFrame:
    """A copy of all packed rows for each of ``copies`` numbers, every number in a partition of its own."""
    return packed.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).repartitionByRange(copies, name)


def _advance(trees: list[Trees], settings: Settings, width: int, fits: int) -> Callable:
    """Task: margins after more trees; the other columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("margins")
            margins = _moved(_square(batch.column(at), fits), _square(batch.column("bins"), width), trees, settings)
            yield batch.set_column(at, "margins", _flat(margins, pa.float64()))

    return run


def _moved(margins: np.ndarray, bins: np.ndarray, trees: list[Trees], settings: Settings) -> np.ndarray:
    margins = margins.copy()
    for tree in trees:
        for fit in range(margins.shape[1]):
            margins[:, fit] += tree.leaf[fit][tree.place(fit, bins, settings.depth)]
    return margins


@dataclass(frozen=True)
class Plan:
    """What a task has to know to sum one level of one round."""

    left_out: list[int]
    width: int
    seed: int
    settings: Settings

    def shape(self, level: int) -> tuple[int, ...]:
        return 2, len(self.left_out), 1 << level, self.width, self.settings.bins

    def sums(self, rows: dict[str, np.ndarray], trees: Trees, turn: int, level: int) -> np.ndarray:
        """Derivatives of some rows per (kind, fit, node, feature, bin), in whole numbers of 1 / SCALE."""
        settings, total = self.settings, np.zeros(self.shape(level), np.int64)
        for fit, left_out in enumerate(self.left_out):
            drawn = np.flatnonzero((rows["fold"] != left_out) & _drawn(rows["key"], self.seed, turn, fit, settings.rows))
            bins, columns = rows["bins"][drawn], _chosen(self.width, self.seed, turn, fit, settings.features)
            p = 1.0 / (1.0 + np.exp(-rows["margins"][drawn, fit]))
            node = trees.place(fit, bins, level)
            slopes = [np.rint(slope * SCALE) for slope in (p - rows["label"][drawn], p * (1.0 - p))]
            base, nodes = node * settings.bins, 1 << level
            for j in columns:
                cell = base + bins[:, j]
                for kind in (0, 1):  # sums below 2^53 are exact
                    total[kind, fit, :, j] += np.bincount(cell, slopes[kind], nodes * settings.bins).astype(np.int64).reshape(nodes, -1)
        return total


def _read(batch: pa.RecordBatch | pa.Table, width: int, fits: int) -> dict[str, np.ndarray]:
    rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "fold", "key")}
    return rows | {"bins": _square(batch.column("bins"), width).astype(np.int64), "margins": _square(batch.column("margins"), fits)}


def _histograms(plan: Plan, recent: list[Trees], trees: Trees, turn: int, level: int) -> Callable:
    """Task: one row per cell that holds rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(plan.shape(level), np.int64)
        for batch in batches:
            rows = _read(batch, plan.width, len(plan.left_out))
            rows["margins"] = _moved(rows["margins"], rows["bins"], recent, plan.settings)
            total += plan.sums(rows, trees, turn, level)
        g, h = total.reshape(2, -1)
        some = np.flatnonzero((g != 0) | (h != 0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(g[some]), pa.array(h[some])], ["cell", "g", "h"])

    return run


class _Alone:
    """All rounds of one fit over the rows of a whole table."""

    def __init__(self, plan: Plan, fit: int, start: float, rows: dict[str, np.ndarray]):
        own = np.flatnonzero(rows["fold"] != plan.left_out[fit])
        self.plan, self.fit = plan, fit
        self.bins, self.label, self.key = rows["bins"][own], rows["label"][own].astype(float), rows["key"][own]
        self.flat, self.first = self.bins.ravel(), np.arange(len(own)) * plan.width
        self.columns = np.ascontiguousarray(self.bins.T)
        self.margin = np.full(len(own), start)

    def turn(self, turn: int) -> tuple[Trees, np.ndarray, np.ndarray]:
        settings, plan = self.plan.settings, self.plan
        drawn = np.flatnonzero(_drawn(self.key, plan.seed, turn, self.fit, settings.rows))
        chosen = _chosen(plan.width, plan.seed, turn, self.fit, settings.features)
        p = 1.0 / (1.0 + np.exp(-self.margin[drawn]))
        slopes = np.rint((p - self.label[drawn]) * SCALE), np.rint(p * (1.0 - p) * SCALE)
        at, before = np.zeros(len(self.margin), np.int64), None

        def sums(trees: Trees, level: int) -> np.ndarray:
            nonlocal at, before
            if level:
                at = 2 * at + trees.right(0, level - 1, self.flat, self.first, at)
                node = at.take(drawn)
                size = np.bincount(node, minlength=1 << level).reshape(-1, 2)
                small = size.argmin(1)  # of two children the one with fewer rows is summed
                some = np.flatnonzero((node & 1) == small.take(node >> 1))
                part = self.cells(drawn.take(some), node.take(some) >> 1, chosen, [s.take(some) for s in slopes], 1 << (level - 1))
                total = np.empty((2, 1 << (level - 1), 2, *part.shape[2:]), np.int64)
                for parent, side in enumerate(small):
                    total[:, parent, side], total[:, parent, 1 - side] = part[:, parent], before[:, parent] - part[:, parent]
                before = total.reshape(2, 1 << level, *part.shape[2:])
            else:
                before = self.cells(drawn, None, chosen, slopes, 1)
            return before[:, None]

        found = _grow(plan, turn, sums, [self.fit])
        at = 2 * at + found[0].right(0, settings.depth - 1, self.flat, self.first, at)
        self.margin += found[0].leaf[0].take(at)
        return found

    def cells(self, rows: np.ndarray, node: np.ndarray | None, chosen: np.ndarray, slopes: Sequence[np.ndarray], nodes: int) -> np.ndarray:
        """Sums of the slopes per (kind, node, feature, bin)."""
        bins = self.plan.settings.bins
        total = np.zeros((2, nodes, self.plan.width, bins), np.int64)
        for start in range(0, len(rows), BLOCK):
            here = slice(start, start + BLOCK)
            base, at = 0 if node is None else node[here] * bins, rows[here]
            for j in chosen:
                cell = base + self.columns[j].take(at, mode="clip").astype(np.int64)
                for kind in (0, 1):  # sums of whole numbers below 2^53 are exact
                    total[kind, :, j] += np.bincount(cell, slopes[kind][here], nodes * bins).astype(np.int64).reshape(nodes, bins)
        return total


def _all_rounds(plan: Plan, starts: np.ndarray) -> Callable:
    """Group: all rounds of one fit over a copy of the table; the same sums and splits without a job per level."""

    def run(packed: pa.Table) -> pa.Table:
        fit = packed.column("fit")[0].as_py()
        alone = _Alone(plan, fit, float(starts[fit]), unpacked(packed, plan.width))
        grown = [(vars(found[0]), *found[1:]) for found in map(alone.turn, range(plan.settings.rounds))]
        return pa.table({"fit": pa.array([fit], pa.int32()), "grown": pa.array([pickle.dumps(grown)], pa.binary())})

    return run


@dataclass
class Boosted:
    """Bin edges, starting margins and all trees of every fit."""

    inputs: list[str]
    edges: list[np.ndarray]
    starts: np.ndarray
    settings: Settings
    trees: list[Trees] = field(default_factory=list)
    gain: np.ndarray | None = None  # fits x inputs: gain of all splits on a feature
    splits: np.ndarray | None = None  # fits x inputs: number of splits

    def add(self, trees: Trees, gain: np.ndarray, splits: np.ndarray) -> None:
        self.trees.append(trees)
        self.gain, self.splits = self.gain + gain, self.splits + splits

    def importances(self, fit: int = -1) -> np.ndarray:
        """Mean gain of a feature's splits in one fit (the last is the fit on all rows)."""
        return self.gain[fit] / np.maximum(self.splits[fit], 1)

    def transform(self, df: DataFrame, column: str = "probability", fit: int = -1) -> DataFrame:
        """``df`` with the probability of class 1 under one fit."""
        carry = df.withColumn("_carried", F.struct(*df.columns)).select("_carried", *_doubles(self.inputs))
        schema = StructType([carry.schema["_carried"], StructField("bins", ArrayType(ByteType(), False)), _MARGINS])
        coded = carry.mapInArrow(_to_bins(self.edges, 1, self.starts), schema)
        scored = coded.mapInArrow(_advance(self.trees, self.settings, len(self.inputs), len(self.starts)), schema)
        return scored.select("_carried.*", _probability(fit % len(self.starts)).alias(column))


_MARGINS = StructField("margins", ArrayType(DoubleType(), False))


def _doubles(inputs: Sequence[str]) -> list:
    return [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in inputs]


def _probability(place):
    return 1.0 / (1.0 + F.exp(-F.get("margins", F.lit(place) if isinstance(place, int) else place)))


def _edges(data: DataFrame, inputs: Sequence[str], bins: int) -> list[np.ndarray]:
    """At most ``bins - 2`` cuts per feature, between quantiles of the values of all rows."""
    shares = F.array(*[F.lit(i / (bins - 1)) for i in range(1, bins - 1)])
    found = data.agg(*[F.percentile_approx(c, shares, F.lit(10_000)).alias(f"q{i}") for i, c in enumerate(_doubles(inputs))]).first()
    return [np.unique(np.array(q if q is not None else [], float)) for q in found]


def _best(g: np.ndarray, h: np.ndarray, chosen: np.ndarray, settings: Settings) -> tuple | None:
    """(gain, feature, last bin to the left, missing goes left, g left, h left) of one node; g and h are features x bins."""
    all_g, all_h = g[chosen[0]].sum(), h[chosen[0]].sum()
    base = all_g**2 / (all_h + settings.ridge)
    best = None
    for missing in (True, False):
        below_g, below_h = (x[chosen, 1:].cumsum(1) + (x[chosen, :1] if missing else 0) for x in (g, h))
        above_h = all_h - below_h
        gain = below_g**2 / (below_h + settings.ridge) + (all_g - below_g) ** 2 / (above_h + settings.ridge) - base
        gain[(below_h < settings.least) | (above_h < settings.least)] = -np.inf
        i, b = np.unravel_index(gain.argmax(), gain.shape)
        if gain[i, b] > 1e-9 and (best is None or gain[i, b] > best[0]):
            best = (gain[i, b], chosen[i], b + 1, missing, below_g[i, b], below_h[i, b])
    return best


def fit(
    data: DataFrame, inputs: Sequence[str], left_out: Sequence[int | None], key: str, settings: Settings | None = None, seed: int = 42
) -> tuple[Boosted, DataFrame]:
    """Boosted trees per entry of ``left_out`` over ``data`` (key, label 0 or 1, fold from 0, inputs).

    Rows without a label are left out.  Returns the model and (key, fold, margins), margins holding one value per fit.
    """
    settings, inputs, width = settings or Settings(), list(inputs), len(inputs)
    out = [-1 if f is None else f for f in left_out]
    data = data.where(F.col("label").isNotNull())
    sizes = data.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits")).collect()  # one row per fold
    starts = np.zeros(len(out))
    for i, fold in enumerate(out):
        n, hits = (sum(r[c] for r in sizes if r["fold"] != fold) for c in ("n", "hits"))
        starts[i] = math.log((hits + 1e-6) / (n - hits + 1e-6))
    model = Boosted(inputs, _edges(data, inputs, settings.bins), starts, settings)
    model.gain, model.splits = np.zeros((len(out), width)), np.zeros((len(out), width), np.int64)

    rows = data.select(key, F.col("label").cast("double"), "fold", F.xxhash64(key).alias("key"), *_doubles(inputs))
    kept = [rows.schema[0], StructField("label", DoubleType()), rows.schema["fold"], StructField("key", LongType())]
    schema = StructType([*kept, StructField("bins", ArrayType(ByteType(), False)), _MARGINS])
    tasks = max(1, math.ceil(sum(r["n"] for r in sizes) / ROWS_PER_TASK))
    rows = rows.repartition(tasks)
    state = freeze(rows.mapInArrow(_to_bins(model.edges, 4, starts), schema))

    plan = Plan(out, width, seed, settings)
    if sum(r["n"] for r in sizes) <= ROWS_IN_ONE_TASK:
        copies = dealt(blocks(state.withColumn("id", F.lit(0).cast("bigint")), width, ROWS_PER_TASK), len(out), "fit")
        done = copies.groupBy("fit").applyInArrow(_all_rounds(plan, starts), "fit int, grown binary").collect()  # a row per fit, or none
        grown = [pickle.loads(r["grown"]) for r in sorted(done, key=lambda r: r["fit"])]
        for turn in zip(*grown, strict=True):  # of every fit its tree of a round
            trees = Trees(**{name: np.concatenate([one[0][name] for one in turn]) for name in turn[0][0]})
            model.add(trees, *(np.concatenate([one[i] for one in turn]) for i in (1, 2)))
        state = freeze(state.mapInArrow(_advance(model.trees, settings, width, len(out)), schema))
    else:
        recent: list[Trees] = []
        for turn in range(settings.rounds):
            found = _grow(plan, turn, lambda trees, level, turn=turn: _job(state, plan, list(recent), trees, turn, level, tasks))
            model.add(*found)
            recent.append(found[0])
            if len(recent) == settings.keep or turn == settings.rounds - 1:
                state, recent = freeze(state.mapInArrow(_advance(recent, settings, width, len(out)), schema)), []
    return model, state.select(key, "fold", "margins")


def _job(state: DataFrame, plan: Plan, recent: list[Trees], trees: Trees, turn: int, level: int, tasks: int) -> np.ndarray:
    """Sums of one level over the whole table: a table of fixed size comes to the driver."""
    # a task sends a cell once, so nothing is left to combine before the shuffle
    cells = state.mapInArrow(_histograms(plan, recent, trees, turn, level), HIST).repartition(min(tasks, 64), "cell")
    found = cells.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
    total = np.zeros(plan.shape(level), np.int64)
    for kind, name in enumerate(("g", "h")):
        total[kind].reshape(-1)[found["cell"].to_numpy()] = found[name].to_numpy()
    return total


def _grow(
    plan: Plan, turn: int, sums: Callable[[Trees, int], np.ndarray], which: Sequence[int] | None = None
) -> tuple[Trees, np.ndarray, np.ndarray]:
    """The trees of one round (of some fits), level by level, with the gain and number of splits per fit and feature."""
    which = range(len(plan.left_out)) if which is None else which
    settings, fits = plan.settings, len(which)
    trees = _empty(fits, settings)
    gain, splits = np.zeros((fits, plan.width)), np.zeros((fits, plan.width), np.int64)
    for level in range(settings.depth):
        total, nodes = sums(trees, level) / SCALE, 1 << level
        for fit_at in range(fits):
            chosen = _chosen(plan.width, plan.seed, turn, which[fit_at], settings.features)
            for node in range(nodes):
                here = total[:, fit_at, node]
                found = _best(*here, chosen, settings)
                left = all_ = here[:, chosen[0]].sum(1)
                if found:
                    at = nodes - 1 + node
                    trees.feature[fit_at, at], trees.upto[fit_at, at], trees.missing[fit_at, at] = found[1:4]
                    left = np.array(found[4:])
                    gain[fit_at, found[1]] += found[0]
                    splits[fit_at, found[1]] += 1
                if level == settings.depth - 1:
                    for side, (a, b) in enumerate((left, all_ - left)):
                        trees.leaf[fit_at, 2 * node + side] = -settings.step * a / (b + settings.ridge)
    return trees, gain, splits


def held_out(margins: DataFrame, key: str, name: str) -> DataFrame:
    """(key, probability under the fit that left the row's fold out); fit i must leave out fold i."""
    return margins.select(key, _probability(F.col("fold")).alias(name))
