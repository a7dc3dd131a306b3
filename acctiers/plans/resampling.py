"""Bootstrap intervals over all rows: Poisson weights from a hash, ranks from vector prefix sums.

A replicate gives every row the weight Poisson(1), read off a hash of (seed, replicate, key).  So weights are
never stored or shuffled: any task makes those of its rows again, and a result does not depend on partitions.

Under the weights of a replicate the place of a value is the weight below it plus half of its own.  Rows are range
partitioned by (value, key) once; each partition sums its weights as a vector over replicates, one small task turns
the partitions' sums into offsets, and each partition then reads off the places of its rows.  A value may fill many
partitions: its run is closed over them by the first and last values of each.

Replicates go in passes of ``PASS``, and a partition holds about ``PART_ROWS`` rows, which bounds a task's memory.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers.operators.rank import sorted_positions
from acctiers.session import freeze

PASS = 250
PART_ROWS = 32_768
U = np.uint64

# Constants of the public splitmix64 generator (fixed values).
STEP, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def poisson_cuts() -> list[int]:
    """64-bit numbers at or above which a hash means a weight of at least 1, 2, ..."""
    cuts, total, term = [], 0.0, math.exp(-1.0)
    for k in range(1, 40):
        total += term
        term /= k
        if total >= 1.0 or int(total * 2.0**64) >= 1 << 64:
            break
        cuts.append(int(total * 2.0**64))
    return cuts


_CUTS = np.array(poisson_cuts(), np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(MIX1)
        x = (x ^ (x >> U(27))) * U(MIX2)
        return x ^ (x >> U(31))


def weights(keys: np.ndarray, first: int, count: int, seed: int) -> np.ndarray:
    """Weights of rows (by key) under replicates first .. first + count - 1, one column each."""
    with np.errstate(over="ignore"):
        base = _mix(keys.astype(np.int64).view(np.uint64) + U(seed) * U(STEP))
        steps = np.arange(first, first + count, dtype=np.uint64) * U(STEP)
        return np.searchsorted(_CUTS, _mix(base[:, None] + steps[None, :]), "right").astype(np.int64)


def _lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), flat)


def _rows(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, width)


def _runs(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


class Side:
    """One value by which rows are ordered: its partitions and their weight sums."""

    def __init__(self, value: str, part: str, counted: str | None):
        self.value, self.part, self.counted = value, part, counted

    def amounts(self, table: pa.Table, w: np.ndarray) -> np.ndarray:
        return w * table[self.counted].to_numpy()[:, None] if self.counted else w

    def sums(self, table: pa.Table, first: int, count: int, seed: int) -> pa.Table:
        """Of one partition: its first and last value, and the weights of all rows, the first and the last run."""
        table = table.sort_by([(self.value, "ascending")])
        values = table[self.value].to_numpy()
        amount = self.amounts(table, weights(table["key"].to_numpy(), first, count, seed))
        begin = _runs(values)
        ends = np.add.reduceat(amount, begin, axis=0)
        return pa.table(
            {
                "part": pa.array([table[self.part][0].as_py()], pa.int64()),
                "low": values[:1],
                "high": values[-1:],
                "whole": _lists(amount.sum(axis=0, keepdims=True)),
                "first": _lists(ends[:1]),
                "last": _lists(ends[-1:]),
            }
        )

    SUMS = "part bigint, low double, high double, whole array<bigint>, first array<bigint>, last array<bigint>"
    OFFSETS = "part bigint, before array<bigint>, first_before array<bigint>, first_total array<bigint>, last_total array<bigint>"

    @staticmethod
    def offsets(table: pa.Table) -> pa.Table:
        """Of all partitions: the weight before each, and before and in the whole first and last runs."""
        table = table.sort_by([("part", "ascending")])
        n = table.num_rows
        width = len(table["whole"][0])
        low, high = table["low"].to_numpy(), table["high"].to_numpy()
        whole, first, last = (_rows(table[c], width) for c in ("whole", "first", "last"))
        before = np.cumsum(whole, axis=0) - whole
        first_before, first_total, last_total = before.copy(), first.copy(), last.copy()
        # a run that came in from the partition before: its start and what it has had so far
        for i in range(1, n):
            if low[i] == high[i - 1]:
                came = last_total[i - 1]
                first_before[i] = before[i] - came
                first_total[i] = first[i] + came
                if low[i] == high[i]:
                    last_total[i] = first_total[i]
        # and what it gets in the partitions after
        for i in range(n - 2, -1, -1):
            if high[i] == low[i + 1]:
                last_total[i] = first_total[i + 1]
                if low[i] == high[i]:
                    first_total[i] = last_total[i]
        columns = {"part": table["part"], "before": before, "first_before": first_before, "first_total": first_total, "last_total": last_total}
        return pa.table({k: v if k == "part" else _lists(v) for k, v in columns.items()})

    def places(self, table: pa.Table, offset: pa.Table, w: np.ndarray) -> np.ndarray:
        """Twice the weight below plus the weight of its own value, for each row of one partition, sorted by value."""
        width = w.shape[1]
        before, first_before, first_total, last_total = (_rows(offset[c], width)[0] for c in ("before", "first_before", "first_total", "last_total"))
        values = table[self.value].to_numpy()
        begin = _runs(values)
        total = np.add.reduceat(self.amounts(table, w), begin, axis=0)
        below = before + np.cumsum(total, axis=0) - total
        below[0] = first_before
        # a single run takes both ends; the first one holds the whole then
        total[-1] = last_total
        total[0] = first_total
        return np.repeat(2 * below + total, np.diff(np.append(begin, len(values))), axis=0)


class Resampler:
    """Rows (key, x, y, label) in the order of x and of y."""

    def __init__(self, rows: DataFrame, key: str, x: str, y: str, label: str | None, iterations: int, seed: int):
        kind = dict(rows.dtypes)[key]
        number = F.col(key).cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(key)
        # one zero: runs of equal values and the order of the partitions must agree
        plain = [(F.col(c).cast("double") + F.lit(0.0)).alias(n) for c, n in ((x, "x"), (y, "y"))]
        mark = (F.col(label) if label else F.lit(0)).cast("bigint").alias("label")
        base = rows.select(number.alias("key"), *plain, mark).where("x is not null and y is not null")
        base = base.withColumn("other", 1 - F.col("label"))
        self.n = base.count()
        self.iterations, self.seed = iterations, seed
        parts = max(1, -(-self.n // PART_ROWS))
        for side in ("x", "y"):
            base = sorted_positions(base, [F.col(side).asc(), F.col("key").asc()], parts).withColumnRenamed("_part", f"part_{side}").drop("_slot", "_index")
        self.rows = freeze(base)

    def passes(self) -> Iterator[tuple[int, int]]:
        for first in range(0, self.iterations if self.n else 0, PASS):
            yield first, min(PASS, self.iterations - first)

    def offsets(self, side: Side, first: int, count: int) -> DataFrame:
        seed = self.seed
        summed = self.rows.groupBy(side.part).applyInArrow(lambda t: side.sums(t, first, count, seed), Side.SUMS)
        # one row per partition of PART_ROWS rows
        return summed.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(Side.offsets, Side.OFFSETS)

    def each(self, side: Side, rows: DataFrame, first: int, count: int, finish: Callable, schema: str) -> DataFrame:
        """``finish(rows, weights, places)`` of every partition of a side."""
        seed = self.seed

        def run(table: pa.Table, offset: pa.Table) -> pa.Table:
            table = table.sort_by([(side.value, "ascending")])
            w = weights(table["key"].to_numpy(), first, count, seed)
            return finish(table, w, side.places(table, offset, w))

        offset = self.offsets(side, first, count)
        return rows.groupBy(side.part).cogroup(offset.groupBy("part")).applyInArrow(run, schema)


def _summed(first: int, **sums: np.ndarray) -> pa.Table:
    count = len(next(iter(sums.values())))
    return pa.table({"replicate": pa.array(np.arange(first, first + count, dtype=np.int32))} | {k: pa.array(v.astype(np.float64)) for k, v in sums.items()})


def spearman_draws(rows: DataFrame, x: str, y: str, key: str, iterations: int, seed: int) -> DataFrame:
    """(replicate, rho): rank correlation under each replicate's weights; null without spread."""
    sample = Resampler(rows, key, x, y, None, iterations, seed)
    of_x, of_y = Side("x", "part_x", None), Side("y", "part_y", None)
    found = None
    for first, count in sample.passes():

        def carry(table: pa.Table, w: np.ndarray, places: np.ndarray) -> pa.Table:
            return pa.table({"part_y": table["part_y"], "key": table["key"], "y": table["y"], "rx": _lists(places)})

        def sums(table: pa.Table, w: np.ndarray, places: np.ndarray, first: int = first, count: int = count) -> pa.Table:
            rx, ry = (p.astype(np.float64) / 2 for p in (_rows(table["rx"], count), places))
            return _summed(
                first, n=w.sum(0), sx=(w * rx).sum(0), sy=(w * ry).sum(0), sxx=(w * rx * rx).sum(0), syy=(w * ry * ry).sum(0), sxy=(w * rx * ry).sum(0)
            )

        carried = sample.each(of_x, sample.rows, first, count, carry, "part_y bigint, key bigint, y double, rx array<bigint>")
        done = sample.each(of_y, carried, first, count, sums, "replicate int, n double, sx double, sy double, sxx double, syy double, sxy double")
        total = done.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
        found = total if found is None else found.unionByName(total)
    if found is None:
        return rows.sparkSession.createDataFrame([], "replicate int, rho double")
    spread = F.sqrt(F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")) * F.sqrt(F.col("syy") - F.col("sy") * F.col("sy") / F.col("n"))
    rho = (F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")) / spread
    return freeze(found.select("replicate", F.when((F.col("n") > 0) & (spread > 0), rho).alias("rho")))


def auc_difference_draws(rows: DataFrame, a: str, b: str, label: str, key: str, iterations: int, seed: int) -> DataFrame:
    """(replicate, diff): AUC(a) - AUC(b) under each replicate's weights; null where a class has no weight."""
    sample = Resampler(rows, key, a, b, label, iterations, seed)
    found = None
    for first, count in sample.passes():
        for side, sign in ((Side("x", "part_x", "other"), 1.0), (Side("y", "part_y", "other"), -1.0)):

            def sums(table: pa.Table, w: np.ndarray, places: np.ndarray, first: int = first, sign: float = sign) -> pa.Table:
                label = table["label"].to_numpy()[:, None]
                once = np.ones(1) if sign > 0 else np.zeros(1)  # the class weights come from the first side alone
                return _summed(first, area=sign * (w * label * places).sum(0) / 2, ones=once * (w * label).sum(0), zeros=once * (w * (1 - label)).sum(0))

            done = sample.each(side, sample.rows, first, count, sums, "replicate int, area double, ones double, zeros double")
            found = done if found is None else found.unionByName(done)
    if found is None:
        return rows.sparkSession.createDataFrame([], "replicate int, diff double")
    total = found.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in ("area", "ones", "zeros")])
    pairs = F.col("ones") * F.col("zeros")
    return freeze(total.select("replicate", F.when(pairs > 0, F.col("area") / pairs).alias("diff")))
