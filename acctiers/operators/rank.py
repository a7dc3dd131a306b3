"""Whole-table ranks, prefix sums and exact quantiles without a single-task window.

``rank()`` over an unpartitioned window moves a table into one task.  Everything here rests on two shapes
that work alike at every size:

* **ladder** - equal values fold to one row with their count (in the map step first, so a value that fills
  a third of the table costs one row per task), and the ladder's rows get running counts.  Average ranks
  and exact quantiles are read off the ladder.
* **running totals** - a range partitioned sort on a unique key, then offset of the partition + position
  inside it.  Ties are split by a tie-break column, so equal leading values spread over tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctiers.functions.exprs import linear_interpolation
from acctiers.session import freeze

_STRIDE = 16


def _ladder(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """(by, _v, _n, _upto, _start, _total): counts of each value, running counts, and the group's range of them."""
    names = [f"_by{i}" for i in range(len(by))]
    keys = [F.col(c).alias(n) for c, n in zip(by, names, strict=True)]
    counts = df.select(*keys, F.col(value).cast("double").alias("_v")).groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(counts, [*[F.col(n).asc() for n in names], F.col("_v").asc()], "_n", "_place", "_upto", "_all")
    if not names:
        return upto.select("_v", "_n", "_upto", F.lit(0).alias("_start"), F.col("_all").alias("_total"))
    spans = upto.groupBy(*names).agg(F.min(F.col("_upto") - F.col("_n")).alias("_start"), F.sum("_n").alias("_total"))
    # one row per group; callers group by columns with few distinct values
    spans = spans.select(*[F.col(n).alias(f"{n}g") for n in names], "_start", "_total")
    same = [upto[n].eqNullSafe(spans[f"{n}g"]) for n in names]
    joined = upto.join(F.broadcast(spans), same)
    return joined.select(*[F.col(n) for n in names], "_v", "_n", "_upto", "_start", "_total")


def average_rank(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    rank: str = "rank",
    total: str | None = None,
    method: str = "average",
) -> DataFrame:
    """Add the rank (1 = smallest) of a non-null numeric column; ties share the mean of their places,
    or the lowest of them with ``method="min"``.

    ``by`` names grouping columns with few distinct values (a feature name, a tier pair);
    ``total`` adds the group's row count.  ``df`` is read twice, so pass a table that is cheap to read.
    """
    by, columns = list(by), df.columns
    steps = _ladder(df, value, by)
    share = 0.5 if method == "average" else 0.0
    first = F.col("_upto") - F.col("_n") - F.col("_start") + 1
    steps = steps.select(
        *[F.col(f"_by{i}") for i in range(len(by))],
        "_v",
        (first + (F.col("_n") - 1) * F.lit(share)).alias("_rank"),
        F.col("_total").cast("bigint").alias("_size"),
    )
    # a hot value is one row of the ladder; its rows are split by the skew-join setting of the session
    keyed = df.withColumns({"_v": F.col(value).cast("double")} | {f"_by{i}": F.col(c) for i, c in enumerate(by)})
    same = [keyed["_v"].eqNullSafe(steps["_v"]), *[keyed[f"_by{i}"].eqNullSafe(steps[f"_by{i}"]) for i in range(len(by))]]
    extra = [steps["_size"].alias(total)] if total else []
    return keyed.join(steps, same).select(*[keyed[c] for c in columns], steps["_rank"].alias(rank), *extra)


def percent_rank_average(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "pct", **kw) -> DataFrame:
    """Average rank divided by the group's size, in (0, 1]."""
    ranked = average_rank(df, value, by, rank="_rank", total="_size", **kw)
    return ranked.withColumn(out, F.col("_rank") / F.col("_size")).drop("_rank", "_size")


def sorted_positions(df: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Global sort with a frozen layout: adds ``_part`` and ``_index`` (row number inside it).

    ``order`` must end in a unique column, so that equal leading values spread over partitions.
    """
    # without a number AQE folds neighbouring ranges, so a small table does not pay for hundreds of tasks
    laid_out = (
        df.repartitionByRange(*([partitions] if partitions else []), *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    frozen = freeze(laid_out)
    return frozen.withColumn("_part", F.shiftright("_slot", 33)).withColumn(
        "_index", F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    )


def _partition_offsets(positions: DataFrame, **sums: str) -> DataFrame:
    """Exclusive prefix counts (and sums) over partitions: one row per partition."""
    aggs = [F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_{n}") for n, c in sums.items()]]
    per_part = positions.groupBy("_part").agg(*aggs)
    # one row per shuffle partition, so a single window over it is small
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    columns = {
        "_rows_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
        "_rows_total": F.sum("_rows").over(whole),
    }
    for name in sums:
        columns[f"_{name}_before"] = F.coalesce(F.sum(f"_{name}").over(before), F.lit(0.0))
        columns[f"_{name}_total"] = F.sum(f"_{name}").over(whole)
    return per_part.withColumns(columns).drop("_rows", *[f"_{n}" for n in sums])


def ordinal_rank(
    df: DataFrame,
    order: Sequence[Column],
    rank: str = "rank",
    total: str | None = None,
    by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Row number 1..n in ``order`` (a total order), per group where ``by`` names few-valued columns."""
    by = list(by)
    positions = sorted_positions(df, [*[F.col(c).asc() for c in by], *order], partitions)
    offsets = _partition_offsets(positions)
    placed = positions.join(F.broadcast(offsets), "_part").withColumn(
        "_place", F.col("_rows_before") + F.col("_index") + 1
    )
    if not by:
        extra = [F.col("_rows_total").alias(total)] if total else []
        return placed.select(*df.columns, F.col("_place").alias(rank), *extra)
    starts = placed.groupBy(*by).agg(F.min("_place").alias("_start"), F.count(F.lit(1)).alias("_size"))
    extra = [F.col("_size").alias(total)] if total else []
    # one row per group
    return placed.join(F.broadcast(starts), by).select(
        *df.columns, (F.col("_place") - F.col("_start") + 1).alias(rank), *extra
    )


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    amount: str,
    rank: str = "rank",
    running: str = "running",
    total: str = "total",
    partitions: int | None = None,
) -> DataFrame:
    """Ordinal rank with the inclusive running sum of ``amount`` and its grand total."""
    positions = sorted_positions(df, order, partitions)
    offsets = _partition_offsets(positions, amount=amount)
    inside = Window.partitionBy("_part").orderBy("_index").rowsBetween(Window.unboundedPreceding, 0)
    return positions.join(F.broadcast(offsets), "_part").select(
        *df.columns,
        (F.col("_rows_before") + F.col("_index") + 1).alias(rank),
        (F.col("_amount_before") + F.sum(amount).over(inside)).alias(running),
        F.col("_amount_total").alias(total),
    )


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation: columns ``by``, ``p``, ``quantile``.

    The two neighbours of each wanted position are the ladder steps whose running counts pass it.
    """
    by = list(by)
    probs = [float(p) for p in probs]
    steps = _ladder(df.filter(F.col(value).isNotNull()), value, by)
    position = F.get(literals(probs), F.col("_i")) * (F.col("_total") - 1)
    wanted = steps.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(len(probs) - 1)))).withColumn("_position", position)
    below, upto = F.col("_upto") - F.col("_n") - F.col("_start"), F.col("_upto") - F.col("_start")
    low_at, high_at = F.floor("_position"), F.ceil("_position")
    hit = wanted.withColumns(
        {"_low": (below <= low_at) & (low_at < upto), "_high": (below <= high_at) & (high_at < upto)}
    ).filter("_low or _high")
    names = [f"_by{i}" for i in range(len(by))]
    found = hit.groupBy(*names, "_i").agg(
        F.max("_position").alias("_position"),
        F.max(F.when(F.col("_low"), F.col("_v"))).alias("_lo"),
        F.max(F.when(F.col("_high"), F.col("_v"))).alias("_hi"),
    )
    quantile = linear_interpolation(F.col("_lo"), F.col("_hi"), F.col("_position") - F.floor("_position"))
    return found.select(
        *[F.col(n).alias(c) for n, c in zip(names, by, strict=True)], F.get(literals(probs), F.col("_i")).alias("p"), quantile.alias("quantile")
    )


def literals(values: Sequence[float]) -> Column:
    """Constant array of doubles, as one parsed expression."""
    return F.expr(f"array({', '.join(f'double({float(v)!r})' if math.isfinite(v) else f'double({str(v)!r})' for v in values)})")


def bin_number(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the sorted ``cuts`` are at or below ``value``, by a coarse then a fine search."""
    every = literals(cuts).cast("array<double>")
    coarse = literals(cuts[_STRIDE - 1 :: _STRIDE]).cast("array<double>")
    return _search(value, every, coarse)


def _search(value: Column, every: Column, coarse: Column) -> Column:
    start = F.size(F.filter(coarse, lambda c: c <= value)) * _STRIDE
    return start + F.size(F.filter(F.slice(every, start + 1, _STRIDE), lambda c: c <= value))
