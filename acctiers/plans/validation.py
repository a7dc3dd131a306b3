"""Do the tiers hold up?  Lift, separation tests, stability and sensitivity, as Spark aggregates.

``judged`` below has one row per scored customer: customer_id, tier, tier_rank, composite_score,
future_revenue, churned, high_value.  Every test reduces it to at most a few rows per tier before any
scalar arithmetic; windows over ``F.lit(0)`` only ever see those.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctiers.functions import tails
from acctiers.operators.rank import average_rank, bin_number, exact_quantiles, literals, ordinal_rank
from acctiers.plans.resampling import spearman_draws
from acctiers.plans.scoring import scale_to_one, weighted_score
from acctiers.plans.tiers import tier_from_share, tier_rank
from acctiers.session import freeze, literal_rows


BUCKET_POINTS = 400_000  # points whose pairs one call settles
BUCKET_CUSTOMERS = 4_000  # customers whose scores under all draws one call works out
SPANS, SPAN_CUSTOMERS = 128, 2_000  # most parts of a draw's scores that are gathered by themselves, least customers of one
_LONGS = pa.list_(pa.int64())


def _all():
    """Window over a whole table; only for tables of a few rows per tier."""
    return Window.partitionBy(F.lit(0))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


# --- outcomes per tier -------------------------------------------------------------------------


def lift_table(judged: DataFrame) -> DataFrame:
    """Outcome summary per tier, best tier first."""
    sums = judged.groupBy("tier", "tier_rank").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("composite_score").alias("avg_score"),
        F.avg("future_revenue").alias("mean_future_revenue"),
        F.sum("future_revenue").alias("_revenue"),
        F.avg("churned").alias("churn_rate"),
        F.avg("high_value").alias("high_value_rate"),
        F.sum("high_value").alias("_high"),
    )
    medians = exact_quantiles(judged, "future_revenue", [0.5], by=["tier"])
    joined = sums.join(medians.select("tier", F.col("quantile").alias("median_future_revenue")), "tier")
    revenue = F.sum("_revenue").over(_all())
    base = F.sum("_high").over(_all()) / F.sum("customers").over(_all())
    return joined.select(
        "tier",
        "tier_rank",
        "customers",
        "avg_score",
        "mean_future_revenue",
        "median_future_revenue",
        (F.col("_revenue") / F.when(revenue == 0, 1.0).otherwise(revenue)).alias("revenue_share"),
        "churn_rate",
        "high_value_rate",
        (F.col("high_value_rate") / F.when(base == 0, 1.0).otherwise(base)).alias("high_value_lift"),
    )


def _tie_sum(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Sum of t^3 - t over groups of equal values."""
    t = F.col("_t").cast("double")
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_t"))
    return counts.groupBy(*by).agg(F.sum(t * t * t - t).alias("ties"))


def kruskal_wallis(judged: DataFrame, alpha: float = 0.05, value: str = "future_revenue") -> DataFrame:
    """Tie-corrected H and epsilon squared over tiers."""
    ranked = average_rank(judged.select("tier", value), value, rank="_r")
    per_tier = ranked.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("_r").alias("r"))
    ties = _tie_sum(judged, value).scalar()
    n = F.col("n").cast("double")
    h = 12.0 / (n * (n + 1)) * F.col("s") - 3.0 * (n + 1)
    one = per_tier.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum(F.col("r") * F.col("r") / F.col("n")).alias("s"))
    tested = one.withColumn("_ties", ties).withColumn("h_statistic", h / (1.0 - F.col("_ties") / (n * n * n - n)))
    return tested.select(
        "n",
        "k",
        "h_statistic",
        tails.chi2_upper_p("h_statistic", (F.col("k") - 1).cast("double")).alias("p_value"),
        F.when(F.col("n") > F.col("k"), (F.col("h_statistic") - F.col("k") + 1) / (F.col("n") - F.col("k"))).alias("epsilon_squared"),
    ).withColumn("significant", F.col("p_value") < alpha)


def anova_log_revenue(judged: DataFrame, alpha: float = 0.05) -> DataFrame:
    """One-way analysis of variance on log1p(future revenue), from group count, mean and variance."""
    x = F.log1p("future_revenue")
    groups = judged.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("m"), F.coalesce(F.var_samp(x), F.lit(0.0)).alias("v")
    )
    grand = F.sum(F.col("n") * F.col("m")).over(_all()) / F.sum("n").over(_all())
    gap = F.col("m") - F.col("_grand")
    sums = groups.withColumn("_grand", grand).agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * gap * gap).alias("between"),
        F.sum((F.col("n") - 1) * F.col("v")).alias("within"),
    )
    d1, d2 = (F.col("k") - 1).cast("double"), (F.col("n") - F.col("k")).cast("double")
    tested = sums.withColumn("f_statistic", (F.col("between") / d1) / _nonzero(F.col("within") / d2))
    return tested.select("n", "k", "f_statistic", tails.f_upper_p("f_statistic", d1, d2).alias("p_value")).withColumn(
        "significant", F.col("p_value") < alpha
    )


def _nonzero(c: Column) -> Column:
    return F.when(c != 0, c)


def holm_adjust(tests: DataFrame, p: str = "p_value", out: str = "p_holm") -> DataFrame:
    """Holm step-down adjusted p-values over a handful of tests."""
    order = Window.partitionBy(F.lit(0)).orderBy(p)
    place = F.row_number().over(order)
    stepped = tests.withColumn("_step", F.least(F.lit(1.0), (F.count(F.lit(1)).over(_all()) - place + 1) * F.col(p)))
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    return stepped.withColumn(out, F.max("_step").over(running)).drop("_step")


def adjacent_tier_tests(judged: DataFrame, alpha: float = 0.05) -> DataFrame:
    """One-sided Mann-Whitney U of each tier against the next lower one, with Holm adjustment.

    Always the tie-corrected normal approximation with continuity correction.
    """
    present = judged.groupBy("tier_rank", "tier").agg(F.count(F.lit(1)).alias("_n"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("tier_rank"))
    places = present.select("tier_rank", place.alias("_place"), F.max(place).over(_all()).alias("_last"))
    # a tier takes part in the pair below it and the pair above it
    pairs = F.filter(F.array("_place", F.col("_place") - 1), lambda x: (x >= 1) & (x < F.col("_last")))
    spread = (
        judged.select("tier", "tier_rank", "future_revenue")
        .join(F.broadcast(places), "tier_rank")  # one row per tier
        .select("tier", "_place", "future_revenue", F.explode(pairs).alias("pair"))
    )
    ranked = average_rank(spread, "future_revenue", by=["pair"], rank="_r")
    high = F.col("_place") == F.col("pair")
    sums = ranked.groupBy("pair").agg(
        F.max(F.when(high, F.col("tier"))).alias("higher"),
        F.max(F.when(~high, F.col("tier"))).alias("lower"),
        F.count_if(high).cast("double").alias("n1"),
        F.count_if(~high).cast("double").alias("n2"),
        F.sum(F.when(high, F.col("_r"))).alias("r1"),
    )
    tested = sums.join(_tie_sum(spread, "future_revenue", "pair"), "pair")
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    spread_of_u = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    tested = tested.withColumn("u_statistic", F.col("r1") - n1 * (n1 + 1) / 2.0)
    tested = tested.withColumn("z", (F.col("u_statistic") - n1 * n2 / 2.0 - 0.5) / spread_of_u)
    tested = tested.select(
        F.col("pair").cast("bigint").alias("pair"),
        "higher",
        "lower",
        "u_statistic",
        "z",
        (F.col("u_statistic") / (n1 * n2)).alias("prob_superiority"),
        tails.normal_upper_p("z").alias("p_value"),
    )
    return holm_adjust(tested).withColumn("significant", F.col("p_holm") < alpha)


def tier_churn_counts(judged: DataFrame) -> DataFrame:
    """Tier by churn cross table, absent cells as zero."""
    return judged.groupBy("tier", "tier_rank").agg(
        F.count_if(F.col("churned") == 0).alias("stayed"), F.count_if(F.col("churned") == 1).alias("churned")
    )


def churn_chi_square(judged: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Chi-square of tier by churn with Cramer's V; Yates' correction only for a 2 x 2 table."""
    table = tier_churn_counts(judged).select(
        "tier", F.explode(F.array(F.struct(F.lit(0).alias("c"), F.col("stayed").alias("o")), F.struct(F.lit(1).alias("c"), F.col("churned").alias("o")))).alias("x")
    )
    cells = table.select("tier", F.col("x.c").alias("c"), F.col("x.o").cast("double").alias("o"))
    col_sum = F.sum("o").over(Window.partitionBy("c"))
    row_sum = F.sum("o").over(Window.partitionBy("tier"))
    cells = cells.withColumns({"_col": col_sum, "_row": row_sum, "n": F.sum("o").over(_all())}).filter("_col > 0")
    shape = cells.agg(
        F.count_distinct("tier").alias("rows"), F.count_distinct("c").alias("cols"), F.max("n").alias("n")
    )
    dof = (F.col("rows") - 1) * (F.col("cols") - 1)
    expected = F.col("_row") * F.col("_col") / F.col("n")
    gap = F.abs(F.col("o") - expected)
    sums = cells.agg(
        F.sum(gap * gap / expected).alias("plain"),
        F.sum(F.pow(gap - F.least(F.lit(0.5), gap), 2) / expected).alias("corrected"),
    )
    tested = shape.withColumn("_s", sums.select(F.struct("*")).scalar()).withColumn("dof", dof)
    tested = tested.withColumn(
        "chi2",
        F.when(F.col("dof") == 0, 0.0).when(F.col("dof") == 1, F.col("_s.corrected")).otherwise(F.col("_s.plain")),
    )
    side = F.least("rows", "cols") - 1
    return tested.select(
        "chi2",
        tails.chi2_upper_p("chi2", F.col("dof").cast("double")).alias("p_value"),
        "dof",
        F.when(side > 0, F.sqrt(F.col("chi2") / (F.col("n") * side))).otherwise(0.0).alias("cramers_v"),
    ).withColumn("significant", F.col("p_value") < alpha)


def monotonic_outcomes(judged: DataFrame) -> DataFrame:
    """Do mean and median future revenue never rise from a better tier to a worse one?"""
    by_tier = lift_table(judged).select("tier_rank", "mean_future_revenue", "median_future_revenue")
    order = Window.partitionBy(F.lit(0)).orderBy("tier_rank")
    falls = lambda c: F.coalesce(F.lag(c).over(order) >= F.col(c), F.lit(True))
    flagged = by_tier.select(falls("mean_future_revenue").alias("mean_ok"), falls("median_future_revenue").alias("median_ok"))
    return flagged.agg(
        F.bool_and("mean_ok").alias("monotonic_mean_revenue"), F.bool_and("median_ok").alias("monotonic_median_revenue")
    )


# --- resampling --------------------------------------------------------------------------------


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation from exact average ranks, with its two-sided t test."""
    pairs = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    rows = df.count()
    both = average_rank(average_rank(pairs, "x", rank="rx"), "y", rank="ry")
    one = both.agg(F.corr("rx", "ry").alias("spearman_rho"), F.count(F.lit(1)).cast("double").alias("_n"))
    rho = F.col("spearman_rho")
    t = rho * F.sqrt((F.col("_n") - 2) / ((1 - rho) * (1 + rho)))
    return one.withColumn("p_value", tails.t_two_sided_p(t, F.col("_n") - 2)).drop("_n")


def bootstrap_spearman(
    df: DataFrame, x: str, y: str, iterations: int = 1000, seed: int = 42, key: str = "customer_id"
) -> DataFrame:
    """Exact rank correlation with a 95 % bootstrap interval over all rows, known by ``key``."""
    draws = spearman_draws(df, x, y, key, iterations, seed)
    ends = draws.agg(F.percentile("rho", F.array(F.lit(0.025), F.lit(0.975))).alias("q"))
    point = spearman(df, x, y)
    return point.withColumn("_q", ends.scalar()).select(
        "spearman_rho", "p_value", F.get("_q", 0).alias("ci_low"), F.get("_q", 1).alias("ci_high")
    )


# --- stability ---------------------------------------------------------------------------------


def population_stability_index(expected: DataFrame, actual: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """PSI over quantile bins of ``expected``; equal edges merge, empty bins count as 1e-6."""
    probs = [i / bins for i in range(bins + 1)]
    rows = exact_quantiles(expected, value, probs).collect()  # bins + 1 numbers
    edges = sorted({r["quantile"] for r in rows})[1:-1]
    slot = lambda df, n: df.select(bin_number(F.col(value).cast("double"), edges).alias("bin")).groupBy("bin").agg(
        F.count(F.lit(1)).alias(n)
    )
    both = slot(expected, "e").join(slot(actual, "a"), "bin", "full_outer").fillna(0)
    share = lambda c: F.greatest(F.col(c) / F.sum(c).over(_all()), F.lit(1e-6))
    shares = both.select(share("e").alias("e"), share("a").alias("a"))
    # bins empty on both sides add nothing
    return shares.agg(F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))).alias("psi"))


def transition_matrix(before: DataFrame, after: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """Full from-tier by to-tier grid, absent moves as zero."""
    moved = before.select("customer_id", F.col("tier").alias("from_tier")).join(
        after.select("customer_id", F.col("tier").alias("to_tier")), "customer_id"
    )
    counts = moved.groupBy("from_tier").agg(
        *[F.count_if(F.col("to_tier") == t).alias(t) for t in tiers]
    )
    grid = literal_rows(before.sparkSession, [(t, i) for i, t in enumerate(tiers)], "from_tier string, from_rank int")
    wide = grid.join(counts, "from_tier", "left").fillna(0)
    to = F.explode(F.array(*[F.struct(F.lit(t).alias("to_tier"), F.lit(i).alias("to_rank"), F.col(t).alias("customers")) for i, t in enumerate(tiers)]))
    return wide.select("from_tier", "from_rank", to.alias("x")).select("from_tier", "from_rank", "x.*")


def weighted_kappa(grid: DataFrame) -> DataFrame:
    """Quadratic kappa of a transition grid; only tiers present on either side are numbered."""
    side = lambda rank: grid.groupBy(F.col(rank).alias("rank")).agg(F.sum("customers").alias("n"))
    present = side("from_rank").unionByName(side("to_rank")).filter("n > 0").select("rank").distinct()
    code = present.withColumn("code", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("rank")))
    left = code.select(F.col("rank").alias("from_rank"), F.col("code").alias("i"))
    right = code.select(F.col("rank").alias("to_rank"), F.col("code").alias("j"))
    cells = grid.join(left, "from_rank").join(right, "to_rank")
    gap = F.pow(F.col("i") - F.col("j"), 2)
    row = F.sum("customers").over(Window.partitionBy("i"))
    col = F.sum("customers").over(Window.partitionBy("j"))
    sums = cells.withColumns({"_w": gap, "_r": row, "_c": col, "_n": F.sum("customers").over(_all())})
    seen = F.sum(F.col("_w") * F.col("customers"))
    chance = F.sum(F.col("_w") * F.col("_r") * F.col("_c") / F.col("_n"))
    return sums.agg((1 - _ratio(seen, chance)).alias("weighted_kappa"))


def tier_stability(before: DataFrame, after: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """One row: agreement of two runs.  PSI uses all customers of each run, not only the matched ones."""
    grid = freeze(transition_matrix(before, after, tiers))
    n = F.sum("customers")
    rate = lambda keep: _ratio(F.sum(F.when(keep, F.col("customers")).otherwise(0)), n)
    a, b = F.col("from_rank"), F.col("to_rank")
    rates = grid.agg(
        n.alias("customers_compared"),
        rate(a == b).alias("same_tier_rate"),
        rate(F.abs(a - b) <= 1).alias("within_one_tier_rate"),
        rate(b < a).alias("upgraded_rate"),
        rate(b > a).alias("downgraded_rate"),
    )
    psi = population_stability_index(before, after, "composite_score")
    return rates.withColumns({"weighted_kappa": weighted_kappa(grid).scalar(), "score_psi": psi.scalar()})


def perturbed_weights(base: dict[str, float], draws: int, perturbation: float, seed: int) -> list[dict[str, float]]:
    """Weight draws: every weight times a uniform factor, scaled to one."""
    rng = np.random.default_rng(seed)
    low, high = 1 - perturbation, 1 + perturbation
    return [scale_to_one({n: w * rng.uniform(low, high) for n, w in base.items()}) for _ in range(draws)]


def signed_pairs(block: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """By block: concordant less discordant pairs of its points (x, y), each standing for n rows.

    A pair is settled at the highest bit in which the codes of its y differ: among points that agree above that
    bit, in the order of x, every point meets the running counts of the other side with a smaller x.  The cost is
    one sort for each bit of the largest block.
    """
    _, block = np.unique(block, return_inverse=True)
    order = np.lexsort((y, block))
    block, x, y, n = block[order], x[order], y[order], n[order].astype(np.int64)
    fresh = np.concatenate([[True], block[1:] != block[:-1]]) if len(block) else np.empty(0, bool)
    steps = np.cumsum(np.concatenate([[False], y[1:] != y[:-1]])[: len(y)] & ~fresh)
    code = steps - np.maximum.accumulate(np.where(fresh, steps, 0)) if len(block) else steps
    total = np.zeros(int(block[-1]) + 1 if len(block) else 0, np.int64)
    for bit in range(int(code.max(initial=0)).bit_length()):
        part = block * (int(code.max()) + 1) + (code >> (bit + 1))
        order = np.lexsort((x, part))
        p, v, k, upper = part[order], x[order], n[order], (code[order] >> bit & 1).astype(bool)
        new = np.concatenate([[True], p[1:] != p[:-1]])
        run = new | np.concatenate([[True], v[1:] != v[:-1]])
        met = []
        for side in (upper, ~upper):  # rows of the side before this run of equal x, in the same part
            before = np.cumsum(k * side) - k * side
            at_run, at_part = (np.maximum.accumulate(np.where(f, np.arange(len(p)), 0)) for f in (run, new))
            met.append(before[at_run] - before[at_part])
        np.add.at(total, block[order], k * np.where(upper, met[1], -met[0]))
    return total


def _settle(key: tuple, rows: pa.Table) -> pa.Table:
    """(draw, pairs): signed pairs inside the blocks of one bucket."""
    draw, block, x, y, n = (rows[c].to_numpy() for c in ("draw", "block", "x", "y", "n"))
    both = draw.astype(np.int64) << 32 | block
    names = np.unique(both)
    found = signed_pairs(both, x, y, n)
    return pa.table({"draw": pa.array((names >> 32).astype(np.int32)), "pairs": pa.array(found, pa.int64())})


def _inside_blocks(points: DataFrame, total: int) -> DataFrame:
    """(draw, pairs) of points(draw, block, x, y, n): pairs of one block, blocks gathered in buckets of bounded size."""
    wide = points.groupBy("draw", "block").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    # a block of one x or one y has no pair that counts; so a value that fills a third of the rows is never gathered
    open_blocks = wide.where("x0 < x1 and y0 < y1").select("draw", "block")
    bucket = F.pmod(F.xxhash64("draw", "block"), F.lit(max(1, total // BUCKET_POINTS)))
    kept = points.join(open_blocks, ["draw", "block"]).withColumn("bucket", bucket)
    return kept.groupBy("bucket").applyInArrow(_settle, "draw int, pairs bigint")


def _across_blocks(bx: np.ndarray, by: np.ndarray, n: np.ndarray) -> int:
    """Signed pairs of one draw whose blocks differ on both sides, from its block-by-block counts."""
    table = np.zeros((int(bx.max()) + 1, int(by.max()) + 1), np.int64)
    table[bx, by] = n
    upto = table.cumsum(0).cumsum(1)
    before = np.zeros_like(table)
    before[1:, 1:] = upto[:-1, :-1]
    right = np.zeros_like(table)  # smaller x block, larger y block
    right[1:] = (upto[:, -1:] - upto)[:-1]
    return int((table * before).sum() - (table * right).sum())


def _across_frame(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"draw": [int(key[0])], "pairs": [_across_blocks(pdf["bx"], pdf["by"], pdf["n"])]})


def kendall_tau(points: DataFrame, total: int) -> DataFrame:
    """(draw, tau): exact tau-b of points(draw, bx, by, x, y), whose blocks bx and by are any cuts of x and y.

    Pairs in different blocks on both sides come from the block-by-block counts, pairs of one x block from the
    points of that block, pairs of one y block and different x blocks from the points of that one.
    """
    folded = freeze(points.groupBy("draw", "bx", "by", "x", "y").agg(F.count(F.lit(1)).alias("n")))
    cells = folded.groupBy("draw", "bx", "by").agg(F.sum("n").alias("n"))
    grid = cells.groupBy("draw").applyInPandas(_across_frame, "draw int, pairs bigint")  # at most bins x bins cells
    draws = folded.agg(F.count_distinct("draw")).first()[0]
    same_x = _inside_blocks(folded.select("draw", F.col("bx").alias("block"), "x", "y", "n"), total * draws)
    by_y = folded.groupBy("draw", "by", "bx", "y").agg(F.sum("n").alias("n"))
    same_y = _inside_blocks(by_y.select("draw", F.col("by").alias("block"), F.col("bx").cast("double").alias("x"), "y", "n"), total * draws)
    pairs = grid.unionByName(same_x).unionByName(same_y).groupBy("draw").agg(F.sum("pairs").alias("pairs"))

    def ties(value: str, name: str) -> DataFrame:
        counts = folded.groupBy("draw", value).agg(F.sum("n").alias("t"))
        return counts.groupBy("draw").agg(F.sum(F.col("t") * (F.col("t") - 1) / 2).alias(name), F.sum("t").alias("n"))

    both = pairs.join(ties("x", "tx"), "draw").join(ties("y", "ty").drop("n"), "draw")
    every = F.col("n") * (F.col("n") - 1) / 2
    norm = F.sqrt(every - F.col("tx")) * F.sqrt(every - F.col("ty"))
    return both.select("draw", F.when(norm > 0, F.col("pairs") / norm).alias("tau"))


class _Draws:
    """Scores of customers under every weight draw, worked out where the customers are.

    A score is held as its whole number of ten-thousandths, a point as (score, base block, base tier) in one number.
    """

    def __init__(self, weights: list[dict[str, float]], cuts: Sequence[float], spans: int = 1):
        self.names = list(weights[0])
        self.weights = [[w[n] for n in self.names] for w in weights]
        self.spans = spans
        self.cuts = np.rint(np.asarray(cuts, float) * 10_000).astype(np.int64)

    def features(self, rows: pa.Table | pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
        columns = [rows[n] for n in self.names]
        null = reduce(np.logical_or, (c.is_null().to_numpy(zero_copy_only=False) if isinstance(c, pa.Array) else c.is_null().to_numpy() for c in columns))
        plain = [c.to_numpy(zero_copy_only=False) if isinstance(c, pa.Array) else c.to_numpy() for c in columns]
        return [c.astype(float) for c in plain], null

    def scores(self, features: list[np.ndarray], null: np.ndarray, draw: int) -> np.ndarray:
        """``weighted_score`` of one draw: the same sum in the same order, decimal halves rounded up."""
        w = self.weights[draw]
        total = reduce(lambda a, b: a + b, [x * k for x, k in zip(features, w, strict=True)])
        held = np.where(null, 0.0, np.where(np.isnan(total), 100.0, np.clip(total * 100, 0.0, 100.0)))
        scaled = held * 10_000
        code = np.floor(scaled + 0.5).astype(np.int64)
        for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6):
            code[i] = int(Decimal(repr(float(held[i]))).scaleb(4).quantize(Decimal(1), ROUND_HALF_UP))
        return code

    def block(self, code: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts, code, "right")

    def span(self, code: np.ndarray) -> np.ndarray:
        """Number of the span of whole y blocks that is gathered at once."""
        return self.block(code) * self.spans // (len(self.cuts) + 1)

    def points(self, table: pa.Table) -> pa.Table:
        """Of some whole blocks of base scores, for each draw: signed pairs inside them, and their points by span."""
        features, null = self.features(table)
        base, bx, tier, n = (table[c].to_numpy().astype(np.int64) for c in ("base", "bx", "tier", "n"))
        draws, spans, pairs, keys, counts = [], [], [], [], []
        for draw in range(len(self.weights)):
            code = self.scores(features, null, draw)
            draws.append(draw)
            spans.append(None)
            pairs.append(int(signed_pairs(bx, base, code, n).sum()))
            keys.append(None)
            counts.append(None)
            key, place = np.unique(code << 28 | bx << 8 | tier, return_inverse=True)
            rows = np.bincount(place, weights=n, minlength=len(key)).astype(np.int64)
            span = self.span(key >> 28)
            edges = np.flatnonzero(np.concatenate([[True], span[1:] != span[:-1], [True]]))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                draws.append(draw)
                spans.append(int(span[a]))
                pairs.append(0)
                keys.append(key[a:b])
                counts.append(rows[a:b] if (rows[a:b] > 1).any() else None)  # mostly ones
        columns = (pa.array(draws, pa.int32()), pa.array(spans, pa.int32()), pa.array(pairs, pa.int64()))
        return pa.table([*columns, pa.array(keys, _LONGS), pa.array(counts, _LONGS)], names=["draw", "span", "pairs", "keys", "counts"])

    def span_sums(self, table: pa.Table) -> pa.Table:
        """Of all points of one draw and span: signed pairs inside y blocks, ties of y, customers by tier, block counts."""
        key, n = _unpacked(table)
        code, bx, tier = key >> 28, key >> 8 & 0xFFFFF, key & 0xFF
        by = self.block(code)
        _, place = np.unique(code, return_inverse=True)
        tied = np.bincount(place, weights=n).astype(np.int64)
        cells, place = np.unique(bx << 32 | by, return_inverse=True)
        sums = {
            "draw": table["draw"][:1],
            "span": table["span"][:1],
            "pairs": pa.array([int(signed_pairs(by, bx, code, n).sum())], pa.int64()),
            "ties": pa.array([int((tied * (tied - 1) // 2).sum())], pa.int64()),
            "tiers": pa.array([np.bincount(tier, weights=n, minlength=256).astype(np.int64)], _LONGS),
            "bx": pa.array([cells >> 32], _LONGS),
            "by": pa.array([cells & 0xFFFFFFFF], _LONGS),
            "n": pa.array([np.bincount(place, weights=n).astype(np.int64)], _LONGS),
        }
        return pa.table(sums)

    def customers_at(self, wanted: dict[int, list[int]], columns: list[str]):
        """Customers whose score under a draw is one of ``wanted``, once for each such draw."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                features, null = self.features(batch)
                for draw, codes in wanted.items():
                    code = self.scores(features, null, draw)
                    hit = np.flatnonzero(np.isin(code, codes))
                    kept = batch.select(columns).take(pa.array(hit))
                    found = (pa.array(np.full(len(hit), draw, np.int32)), pa.array(code[hit]))
                    yield pa.RecordBatch.from_arrays([*found, *kept.columns], names=["draw", "code", *columns])

        return run


def _unpacked(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Points and the customers each stands for."""
    keys = [k.values.to_numpy() for k in table["keys"]]
    counts = [np.ones(len(k), np.int64) if not c.is_valid else c.values.to_numpy() for k, c in zip(keys, table["counts"], strict=True)]
    return (np.concatenate(keys), np.concatenate(counts)) if keys else (np.empty(0, np.int64), np.empty(0, np.int64))


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(draw, span, code, tier, n) of the points of some spans."""
    for batch in batches:
        key, n = _unpacked(batch)
        each = pa.array(np.repeat(np.arange(batch.num_rows), [len(k) for k in batch["keys"]]))
        columns = (batch["draw"].take(each), batch["span"].take(each), pa.array(key >> 28), pa.array((key & 0xFF).astype(np.int32)), pa.array(n))
        yield pa.RecordBatch.from_arrays([*columns], names=["draw", "span", "code", "tier", "n"])


def _across_spans(table: pa.Table) -> pa.Table:
    bx, by, n = (np.concatenate([v.values.to_numpy() for v in table[c]]) for c in ("bx", "by", "n"))
    return pa.table({"draw": table["draw"][:1], "pairs": pa.array([_across_blocks(bx, by, n)], pa.int64())})


def sensitivity_draws(
    normalized: DataFrame,
    base_weights: dict[str, float],
    tiers,
    draws: int = 200,
    perturbation: float = 0.2,
    seed: int = 42,
    bins: int = 1024,
) -> DataFrame:
    """Kendall's tau-b and tier agreement with the base scores, one row per weight draw.

    ``normalized`` holds customer_id and the normalised features, which do not depend on weights.
    Customers are dealt out once, by blocks of base scores, and a task works out their scores under every draw.
    tau-b is exact: pairs inside a base block are counted there; each draw's points then move, packed by spans of
    their own score blocks, to where pairs inside those are counted, and pairs apart on both sides come from block
    counts (see ``kendall_tau``).  The same ``bins`` cuts serve both sides: any would do.  Tiers are read off the
    spans' counts, then off the scores of spans that straddle a tier bound; only customers whose score straddles
    one are ranked one by one.
    """
    names = list(base_weights)
    base = normalized.withColumn("base_score", weighted_score(base_weights))
    total = normalized.count()
    order = [F.col("base_score").desc(), F.col("customer_id").asc()]
    share = ordinal_rank(base, order, "_rank", "_n")
    tiered = share.withColumn("base_tier", tier_from_share(F.col("_rank") / F.col("_n"), tiers))
    cuts = base.agg(
        F.array_sort(
            F.array_distinct(F.percentile_approx("base_score", literals([i / bins for i in range(1, bins + 1)]), 4 * bins))
        )
    ).first()[0]  # at most ``bins`` numbers
    tiered = freeze(tiered.select("customer_id", *names, "base_tier", "base_score", bin_number(F.col("base_score"), cuts).alias("bx")))
    parts = min(SPANS, max(1, total // SPAN_CUSTOMERS))
    found = _Draws(perturbed_weights(base_weights, draws, perturbation, seed), cuts, parts)

    # equal customers are one row, so a hot score costs one point
    vectors = tiered.groupBy(*names, F.round(F.col("base_score") * 10_000).cast("bigint").alias("base"), "bx", (tier_rank(F.col("base_tier"), tiers) - 1).alias("tier")).agg(
        F.count(F.lit(1)).alias("n")
    )
    buckets = max(1, total // BUCKET_CUSTOMERS)
    dealt = vectors.withColumn("bucket", F.floor(F.col("bx") * buckets / (len(cuts) + 1))).repartition(buckets, "bucket")
    # a row of its own holds the pairs of a bucket's blocks; the others hold points
    packed = freeze(
        dealt.groupBy("bucket").applyInArrow(lambda table: found.points(table), "draw int, span int, pairs bigint, keys array<bigint>, counts array<bigint>")
    )
    moved = packed.where("span is not null").repartition(max(1, total * draws // BUCKET_POINTS, parts * draws // 100), "draw", "span")
    spans = freeze(
        moved.groupBy("draw", "span").applyInArrow(
            lambda table: found.span_sums(table), "draw int, span int, pairs bigint, ties bigint, tiers array<bigint>, bx array<bigint>, by array<bigint>, n array<bigint>"
        )
    )
    grid = spans.select("draw", "bx", "by", "n").groupBy("draw").applyInArrow(_across_spans, "draw int, pairs bigint")
    pairs = packed.select("draw", "pairs").unionByName(spans.select("draw", "pairs")).unionByName(grid)
    pairs = pairs.groupBy("draw").agg(F.sum("pairs").alias("pairs"))
    ties = spans.groupBy("draw").agg(F.sum("ties").alias("ty"))
    same_base = tiered.groupBy("base_score").agg(F.count(F.lit(1)).alias("t")).agg(F.sum(F.col("t") * (F.col("t") - 1) / 2))
    every = total * (total - 1) / 2
    norm = F.sqrt(F.lit(every) - same_base.scalar()) * F.sqrt(F.lit(every) - F.col("ty"))
    tau = pairs.join(ties, "draw").select("draw", F.when(norm > 0, F.col("pairs") / norm).alias("tau"))

    def placed(df: DataFrame, size: Column, down, above: Column) -> DataFrame:
        """Best and worst tier of rows that stand for ``size`` customers each, from the top down."""
        upto = above + F.sum(size).over(down)
        first, last = (upto - size + 1) / F.lit(total), upto / F.lit(total)
        return df.withColumns({"best": tier_from_share(first, tiers), "worst": tier_from_share(last, tiers), "_before": upto - size})

    size = F.aggregate("tiers", F.lit(0).cast("bigint"), lambda acc, m: acc + m)
    spans = spans.select("draw", "span", "tiers", size.alias("n"))
    spans = freeze(placed(spans, F.col("n"), Window.partitionBy("draw").orderBy(F.col("span").desc()), F.lit(0)))
    agreed = spans.filter("best = worst").select("draw", F.get("tiers", tier_rank(F.col("best"), tiers) - 1).alias("agree"))

    # at most one straddling span, then score, per draw and tier bound
    split = F.broadcast(spans.filter("best <> worst").select("draw", "span", "_before"))
    ladder = packed.where("span is not null").join(split.drop("_before"), ["draw", "span"]).select("draw", "span", "keys", "counts")
    ladder = ladder.mapInArrow(_span_rows, "draw int, span int, code bigint, tier int, n bigint").groupBy("draw", "span", "code", "tier").agg(F.sum("n").alias("n"))
    per_score = ladder.groupBy("draw", "span", "code").agg(F.sum("n").alias("n"), F.collect_list(F.struct("tier", "n")).alias("mix"))
    per_score = per_score.join(split.withColumnRenamed("_before", "_above"), ["draw", "span"])
    scores = freeze(placed(per_score, F.col("n"), Window.partitionBy("draw", "span").orderBy(F.col("code").desc()), F.col("_above")))
    same = F.aggregate(
        F.filter("mix", lambda m: m["tier"] == tier_rank(F.col("best"), tiers) - 1), F.lit(0).cast("bigint"), lambda acc, m: acc + m["n"]
    )
    agreed = agreed.unionByName(scores.filter("best = worst").select("draw", same.alias("agree")))

    straddling = scores.filter("best <> worst").select("draw", "code", "_before")
    wanted: dict[int, list[int]] = {}
    for r in straddling.collect():
        wanted.setdefault(r["draw"], []).append(r["code"])
    who = tiered.select("customer_id", "base_tier")
    at = tiered.select("customer_id", *names, "base_tier").mapInArrow(
        found.customers_at(wanted, who.columns), f"draw int, code bigint, customer_id {who.schema[0].dataType.simpleString()}, base_tier string"
    )
    order = [F.col("draw").asc(), F.col("code").desc(), F.col("customer_id").asc()]
    numbered = ordinal_rank(at.join(F.broadcast(straddling), ["draw", "code"]), order, "_place")
    starts = numbered.groupBy("draw", "code").agg(F.min("_place").alias("_start"))
    numbered = numbered.join(F.broadcast(starts), ["draw", "code"])
    tier = tier_from_share((F.col("_before") + F.col("_place") - F.col("_start") + 1) / F.lit(total), tiers)
    agreed = agreed.unionByName(numbered.select("draw", (tier == F.col("base_tier")).cast("bigint").alias("agree")))
    agreement = agreed.groupBy("draw").agg((F.sum("agree") / F.lit(total)).alias("agreement"))
    return tau.join(agreement, "draw")


def weight_sensitivity(normalized: DataFrame, base_weights: dict[str, float], tiers, **options) -> DataFrame:
    runs = sensitivity_draws(normalized, base_weights, tiers, **options)
    return runs.agg(
        F.count(F.lit(1)).alias("iterations"),
        F.avg("tau").alias("kendall_tau_mean"),
        F.percentile("tau", 0.05).alias("kendall_tau_p05"),
        F.avg("agreement").alias("tier_agreement_mean"),
        F.percentile("agreement", 0.05).alias("tier_agreement_p05"),
    )


