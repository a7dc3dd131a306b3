"""Tier assignment and the scoring of all customers at one date."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctiers.operators.rank import ordinal_rank, percent_rank_average
from acctiers.plans.features import as_date, build_features, build_features_multi
from acctiers.plans.scoring import Scored, composite_score
from acctiers.session import freeze
from acctiers.settings import TIERING

_TOLERANCE = 1e-12


def tier_bounds(tiers) -> list[tuple[str, float]]:
    """Cumulative share of customers down to the end of each tier."""
    whole = sum(share for _, share in tiers)
    bounds, reached = [], 0.0
    for name, share in tiers:
        reached += share / whole
        bounds.append((name, reached))
    return bounds


def tier_from_share(share: Column, tiers) -> Column:
    bounds = tier_bounds(tiers)
    expr = None
    for name, bound in bounds[:-1]:
        fits = share - F.lit(_TOLERANCE) <= F.lit(bound)
        expr = F.when(fits, name) if expr is None else expr.when(fits, name)
    return expr.otherwise(bounds[-1][0]) if expr is not None else F.lit(bounds[-1][0])


def tier_rank(tier: Column, tiers) -> Column:
    """1 = best tier; the map holds one entry per tier."""
    pairs = [F.lit(x) for i, (name, _) in enumerate(tiers, start=1) for x in (name, i)]
    return F.create_map(*pairs)[tier].cast("int")


def assign_tiers(
    scores: DataFrame,
    tiers,
    score: str = "composite_score",
    tie: str = "customer_id",
    by: Sequence[str] = (),
) -> DataFrame:
    """Tiers from the top down by share of customers; equal scores go by ``tie`` ascending."""
    order = [F.col(score).desc(), F.col(tie).asc()]
    ranked = ordinal_rank(scores, order, rank="_rank", total="_size", by=by)
    tier = tier_from_share(F.col("_rank") / F.col("_size"), tiers)
    return (
        ranked.withColumn("tier", tier)
        .withColumn("tier_rank", tier_rank(F.col("tier"), tiers))
        .drop("_rank", "_size")
    )


def with_score_percentile(
    scores: DataFrame, score: str = "composite_score", by: Sequence[str] = ()
) -> DataFrame:
    ranked = percent_rank_average(scores, score, by=by, out="score_percentile")
    return ranked.withColumn("score_percentile", F.round("score_percentile", 4))


@dataclass
class TierRun:
    """One or more scoring dates; ``at`` picks one of them."""

    tiers: DataFrame
    scored: Scored
    as_of: date
    features: DataFrame
    segments: object | None = None

    def at(self, day: date | str) -> TierRun:
        day = as_date(day)
        on_day = F.col("as_of_date") == F.lit(day)
        s = self.scored
        weights = {day: s.by_day[day]} if day in s.by_day else s.by_day
        scored = Scored(s.scores.filter(on_day), s.oriented.filter(on_day), weights, s.expert)
        return TierRun(self.tiers.filter(on_day), scored, day, self.features.filter(on_day))

    def normalized(self) -> DataFrame:
        """customer_id and the normalised features, which do not depend on the weights."""
        names = list(self.scored.expert)
        return self.scored.scores.select("customer_id", *[F.col(f"{n}_score").alias(n) for n in names])


def score_customers(
    orders: DataFrame,
    lines: DataFrame,
    customers: DataFrame,
    as_of: date | str | Sequence[date | str],
    cfg: dict | None = None,
    segment: bool = False,
) -> TierRun:
    """Features, composite score, tier, percentile and (optionally) segment of every active customer.

    Several dates are scored in one pass over orders and lines.
    """
    cfg = cfg or TIERING
    several = not isinstance(as_of, (date, str))
    build = build_features_multi if several else build_features
    features = freeze(build(orders, lines, customers, as_of, cfg["lookback_days"], cfg["min_orders"]))
    if features.isEmpty():
        raise ValueError(f"no customers with >= {cfg['min_orders']} orders in the look-back window at {as_of}")
    scored = composite_score(features, cfg)
    scored.scores = freeze(scored.scores)
    date_key = ["as_of_date"]
    tiers = assign_tiers(scored.scores, cfg["tiers"], by=date_key)
    table = features.join(with_score_percentile(tiers, by=date_key), ["customer_id", "as_of_date"])
    table = table.select(*features.columns, *[c for c in table.columns if c not in features.columns])
    last = max(map(as_date, as_of)) if several else as_date(as_of)
    run = TierRun(freeze(table), scored, last, features)
    return with_segments(run, cfg) if segment else run


def with_segments(run: TierRun, cfg: dict | None = None) -> TierRun:
    """The run with the segment of every customer."""
    from acctiers.plans.segments import behavioral_segments

    cfg = cfg or TIERING
    segments = behavioral_segments(run.normalized(), list(cfg["features"]), cfg["segments"])
    return replace(run, segments=segments, tiers=run.tiers.join(segments.labels, "customer_id"))
