"""Composite score: fill, transform, winsorise, orient, normalise, weight.

Every step works per ``as_of_date``, so one pass scores one date or a whole back-fill.  Medians,
bounds and the like are a few numbers per date and feature; they come back to the driver and enter
the next step as literals, so no step joins.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctiers.functions.exprs import clip, log_positive, normal_cdf
from acctiers.operators.rank import exact_quantiles, percent_rank_average
from acctiers.settings import TIERING

EPSILON = 1e-9
ID = ["as_of_date", "customer_id"]


@dataclass
class Scored:
    """``scores``: as_of_date, customer_id, ``<feature>_score`` in [0, 1], ``composite_score`` in [0, 100]."""

    scores: DataFrame
    oriented: DataFrame
    by_day: dict[date, dict[str, float]]
    expert: dict[str, float]

    @property
    def weights(self) -> dict[str, float]:
        """The weights used, where all dates have the same."""
        used = list(self.by_day.values())
        if any(w != used[0] for w in used):
            raise ValueError("the dates have different weights; pick one date first")
        return used[0]

    @cached_property
    def entropy(self) -> dict[str, float]:
        """Entropy weights of a single date; worked out only when asked for."""
        return entropy_weights(self.oriented, list(self.expert))


def to_long(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*ID, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(ID, names, "feature", "value")


def by_date(values: Mapping[date, float], default: float = 0.0) -> Column:
    """The number belonging to the row's as-of date; ``default`` for dates without one."""
    if not values:
        return F.lit(default)
    pairs = [x for day, v in values.items() for x in (F.lit(day), F.lit(float(v)))]
    return F.coalesce(F.create_map(*pairs)[F.col("as_of_date")], F.lit(default))


def _quantile_table(df: DataFrame, names: list[str], probs: list[float]) -> dict:
    """(feature, p) -> {date: quantile}; dates x features x probs numbers."""
    found = exact_quantiles(to_long(df, names), "value", probs, by=["as_of_date", "feature"])
    table: dict[tuple[str, float], dict[date, float]] = {}
    for r in found.collect():
        table.setdefault((r["feature"], r["p"]), {})[r["as_of_date"]] = r["quantile"]
    return table


def prepare(features: DataFrame, spec: dict, winsor: tuple[float, float] | None) -> DataFrame:
    """Oriented feature values, higher always better.

    Order matters: missing values take the median before the log, and the winsor bounds are
    quantiles of the transformed value (an interpolated quantile does not commute with a log).
    """
    names = list(spec)
    medians = _quantile_table(features, names, [0.5])
    filled = features.select(*ID, *[F.col(n).cast("double").alias(n) for n in names])
    filled = filled.withColumns({n: F.coalesce(F.col(n), by_date(medians.get((n, 0.5), {}))) for n in names})
    moved = filled.withColumns({n: log_positive(F.col(n)) for n in names if spec[n].get("transform") == "log1p"})
    if winsor:
        low, high = winsor
        bounds = _quantile_table(moved, names, [low, high])
        moved = moved.withColumns(
            {n: clip(F.col(n), by_date(bounds[n, low]), by_date(bounds[n, high])) for n in names}
        )
    # + 0.0 turns -0.0 into 0.0
    return moved.withColumns({n: F.col(n) * F.lit(float(spec[n].get("direction", 1))) + F.lit(0.0) for n in names})


def normalize_percentile(oriented: DataFrame, names: list[str]) -> DataFrame:
    """Average rank / n for every feature at once, ranked in long form and folded back per customer."""
    long = to_long(oriented, names)
    ranked = percent_rank_average(long, "value", by=["as_of_date", "feature"], out="pct")
    return ranked.groupBy(*ID).agg(*[F.max(F.when(F.col("feature") == n, F.col("pct"))).alias(n) for n in names])


def _per_date(oriented: DataFrame, aggregates: dict[str, Column]) -> dict[str, dict[date, float]]:
    rows = oriented.groupBy("as_of_date").agg(*[c.alias(n) for n, c in aggregates.items()]).collect()
    return {n: {r["as_of_date"]: r[n] for r in rows} for n in aggregates}


def normalize_minmax(oriented: DataFrame, names: list[str]) -> DataFrame:
    ends = _per_date(oriented, {f"{e}_{n}": f(n) for n in names for e, f in (("lo", F.min), ("hi", F.max))})

    def scaled(n: str) -> Column:
        spans = {d: (ends[f"hi_{n}"][d] - low) or 1.0 for d, low in ends[f"lo_{n}"].items()}
        return (F.col(n) - by_date(ends[f"lo_{n}"])) / by_date(spans, 1.0)

    return oriented.select(*ID, *[scaled(n).alias(n) for n in names])


def normalize_zscore(oriented: DataFrame, names: list[str]) -> DataFrame:
    stats = _per_date(oriented, {f"{e}_{n}": f(n) for n in names for e, f in (("mu", F.avg), ("sd", F.stddev_pop))})

    def probability(n: str) -> Column:
        spread = {d: sd or 1.0 for d, sd in stats[f"sd_{n}"].items()}
        return normal_cdf((F.col(n) - by_date(stats[f"mu_{n}"])) / by_date(spread, 1.0))

    return oriented.select(*ID, *[probability(n).alias(n) for n in names])


NORMALIZERS = {
    "percentile": normalize_percentile,
    "minmax": normalize_minmax,
    "zscore": normalize_zscore,
}


def normalize(oriented: DataFrame, names: list[str], method: str = "percentile") -> DataFrame:
    if method not in NORMALIZERS:
        raise ValueError(f"unknown normalization {method!r}")
    return NORMALIZERS[method](oriented, names)


def scale_to_one(weights: dict[str, float]) -> dict[str, float]:
    total = sum(weights.values())
    if total <= 0:
        raise ValueError("feature weights must add up to a positive number")
    return {name: w / total for name, w in weights.items()}


def entropy_table(oriented: DataFrame, names: list[str]) -> DataFrame:
    """Diversity (1 - entropy) per date and feature, on min-max values so that dispersion (not rank) counts.

    With S = sum x and T = sum x ln x, sum p ln p = T/S - ln S, so two plain aggregates do it.
    """
    long = normalize_minmax(oriented, names).unpivot(ID, names, "feature", "x")
    x = F.col("x") + F.lit(EPSILON)
    sums = long.groupBy("as_of_date", "feature").agg(
        F.sum(x).alias("s"), F.sum(x * F.log(x)).alias("t"), F.count(F.lit(1)).alias("n")
    )
    entropy = -(F.col("t") / F.col("s") - F.log("s")) / F.log(F.col("n").cast("double"))
    diversity = F.when(F.col("n") > 1, F.greatest(1 - entropy, F.lit(0.0))).otherwise(0.0)
    return sums.select("as_of_date", "feature", "n", diversity.alias("diversity"))


def entropy_by_date(oriented: DataFrame, names: list[str]) -> dict[date, dict[str, float]]:
    """Entropy weights of every date: dates x features numbers."""
    found: dict[date, dict[str, float]] = {}
    for r in entropy_table(oriented, names).collect():
        found.setdefault(r["as_of_date"], {})[r["feature"]] = r["diversity"]
    return {
        day: scale_to_one({n: d[n] for n in names} if sum(d.values()) else dict.fromkeys(names, 1.0)) for day, d in found.items()
    }


def entropy_weights(oriented: DataFrame, names: list[str]) -> dict[str, float]:
    """Entropy weights of a table of one date."""
    found = entropy_by_date(oriented, names)
    if len(found) > 1:
        raise ValueError("entropy weights belong to one date; use entropy_by_date")
    return next(iter(found.values()), scale_to_one(dict.fromkeys(names, 1.0)))


def expert_weights(cfg: dict) -> dict[str, float]:
    return scale_to_one({n: float(s["weight"]) for n, s in cfg["features"].items()})


def resolve_weights(method: str, expert: dict[str, float], entropy: dict[str, float] | None) -> dict[str, float]:
    if method == "config":
        return expert
    if method == "entropy":
        return entropy
    if method == "blend":
        return scale_to_one({n: (expert[n] + entropy[n]) / 2 for n in expert})
    raise ValueError(f"unknown weighting {method!r}")


def weighted_score(weights: Mapping[str, float | Column], suffix: str = "") -> Column:
    """Weighted sum x 100, held to 0..100 and rounded to four places."""
    terms = [F.col(n + suffix) * (w if isinstance(w, Column) else F.lit(w)) for n, w in weights.items()]
    total = reduce(lambda a, b: a + b, terms)
    return F.round(clip(total * 100, F.lit(0.0), F.lit(100.0)), 4)


def composite_score(
    features: DataFrame, cfg: dict | None = None, weights: dict[str, float] | None = None
) -> Scored:
    """Scores of all customers; data-driven weights are found for each date by itself."""
    cfg = cfg or TIERING
    spec = cfg["features"]
    names = list(spec)
    oriented = prepare(features, spec, cfg.get("winsor"))
    normalized = normalize(oriented, names, cfg["normalization"])
    expert = expert_weights(cfg)
    if weights:
        used, by_day = scale_to_one(weights), None
    elif cfg["weighting"] == "config":
        used, by_day = expert, None
    else:
        found = entropy_by_date(oriented, names)
        by_day = {day: resolve_weights(cfg["weighting"], expert, w) for day, w in found.items()}
        used = {n: by_date({day: w[n] for day, w in by_day.items()}) for n in names}
    scores = normalized.select(
        *ID,
        *[F.col(n).alias(f"{n}_score") for n in names],
        weighted_score({n: used[n] for n in names}).alias("composite_score"),
    )
    if by_day is None:
        by_day = {None: used}
    return Scored(scores, oriented, by_day, expert)
