"""Whole runs: build and store the marts, back-test, score, store the tiering tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctiers.operators import history as H
from acctiers.operators import monitor as M
from acctiers.plans import baselines as B
from acctiers.plans import published as P
from acctiers.plans import validation as V
from acctiers.plans.features import as_date, forward_labels
from acctiers.plans.tiers import TierRun, score_customers, with_segments
from acctiers.plans.warehouse import Warehouse
from acctiers.session import freeze, literal_rows
from acctiers.settings import MODEL_FEATURES, SOURCES, TIERING, tier_names
from acctiers.sources.intervals import IntervalStore
from acctiers.sources.loader import AUDIT, CHECKS, empty_audit, persist_checks
from acctiers.sources.store import Store

ORDER_INPUTS = (
    "order_id",
    "customer_id",
    "order_date",
    "status",
    "net_revenue",
    "gross_margin",
    "discount_pct",
    "payment_terms_days",
    "paid_date",
    "order_month",
)
LINE_INPUTS = ("order_id", "customer_id", "order_date", "status", "category", "order_month")
CUSTOMER_INPUTS = ("customer_id", "business_name", "industry", "region", "employee_count", "signup_date")


def _together(*calls: Callable) -> list:
    """Results of calls that do not need each other.  Most of their jobs are too short or too narrow to fill the
    cores, so they run side by side."""
    with ThreadPoolExecutor(len(calls)) as pool:
        return [one.result() for one in [pool.submit(call) for call in calls]]


def build_marts(store: Store) -> None:
    """Raw tables to marts.  The two nodes that fan out are stored before anything reads them."""
    raw = {s: store.read(f"raw/{s}") for s in ("customers", "products", "orders", "order_items")}
    wh = Warehouse(raw)

    def stored(name: str) -> None:
        folder, partition = ("staging" if name.startswith("int_") else "marts"), ["order_month"]
        store.write(wh.model(name), f"{folder}/{name}", "replace", partition)
        setattr(wh, name, store.read(f"{folder}/{name}"))

    # neither of the two reads the other
    _together(lambda: stored("int_order_lines"), lambda: stored("fct_orders"))
    _together(
        *[
            lambda name=name: store.write(wh.model(name), f"marts/{name}", "replace")
            for name in ("fct_customer_monthly", "dim_customers", "dim_products")
        ]
    )


def customer_history(store: Store) -> IntervalStore:
    return IntervalStore(store, "history/customers_snapshot")


def snapshot_customers(store: Store) -> int:
    """History of the customer attributes: the first run opens it, later runs write what has changed alone.

    Returns the rows of the history."""
    wh = Warehouse({s: store.read(f"raw/{s}") for s in ("customers", "products", "orders", "order_items")})
    history = customer_history(store)
    history.apply(wh.stg_customers.select(*H.CUSTOMER_ATTRIBUTES))
    return history.rows()


def store_checks(store: Store, now: datetime | None = None, run_id: str | None = None) -> DataFrame:
    """Run all checks over the raw tables, append them to the check log and store the health mart.

    The mart is what the export's data-health table reads.
    """
    now = now or datetime.now(UTC)
    tables = {s: store.read_or_none(f"raw/{s}") for s in SOURCES}
    audit = store.read_or_none(AUDIT)
    checks = M.run_all_checks(store.spark, tables, empty_audit(store.spark) if audit is None else audit, now)
    persist_checks(store, freeze(checks), run_id, now)
    store.write(M.mart_data_health(store.read(CHECKS), now), "marts/mart_data_health", "replace")
    return store.read("marts/mart_data_health")


def load_inputs(store: Store) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Only the columns tiering needs; Parquet reads no others, and order_month prunes the history."""
    return (
        store.read("marts/fct_orders", ORDER_INPUTS),
        store.read("staging/int_order_lines", LINE_INPUTS),
        store.read("marts/dim_customers", CUSTOMER_INPUTS),
    )


def frames_from_sources(raw: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same three inputs straight from the four sources, with nothing stored in between."""
    wh = Warehouse(raw)
    return (
        wh.fct_orders.select(*ORDER_INPUTS),
        wh.int_order_lines.select(*LINE_INPUTS),
        wh.stg_customers.select(*CUSTOMER_INPUTS),
    )


@dataclass
class Backtest:
    as_of: date
    judged: DataFrame
    past: TierRun
    lift: DataFrame
    kruskal: DataFrame
    anova: DataFrame
    pairs: DataFrame
    churn: DataFrame
    monotonic: DataFrame
    spearman: DataFrame
    sensitivity: DataFrame
    stability: DataFrame
    fitted: B.Fitted
    metrics: DataFrame
    comparison: DataFrame


def judge(orders: DataFrame, run: TierRun, cfg: dict | None = None) -> DataFrame:
    """Scored customers with what they did afterwards; frozen, as every test reads it."""
    cfg = cfg or TIERING
    labels = forward_labels(
        orders, run.features, run.as_of, cfg["horizon_days"], cfg["validation"]["high_value_quantile"]
    )
    return freeze(run.tiers.join(labels, "customer_id"))


def backtest(
    orders: DataFrame,
    lines: DataFrame,
    customers: DataFrame,
    as_of: date | str,
    cfg: dict | None = None,
    current: TierRun | Callable[[], TierRun] | None = None,
    models: dict | None = None,
    fit: Callable[..., B.Fitted] = B.out_of_fold,
    past: TierRun | None = None,
) -> Backtest:
    """Score at ``as_of - horizon`` and compare with what happened in the horizon.

    ``current`` hands over an existing scoring at ``as_of`` (or waits for it), ``past`` one at the start of the
    horizon, so a date is not scored twice; ``fit`` may read stored predictions in place of fitting.
    """
    cfg = cfg or TIERING
    v = cfg["validation"]
    start = as_date(as_of) - timedelta(days=cfg["horizon_days"])
    if current is None:
        both = score_customers(orders, lines, customers, [start, as_of], cfg)
        past, current = both.at(start), both.at(as_of)
    elif past is None:
        past = score_customers(orders, lines, customers, start, cfg)
    judged = judge(orders, past, cfg)

    def models_compared() -> tuple:
        fitted = fit(judged, MODEL_FEATURES, folds=v["folds"], seed=v["seed"], models=models)
        metrics = B.model_metrics(fitted)
        best = B.best_model(metrics).first()[0]
        scored = fitted.predictions.withColumn("_composite", F.col("composite_score") / 100)
        return fitted, metrics, B.paired_bootstrap_auc(scored, best, "_composite", "label", v["bootstrap"], v["seed"])

    def tests() -> dict[str, DataFrame]:
        return {
            "lift": V.lift_table(judged),
            "kruskal": V.kruskal_wallis(judged, v["alpha"]),
            "anova": V.anova_log_revenue(judged, v["alpha"]),
            "pairs": V.adjacent_tier_tests(judged, v["alpha"]),
            "churn": V.churn_chi_square(judged, v["alpha"]),
            "monotonic": V.monotonic_outcomes(judged),
        }

    (fitted, metrics, comparison), separation, spearman, sensitivity, stability = _together(
        models_compared,
        tests,
        lambda: V.bootstrap_spearman(judged, "composite_score", "future_revenue", v["bootstrap"], v["seed"]),
        lambda: V.weight_sensitivity(
            past.normalized(),
            past.scored.weights,
            cfg["tiers"],
            draws=v["draws"],
            perturbation=v["perturbation"],
            seed=v["seed"],
        ),
        lambda: V.tier_stability(past.tiers, (current() if callable(current) else current).tiers, tier_names(cfg)),
    )
    return Backtest(
        as_of=start,
        judged=judged,
        past=past,
        **separation,
        spearman=spearman,
        sensitivity=sensitivity,
        stability=stability,
        fitted=fitted,
        metrics=metrics,
        comparison=comparison,
    )


def _pick(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """One-row table to (metric, value) rows."""
    rows = [F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in names.items()]
    return df.select(F.inline(F.array(*rows)))


def validation_metrics(b: Backtest) -> DataFrame:
    """Long table: 17 fixed metrics, then roc_auc and pr_auc per model."""
    parts = [
        _pick(
            b.kruskal,
            {
                "kruskal_wallis_h": "h_statistic",
                "kruskal_wallis_p": "p_value",
                "kruskal_wallis_epsilon_sq": "epsilon_squared",
            },
        ),
        _pick(b.anova, {"anova_log_revenue_p": "p_value"}),
        _pick(b.churn, {"churn_chi2_p": "p_value", "churn_cramers_v": "cramers_v"}),
        _pick(b.monotonic, {"monotonic_mean_revenue": "monotonic_mean_revenue"}),
        _pick(
            b.spearman,
            {
                "spearman_score_future_revenue": "spearman_rho",
                "spearman_ci_low": "ci_low",
                "spearman_ci_high": "ci_high",
            },
        ),
        _pick(
            b.stability,
            {"tier_same_rate": "same_tier_rate", "tier_weighted_kappa": "weighted_kappa", "score_psi": "score_psi"},
        ),
        _pick(
            b.sensitivity,
            {
                "sensitivity_tier_agreement_mean": "tier_agreement_mean",
                "sensitivity_kendall_tau_mean": "kendall_tau_mean",
            },
        ),
        _pick(b.comparison, {"best_minus_composite_auc": "auc_difference", "best_minus_composite_auc_p": "p_value"}),
        *[
            b.metrics.select(F.concat("model", F.lit(f"_{m}")).alias("metric"), F.col(m).alias("value"))
            for m in ("roc_auc", "pr_auc")
        ],
    ]
    return reduce(DataFrame.unionByName, parts)


def tier_weights(spark: SparkSession, run: TierRun) -> DataFrame:
    s = run.scored
    rows = [(n, s.weights[n], s.expert[n], s.entropy[n]) for n in s.weights]
    return literal_rows(
        spark, rows, "feature string, applied_weight double, expert_weight double, entropy_weight double"
    )


def write_tables(store: Store, run: TierRun, tested: Backtest, run_id: str, at: datetime) -> None:
    """The six tiering tables.  History replaces only its own date, so a rerun leaves one copy."""
    stamp = {"run_id": F.lit(run_id), "scored_at": F.lit(at).cast("timestamp")}
    day = {"run_id": F.lit(run_id), "as_of_date": F.lit(run.as_of)}
    tiers = freeze(run.tiers.withColumns(stamp))
    history = tiers.select(
        "customer_id", "composite_score", "tier", "tier_rank", "segment", "run_id", "scored_at", "as_of_date"
    )
    lift = tested.lift.drop("tier_rank").withColumns({"run_id": F.lit(run_id), "backtest_as_of": F.lit(tested.as_of)})
    metrics = validation_metrics(tested).withColumns({**day, "recorded_at": F.lit(at).cast("timestamp")})
    _together(
        lambda: store.write(tiers, "tiering/customer_tiers", "replace"),
        lambda: store.replace_partition(history, "tiering/customer_tier_history", "as_of_date"),
        lambda: store.write(tier_weights(store.spark, run).withColumns(day), "tiering/tier_weights", "replace"),
        lambda: store.write(run.segments.profiles.withColumns(day), "tiering/segment_profiles", "replace"),
        lambda: store.write(lift, "tiering/backtest_lift", "replace"),
        lambda: store.append_evolving(metrics, "tiering/validation_metrics"),
    )


def publish(store: Store) -> None:
    tiers = store.read("tiering/customer_tiers")
    mart = P.mart_customer_tiers(tiers, store.read("marts/dim_customers"), store.read("tiering/customer_tier_history"))
    store.write(mart, "marts/mart_customer_tiers", "replace")
    mart = store.read("marts/mart_customer_tiers")
    store.write(P.mart_tier_summary(mart), "marts/mart_tier_summary", "replace")
    movement = P.mart_tier_movement(store.read("tiering/customer_tier_history"))
    store.write(movement, "marts/mart_tier_movement", "replace")


def run_tiering(
    store: Store, as_of: date | str | None = None, run_id: str | None = None, cfg: dict | None = None, models: dict | None = None
) -> TierRun:
    """Score at ``as_of`` (default: the newest order date), validate, store and publish."""
    cfg = cfg or TIERING
    orders, lines, customers = load_inputs(store)
    day = as_date(as_of) if as_of else orders.agg(F.max("order_date")).first()[0]
    at = datetime.now(UTC)
    start = day - timedelta(days=cfg["horizon_days"])
    run, past = _together(
        lambda: score_customers(orders, lines, customers, day, cfg),
        lambda: score_customers(orders, lines, customers, start, cfg),
    )
    with ThreadPoolExecutor(1) as pool:  # k-means is many short jobs, which fill gaps of the back-test
        segmented = pool.submit(with_segments, run, cfg)
        tested = backtest(orders, lines, customers, day, cfg, current=segmented.result, models=models, past=past)
        run = segmented.result()
    write_tables(store, run, tested, run_id or at.strftime("tier_%Y%m%dT%H%M%S"), at)
    publish(store)
    return run


def backfill_history(
    store: Store, as_of_dates: list[date | str], run_id: str, cfg: dict | None = None
) -> None:
    """Tier history for several dates from one pass, one idempotent partition each."""
    orders, lines, customers = load_inputs(store)
    at = datetime.now(UTC)
    tiers = score_customers(orders, lines, customers, as_of_dates, cfg).tiers
    history = tiers.select(
        "customer_id",
        "composite_score",
        "tier",
        "tier_rank",
        F.lit(None).cast("string").alias("segment"),
        F.lit(run_id).alias("run_id"),
        F.lit(at).cast("timestamp").alias("scored_at"),
        "as_of_date",
    )
    store.replace_partition(history, "tiering/customer_tier_history", "as_of_date")
