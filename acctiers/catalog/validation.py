"""Queries for tier validation and supervised baselines (sections P, Q)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers.catalog.registry import query
from acctiers.catalog.sql import AS_OF, BACKTEST, PARTS, RUN_DATES, average_rank_sql, expert_weights, tier_case_sql
from acctiers.catalog.tiering import Inputs
from acctiers.plans import baselines as B
from acctiers.plans import resampling as RS
from acctiers.plans import runs as R
from acctiers.plans import validation as V
from acctiers.session import freeze, scratch_path
from acctiers.settings import MODEL_FEATURES, TIERING, tier_names

TIERS = tier_names()


def judged(spark, sf) -> DataFrame:
    inputs = Inputs(spark, sf)
    return R.judge(inputs.orders, inputs.run(BACKTEST))


# --- P: statistics -----------------------------------------------------------------------------

PARTS["lift"] = """
select tier, tier_rank, count(*) as customers, avg(composite_score) as avg_score, avg(future_revenue) as mean_future_revenue,
       median(future_revenue) as median_future_revenue, sum(future_revenue) / (select sum(future_revenue) from judged) as revenue_share,
       avg(churned) as churn_rate, avg(high_value) as high_value_rate,
       avg(high_value) / (select avg(high_value) from judged) as high_value_lift
from judged group by tier, tier_rank"""
query(
    "P1_lift_table",
    "select * from lift",
    "avg_score mean_future_revenue:3 median_future_revenue:5 revenue_share churn_rate high_value_rate high_value_lift",
)(lambda s, d: V.lift_table(judged(s, d)))

PARTS["kw_ranks"] = f"select tier, {average_rank_sql('future_revenue')} as r from judged"
PARTS["kw_ties"] = "select sum(c * c * c - c) as t from (select cast(count(*) as double) as c from judged group by future_revenue)"
PARTS["kw"] = """
select n, k, (12.0 / (n * (n + 1)) * s - 3.0 * (n + 1)) / (1.0 - (select t from kw_ties) / (n * n * n - n)) as h_statistic
from (select cast(sum(n) as double) as n, count(*) as k, sum(r * r / n) as s from (select count(*) as n, sum(r) as r from kw_ranks group by tier))"""
query(
    "P2_kruskal_wallis",
    "select cast(n as bigint) as n, k, h_statistic, (h_statistic - k + 1) / (n - k) as epsilon_squared from kw",
    "h_statistic epsilon_squared",
)(lambda s, d: V.kruskal_wallis(judged(s, d)).drop("p_value", "significant"))

query(
    "P3_anova_log_revenue",
    """select cast(sum(n) as bigint) as n, count(*) as k,
              (sum(n * (m - grand) * (m - grand)) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))) as f_statistic
       from (select *, sum(n * m) over () / sum(n) over () as grand from (
         select count(*) as n, avg(ln(1 + future_revenue)) as m, var_samp(ln(1 + future_revenue)) as v from judged group by tier))""",
    "f_statistic",
)(lambda s, d: V.anova_log_revenue(judged(s, d)).drop("p_value", "significant"))

PARTS["pair_rows"] = """
select 1 as pair, tier, tier_rank = 1 as high, future_revenue from judged where tier_rank in (1, 2)
union all select 2, tier, tier_rank = 2, future_revenue from judged where tier_rank in (2, 3)
union all select 3, tier, tier_rank = 3, future_revenue from judged where tier_rank in (3, 4)"""
PARTS["pair_ranks"] = f"select *, {average_rank_sql('future_revenue', 'pair')} as r from pair_rows"
PARTS["pair_ties"] = """
select pair, sum(c * c * c - c) as t from (select pair, cast(count(*) as double) as c from pair_rows group by pair, future_revenue) group by pair"""
PARTS["pair_tests"] = """
select cast(p.pair as bigint) as pair, higher, lower, u as u_statistic, u / (n1 * n2) as prob_superiority,
       (u - n1 * n2 / 2.0 - 0.5) / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - t / ((n1 + n2) * (n1 + n2 - 1)))) as z
from (select pair, max(tier) filter (where high) as higher, max(tier) filter (where not high) as lower,
             cast(count(*) filter (where high) as double) as n1, cast(count(*) filter (where not high) as double) as n2,
             sum(r) filter (where high) - count(*) filter (where high) * (count(*) filter (where high) + 1) / 2.0 as u
      from pair_ranks group by pair) p join pair_ties t on t.pair = p.pair"""
query("P4_adjacent_mann_whitney", "select * from pair_tests", "u_statistic:1 prob_superiority z")(
    lambda s, d: V.adjacent_tier_tests(judged(s, d)).drop("p_value", "p_holm", "significant")
)


@query(
    "P5_holm_adjust",
    """select event_type, p_value, max(step) over (order by p_value rows unbounded preceding) as p_holm from (
         select *, least(1.0, (count(*) over () - row_number() over (order by p_value) + 1) * p_value) as step from (
           select event_type, exp(-avg(value) / 10.0) as p_value from events group by event_type))""",
    "p_value:8 p_holm:8",
)
def _(spark, sf):
    """Adjusts one p-value per event type (derived from the mean value)."""
    from acctiers.sources import testtables as T

    p = T.table(spark, sf, "events").groupBy("event_type").agg(F.exp(-F.avg("value") / 10.0).alias("p_value"))
    return V.holm_adjust(p)


query(
    "P6_churn_chi_square",
    """with o as (select tier, churned, count(*) as o from judged group by 1, 2),
            g as (select t.tier, c.churned, cast(coalesce(o.o, 0) as double) as o from (select distinct tier from judged) t
                  join (select distinct churned from judged) c on true left join o on o.tier = t.tier and o.churned = c.churned),
            e as (select *, sum(o) over (partition by tier) * sum(o) over (partition by churned) / sum(o) over () as e, sum(o) over () as n from g)
       select sum((o - e) * (o - e) / e) as chi2, cast(3 as bigint) as dof, sqrt(sum((o - e) * (o - e) / e) / max(n)) as cramers_v from e""",
    "chi2 cramers_v",
)(lambda s, d: V.churn_chi_square(judged(s, d)).drop("p_value", "significant"))
query(
    "P7_monotonic_outcomes",
    """select bool_and(coalesce(pm >= mean_future_revenue, true)) as monotonic_mean_revenue,
              bool_and(coalesce(pd >= median_future_revenue, true)) as monotonic_median_revenue
       from (select *, lag(mean_future_revenue) over (order by tier_rank) as pm, lag(median_future_revenue) over (order by tier_rank) as pd from lift)""",
)(lambda s, d: V.monotonic_outcomes(judged(s, d)))
query(
    "P8_spearman",
    f"""select corr(a, b) as spearman_rho from (
          select {average_rank_sql('composite_score')} as a, {average_rank_sql('future_revenue')} as b from judged)""",
    "spearman_rho",
)(lambda s, d: V.spearman(judged(s, d), "composite_score", "future_revenue").drop("p_value"))


def add_resample(tag: str, source: str, iterations: int = 1000, seed: int = 42) -> None:
    """Register ``resample_<tag>``: every row of ``source(key, ..)`` with its Poisson weight ``w`` under every replicate."""
    whole, last = 1 << 64, RS.STEP
    times = lambda x, c: f"(({x})::uhugeint * {c}::uhugeint % {whole}::uhugeint)::ubigint"
    plus = lambda x, y: f"((({x})::uhugeint + ({y})::uhugeint) % {whole}::uhugeint)::ubigint"
    start = f"((key::hugeint + {whole}::hugeint) % {whole}::hugeint)::ubigint"
    PARTS[f"hash0_{tag}"] = f"select *, {plus(start, seed * last % whole)} as h from {source}"
    PARTS[f"hash1_{tag}"] = f"select * replace ({times('xor(h, h >> 30)', RS.MIX1)} as h) from hash0_{tag}"
    PARTS[f"hash2_{tag}"] = f"select * replace ({times('xor(h, h >> 27)', RS.MIX2)} as h) from hash1_{tag}"
    PARTS[f"hash3_{tag}"] = (
        f"select * replace ({plus('xor(h, h >> 31)', times('r', last))} as h) from hash2_{tag} join range({iterations}) replicates(r) on true"
    )
    PARTS[f"hash4_{tag}"] = f"select * replace ({times('xor(h, h >> 30)', RS.MIX1)} as h) from hash3_{tag}"
    PARTS[f"hash5_{tag}"] = f"select * replace ({times('xor(h, h >> 27)', RS.MIX2)} as h) from hash4_{tag}"
    weight = " + ".join(f"cast(xor(h, h >> 31) >= {c}::ubigint as int)" for c in RS.poisson_cuts())
    PARTS[f"resample_{tag}"] = f"select * exclude (h), {weight} as w from hash5_{tag}"


def weighted_place_sql(value: str, weight: str = "w") -> str:
    """Weight below a value and half of its own, by replicate."""
    return f"(sum({weight}) over (partition by r order by {value}) - sum({weight}) over (partition by r, {value}) / 2.0)"


PARTS["bootstrap_rows"] = "select customer_id as key, composite_score as x, future_revenue as y from judged"
add_resample("spearman", "bootstrap_rows")
PARTS["bootstrap_ranks"] = f"select r, w, {weighted_place_sql('x')} as a, {weighted_place_sql('y')} as b from resample_spearman"
PARTS["bootstrap_centred"] = """
select r, w, a - sum(w * a) over (partition by r) / sum(w) over (partition by r) as a, b - sum(w * b) over (partition by r) / sum(w) over (partition by r) as b
from bootstrap_ranks"""
PARTS["bootstrap_rho"] = "select r, sum(w * a * b) / (sqrt(sum(w * a * a)) * sqrt(sum(w * b * b))) as rho from bootstrap_centred group by r"
query(
    "P8_bootstrap_spearman",
    f"""select (select corr(a, b) from (select {average_rank_sql('composite_score')} as a, {average_rank_sql('future_revenue')} as b from judged)) as spearman_rho,
               quantile_cont(rho, 0.025) as ci_low, quantile_cont(rho, 0.975) as ci_high from bootstrap_rho""",
    "spearman_rho ci_low:8 ci_high:8",
)(lambda s, d: V.bootstrap_spearman(judged(s, d), "composite_score", "future_revenue", 1000, 42).drop("p_value"))

PARTS["psi_edges"] = """
select distinct e from (select unnest(quantile_cont(composite_score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) as e from scored_past)
where e > (select min(composite_score) from scored_past) and e < (select max(composite_score) from scored_past)"""
PARTS["psi_value"] = """
select sum((a - e) * ln(a / e)) as psi from (
  select greatest(count(*) filter (where side = 'e') / (select cast(count(*) as double) from scored_past), 1e-6) as e,
         greatest(count(*) filter (where side = 'a') / (select cast(count(*) as double) from scored_now), 1e-6) as a
  from (select side, (select count(*) from psi_edges where e <= x) as bin from (
          select 'e' as side, composite_score as x from scored_past union all select 'a', composite_score from scored_now)) group by bin)"""


def _two_runs(spark, sf):
    run = Inputs(spark, sf).run([BACKTEST, AS_OF])
    return run.at(BACKTEST).tiers, run.at(AS_OF).tiers


query("P9_score_psi", "select psi from psi_value", "psi")(
    lambda s, d: V.population_stability_index(*_two_runs(s, d), "composite_score")
)
PARTS["moves"] = """
select a.tier as from_tier, a.tier_rank - 1 as i, b.tier as to_tier, b.tier_rank - 1 as j, count(*) as customers
from scored_past a join scored_now b on b.customer_id = a.customer_id group by all"""
PARTS["kappa"] = """
select 1 - sum((i - j) * (i - j) * customers) / sum((i - j) * (i - j) * r * c / n) as weighted_kappa from (
  select x.i, y.j, coalesce(m.customers, 0) as customers, x.r, y.c, sum(coalesce(m.customers, 0)) over () as n
  from (select i, sum(customers) as r from moves group by i) x join (select j, sum(customers) as c from moves group by j) y on true
  left join moves m on m.i = x.i and m.j = y.j)"""
query(
    "P10_tier_stability",
    """select cast(sum(customers) as bigint) as customers_compared,
              sum(customers) filter (where i = j) / cast(sum(customers) as double) as same_tier_rate,
              sum(customers) filter (where abs(i - j) <= 1) / cast(sum(customers) as double) as within_one_tier_rate,
              sum(customers) filter (where j < i) / cast(sum(customers) as double) as upgraded_rate,
              sum(customers) filter (where j > i) / cast(sum(customers) as double) as downgraded_rate,
              (select weighted_kappa from kappa) as weighted_kappa, (select psi from psi_value) as score_psi from moves""",
    "same_tier_rate within_one_tier_rate upgraded_rate downgraded_rate weighted_kappa score_psi",
)(lambda s, d: V.tier_stability(*_two_runs(s, d), TIERS))
_GRID = ", ".join(f"('{t}', {i})" for i, t in enumerate(TIERS))
query(
    "P10_transition_matrix",
    f"""select f.t as from_tier, cast(f.i as bigint) as from_rank, g.t as to_tier, cast(g.i as bigint) as to_rank, coalesce(m.customers, 0) as customers
        from (values {_GRID}) f(t, i) join (values {_GRID}) g(t, i) on true left join moves m on m.from_tier = f.t and m.to_tier = g.t""",
)(lambda s, d: V.transition_matrix(*_two_runs(s, d), TIERS))
_V = TIERING["validation"]
_DRAWN = V.perturbed_weights(expert_weights(TIERING), _V["draws"], _V["perturbation"], _V["seed"])
_NAMES = list(_DRAWN[0])
PARTS["draw_weights"] = (
    f"select * from (values {', '.join('(' + ', '.join([str(i), *(f'cast({w[n]!r} as double)' for n in _NAMES)]) + ')' for i, w in enumerate(_DRAWN))})"
    f" t(draw, {', '.join(f'w_{n}' for n in _NAMES)})"
)
PARTS["draw_scores"] = f"""
select draw, p.customer_id, composite_score as x, tier as base_tier,
       round(least(greatest(({' + '.join(f'p.{n} * w_{n}' for n in _NAMES)}) * 100, 0.0), 100.0), 4) as y
from percentile_past p join draw_weights on true join tiers_past t on t.customer_id = p.customer_id"""
PARTS["draw_tau"] = """
select a.draw, sum(sign(a.x - b.x) * sign(a.y - b.y)) / (sqrt(sum(abs(sign(a.x - b.x)))) * sqrt(sum(abs(sign(a.y - b.y))))) as tau
from draw_scores a join draw_scores b on a.draw = b.draw and a.customer_id < b.customer_id group by a.draw"""
PARTS["draw_agreement"] = f"""
select draw, avg(cast({tier_case_sql()} = base_tier as int)) as agreement from (
  select *, row_number() over (partition by draw order by y desc, customer_id) / cast(count(*) over (partition by draw) as double) as share from draw_scores)
group by draw"""


def _sensitivity(spark, sf, run=V.weight_sensitivity) -> DataFrame:
    found = Inputs(spark, sf).run(BACKTEST)
    return run(found.normalized(), found.scored.weights, TIERING["tiers"], draws=_V["draws"], perturbation=_V["perturbation"], seed=_V["seed"])


query(
    "P11_weight_sensitivity",
    """select cast(count(*) as bigint) as iterations, avg(tau) as kendall_tau_mean, quantile_cont(tau, 0.05) as kendall_tau_p05,
              avg(agreement) as tier_agreement_mean, quantile_cont(agreement, 0.05) as tier_agreement_p05
       from draw_tau join draw_agreement using (draw)""",
    "kendall_tau_mean:9 kendall_tau_p05:9 tier_agreement_mean:9 tier_agreement_p05:9",
)(_sensitivity)
query("P11_sensitivity_draws", "select cast(draw as bigint) as draw, tau, agreement from draw_tau join draw_agreement using (draw)", "tau:9 agreement:9")(
    lambda s, d: _sensitivity(s, d, V.sensitivity_draws).withColumn("draw", F.col("draw").cast("bigint"))
)


_FITS: dict[tuple, B.Fitted] = {}


def stored_fit(spark, sf: str) -> Callable[..., B.Fitted]:
    """All three models out of fold, fitted once per application and data folder; the predictions are read back
    from a stored table, which a run that fits again would write again."""

    def fit(rows: DataFrame, inputs=MODEL_FEATURES, **settings) -> B.Fitted:
        key = (spark.sparkContext.applicationId, sf)
        if key not in _FITS:
            found, path = B.out_of_fold(rows, inputs, **settings), scratch_path(spark, "predictions")
            found.predictions.write.parquet(path)
            _FITS[key] = B.Fitted(spark.read.parquet(path), found.models, found.inputs)
        return _FITS[key]

    return fit


def all_models(spark, sf: str) -> B.Fitted:
    key = (spark.sparkContext.applicationId, sf)
    return _FITS[key] if key in _FITS else stored_fit(spark, sf)(judged(spark, sf), folds=_V["folds"], seed=_V["seed"])


def tested(spark, sf) -> R.Backtest:
    """The whole back-test with all three models."""
    inputs = Inputs(spark, sf)
    return R.backtest(inputs.orders, inputs.lines, inputs.customers, AS_OF, fit=stored_fit(spark, sf))


query(
    "P12_backtest",
    "select * from lift",
    "avg_score mean_future_revenue:3 median_future_revenue:5 revenue_share churn_rate high_value_rate high_value_lift",
)(lambda s, d: tested(s, d).lift)
query("P13_validation_metrics")(lambda s, d: R.validation_metrics(tested(s, d)))

# --- Q: baselines -----------------------------------------------------------------------------------


def fitted(spark, sf, *names: str) -> B.Fitted:
    return B.out_of_fold(judged(spark, sf), MODEL_FEATURES, models={n: B.MODELS[n] for n in names})


query("Q1_logistic_regression")(lambda s, d: fitted(s, d, "logistic_regression").predictions)
query("Q2_random_forest")(lambda s, d: fitted(s, d, "random_forest").predictions)


query("Q3_gradient_boosting")(
    lambda s, d: all_models(s, d).predictions.select("customer_id", "label", "composite_score", "gradient_boosting")
)


@query(
    "Q4_stratified_folds",
    """select high_value as label, f as fold, n // 5 + cast(f < n % 5 as bigint) as customers
       from (select high_value, count(*) as n from judged group by high_value) join range(5) r(f) on true""",
)
def _(spark, sf):
    base = judged(spark, sf).select("customer_id", F.col("high_value").alias("label"))
    folds = B.stratified_folds(base, "label", 5, 42)
    return folds.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("customers"))


PARTS["probability"] = "select composite_score / 100 as p, high_value as y from judged"


def _probability(spark, sf) -> DataFrame:
    return freeze(
        judged(spark, sf).select((F.col("composite_score") / 100).alias("p"), F.col("high_value").cast("double").alias("label"))
    )


query(
    "Q5_roc_auc",
    f"""select (sum(r) filter (where y = 1) - count(*) filter (where y = 1) * (count(*) filter (where y = 1) + 1) / 2.0)
               / (count(*) filter (where y = 1) * count(*) filter (where y = 0)) as roc_auc
        from (select y, {average_rank_sql('p')} as r from probability)""",
    "roc_auc",
)(lambda s, d: B.roc_auc(_probability(s, d), "p"))
query(
    "Q6_average_precision",
    """select sum(hits / positives * above_hits / above) as pr_auc from (
         select hits, sum(hits) over () as positives, sum(hits) over (order by p desc) as above_hits, sum(n) over (order by p desc) as above
         from (select p, cast(sum(y) as double) as hits, cast(count(*) as double) as n from probability group by p))""",
    "pr_auc",
)(lambda s, d: B.average_precision(_probability(s, d), "p"))
query("Q7_brier_score", "select avg((p - y) * (p - y)) as brier from probability", "brier")(
    lambda s, d: B.brier_score(_probability(s, d), "p")
)


PARTS["auc_rows"] = "select customer_id as key, composite_score / 100 as a, monetary_12m as b, high_value as y from judged"
add_resample("auc", "auc_rows")
PARTS["auc_places"] = f"""
select r, w, y, {weighted_place_sql('a', 'w * (1 - y)')} as pa, {weighted_place_sql('b', 'w * (1 - y)')} as pb from resample_auc"""
PARTS["auc_differences"] = """
select r, sum(w * y * (pa - pb)) / nullif(sum(w * y) * sum(w * (1 - y)), 0) as diff from auc_places group by r"""
PARTS["auc_both"] = f"select y, {average_rank_sql('a')} as ra, {average_rank_sql('b')} as rb from auc_rows"


@query(
    "Q8_paired_bootstrap_auc",
    """select (select (sum(ra) filter (where y = 1) - sum(rb) filter (where y = 1)) / (count(*) filter (where y = 1) * count(*) filter (where y = 0)) from auc_both) as auc_difference,
              quantile_cont(diff, 0.025) as ci_low, quantile_cont(diff, 0.975) as ci_high,
              least(1.0, 2 * least(count(*) filter (where diff <= 0), count(*) filter (where diff >= 0)) / cast(count(diff) as double)) as p_value
       from auc_differences""",
    "auc_difference:8 ci_low:8 ci_high:8 p_value:8",
)
def _(spark, sf):
    """The composite score against last year's revenue alone."""
    rows = judged(spark, sf).select(
        "customer_id", (F.col("composite_score") / 100).alias("a"), F.col("monetary_12m").alias("b"), F.col("high_value").cast("double").alias("label")
    )
    return B.paired_bootstrap_auc(freeze(rows), "a", "b")


@query("Q9_best_model")
def _(spark, sf):
    metrics = B.model_metrics(all_models(spark, sf))
    best = B.best_model(metrics).scalar()
    return metrics.withColumn("is_best", F.col("model") == best)


@query("Q10_feature_importance")
def _(spark, sf):
    return B.importances(all_models(spark, sf))


@query("Q11_weights_vs_importance")
def _(spark, sf):
    from acctiers.plans.scoring import expert_weights

    fit = all_models(spark, sf)
    best = B.best_model(B.model_metrics(fit)).first()[0]  # one row
    return B.weights_vs_importance(B.importances(fit), expert_weights(TIERING), best)


# --- R: whole runs ------------------------------------------------------------------------------------

_STORED = {
    "customer_tiers": "select concat(customer_id, ' ', tier) as item, composite_score as value from scored_now",
    "customer_tier_history": "select concat(customer_id, ' ', as_of_date), composite_score from history",
    "tier_weights": " union all ".join(f"select '{n}', cast({w!r} as double)" for n, w in expert_weights(TIERING).items()),
    "segment_profiles": "select 'customers', count(*) from scored_now",
    "backtest_lift": "select tier, round(mean_future_revenue, 2) from lift",
    "mart_customer_tiers": "select concat(customer_id, ' ', tier_movement), composite_score from mart_customer_tiers",
    "mart_tier_summary": "select tier, customers from mart_tier_summary",
    "mart_tier_movement": "select concat(as_of_date, ' ', from_tier, ' ', to_tier), customers from mart_tier_movement",
    "validation_metrics": "select 'kruskal_wallis_h', h_statistic from kw",
}


@query(
    "R4_run_tiering",
    " union all ".join(f"select '{name}' as stored, item, cast(value as double) as value from ({sql}) t(item, value)" for name, sql in _STORED.items()),
    "value:4",
)
def _(spark, sf):
    """Marts built and stored, history back-filled, one tiering run stored and published; all tables read back."""
    from acctiers.sources import testtables as T
    from acctiers.sources.store import Store

    store = Store(spark, scratch_path(spark, "tiering-run"))
    for name, table in T.raw_tables(spark, sf).items():
        store.write(table, f"raw/{name}", "replace")
    R.build_marts(store)
    R.backfill_history(store, list(RUN_DATES[:-1]), "earlier")
    R.run_tiering(store, AS_OF, "now", models={"logistic_regression": B.MODELS["logistic_regression"]})

    def rows(name: str, folder: str, item, value) -> DataFrame:
        return store.read(f"{folder}/{name}").select(F.lit(name).alias("stored"), item.alias("item"), value.cast("double").alias("value"))

    word = lambda *columns: F.concat_ws(" ", *[F.col(c).cast("string") for c in columns])
    profiles = store.read("tiering/segment_profiles").agg(F.sum("customers").alias("customers"))
    metrics = store.read("tiering/validation_metrics").where("metric = 'kruskal_wallis_h'")
    parts = [
        rows("customer_tiers", "tiering", word("customer_id", "tier"), F.col("composite_score")),
        rows("customer_tier_history", "tiering", word("customer_id", "as_of_date"), F.col("composite_score")),
        rows("tier_weights", "tiering", F.col("feature"), F.col("applied_weight")),
        profiles.select(F.lit("segment_profiles").alias("stored"), F.lit("customers").alias("item"), F.col("customers").cast("double").alias("value")),
        rows("backtest_lift", "tiering", F.col("tier"), F.round("mean_future_revenue", 2)),
        rows("mart_customer_tiers", "marts", word("customer_id", "tier_movement"), F.col("composite_score")),
        rows("mart_tier_summary", "marts", F.col("tier"), F.col("customers")),
        rows("mart_tier_movement", "marts", word("as_of_date", "from_tier", "to_tier"), F.col("customers")),
        metrics.select(F.lit("validation_metrics").alias("stored"), F.col("metric").alias("item"), F.col("value")),
    ]
    return reduce(DataFrame.unionByName, parts)
