"""Features, scores, tiers and statistics on small tables and known numbers."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acctiers.functions import tails
from acctiers.plans import features as FT
from acctiers.plans import scoring as SC
from acctiers.plans import tiers as TR
from acctiers.plans import validation as V
from acctiers.session import literal_rows
from acctiers.settings import merge, SCORE_FEATURES, TIERING

AS_OF = date(2026, 6, 30)
NAMES = list(SCORE_FEATURES)


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(11)
    n = 900
    start = date(2024, 7, 1)
    status = rng.choice(["completed", "returned", "cancelled"], n, p=[0.8, 0.1, 0.1])
    rows, lines = [], []
    for i in range(n):
        day = start + timedelta(days=int(rng.integers(0, 900)))
        paid = day + timedelta(days=int(rng.integers(0, 60))) if rng.random() < 0.8 else None
        # customer 1 holds about a third of all orders
        customer = 1 if rng.random() < 0.33 else int(rng.integers(2, 60))
        net = round(float(rng.uniform(10, 5000)), 2)
        rows.append((i, customer, day, str(status[i]), net, round(net * 0.4, 2), 0.05, 30, paid))
        lines += [(i, customer, day, str(status[i]), f"cat{int(c)}") for c in rng.integers(0, 5, 2)]
    orders = spark.createDataFrame(
        rows,
        "order_id int, customer_id int, order_date date, status string, net_revenue double, gross_margin double, "
        "discount_pct double, payment_terms_days int, paid_date date",
    ).cache()
    line_frame = spark.createDataFrame(
        lines, "order_id int, customer_id int, order_date date, status string, category string"
    ).cache()
    customers = spark.range(1, 61).select(
        F.col("id").cast("int").alias("customer_id"),
        F.lit("x").alias("industry"),
        F.lit("West").alias("region"),
        F.when(F.col("id") % 9 != 0, F.col("id").cast("string")).alias("employee_count"),
        F.lit(date(2024, 1, 1)).alias("signup_date"),
    )
    return orders, line_frame, customers


@pytest.fixture(scope="module")
def run(frames):
    return TR.score_customers(*frames, AS_OF)


def test_features_match_a_direct_count(frames):
    orders, lines, customers = frames
    got = FT.build_features(orders, lines, customers, AS_OF).toPandas().set_index("customer_id")
    o = orders.toPandas()
    start = AS_OF - timedelta(days=365)
    window = o[(o.order_date > start) & (o.order_date <= AS_OF)]
    done = window[window.status == "completed"]
    one = done[done.customer_id == 1]
    row = got.loc[1]
    assert set(got.index) == set(done.customer_id)
    assert row.monetary_12m == pytest.approx(one.net_revenue.sum())
    assert row.frequency_12m == len(one)
    assert row.recency_days == (AS_OF - one.order_date.max()).days
    months = {(d.year, d.month) for d in one.order_date}
    assert row.active_month_ratio == pytest.approx(len(months) / (365 / 30.4))
    half = start + timedelta(days=182)
    h1, h2 = one[one.order_date <= half].net_revenue.sum(), one[one.order_date > half].net_revenue.sum()
    assert row.revenue_growth == pytest.approx((h2 - h1) / (h1 + h2))
    returned = (window[window.customer_id == 1].status == "returned").sum()
    assert row.return_rate == pytest.approx(returned / (returned + len(one)))
    due = [d + timedelta(days=30) for d in one.order_date]
    late = []
    for paid, limit in zip(one.paid_date, due, strict=True):
        known = pd.notna(paid) and paid <= AS_OF
        if known or limit < AS_OF:
            late.append(paid > limit if known else limit < AS_OF)
    assert row.late_payment_rate == pytest.approx(np.mean(late))


def test_features_do_not_see_the_future(frames):
    orders, lines, customers = frames
    day = date(2025, 12, 1)
    later = F.col("order_date") > F.lit(day)
    changed = orders.withColumns(
        {
            "net_revenue": F.when(later, F.col("net_revenue") * 100).otherwise(F.col("net_revenue")),
            "status": F.when(later, "completed").otherwise(F.col("status")),
        }
    )
    before = FT.build_features(orders, lines, customers, day).orderBy("customer_id").collect()
    assert before == FT.build_features(changed, lines, customers, day).orderBy("customer_id").collect()


def test_several_dates_equal_single_dates(frames):
    days = [date(2025, 12, 1), AS_OF]
    both = FT.build_features_multi(*frames, days).toPandas().set_index(["as_of_date", "customer_id"]).sort_index()
    for day in days:
        one = FT.build_features(*frames, day).toPandas().set_index("customer_id").sort_index()
        pd.testing.assert_frame_equal(both.loc[day], one.drop(columns="as_of_date"), check_like=True)


def test_scores_against_pandas(run):
    feats = run.features.toPandas().sort_values("customer_id").set_index("customer_id")
    total = 0.0
    for name, spec in TIERING["features"].items():
        s = feats[name].astype(float)
        s = s.fillna(s.median())
        if spec["transform"] == "log1p":
            s = np.log1p(s.clip(lower=0))
        s = s.clip(s.quantile(0.01), s.quantile(0.99)) * spec["direction"]
        total = total + s.rank(pct=True) * spec["weight"]
    got = run.tiers.toPandas().sort_values("customer_id").set_index("customer_id")["composite_score"]
    assert np.allclose(got, (total * 100).round(4), atol=1.01e-4)
    assert got.between(0, 100).all()
    assert np.corrcoef(got, feats["recency_days"])[0, 1] < 0


def test_tiers_follow_from_stored_scores(run):
    tiers = TR.assign_tiers(run.scored.scores, TIERING["tiers"], by=["as_of_date"]).select("customer_id", "tier")
    assert sorted(tiers.collect()) == sorted(run.tiers.select("customer_id", "tier").collect())


def two_dates(spark):
    """Two features on two dates; the second feature is unknown on the second date and spreads differently on both."""
    first = [("2026-01-01", i, float(i), float(i % 3)) for i in range(1, 31)]
    second = [("2026-02-01", i, float(i * i), None) for i in range(1, 31)]
    rows = spark.createDataFrame(first + second, "day string, customer_id bigint, a double, b double")
    return rows.select(F.col("day").cast("date").alias("as_of_date"), "customer_id", "a", "b")


TWO = {"a": {"weight": 0.5, "direction": 1, "transform": "none"}, "b": {"weight": 0.5, "direction": 1, "transform": "none"}}


def test_a_date_without_values_gets_the_default_not_another_dates_median(spark):
    both = two_dates(spark)
    together = SC.prepare(both, TWO, None).filter("as_of_date = date '2026-02-01'").select("customer_id", "b").collect()
    alone = SC.prepare(both.filter("as_of_date = date '2026-02-01'"), TWO, None).select("customer_id", "b").collect()
    assert sorted(together) == sorted(alone) and {r["b"] for r in together} == {0.0}


@pytest.mark.parametrize("weighting", ["entropy", "blend"])
def test_data_driven_weights_are_found_per_date(spark, weighting):
    cfg = {"features": TWO, "weighting": weighting, "normalization": "percentile", "winsor": None}
    both = two_dates(spark).withColumn("b", F.coalesce("b", F.col("customer_id") % 7.0))
    together = SC.composite_score(both, cfg)
    for day, weights in together.by_day.items():
        alone = SC.composite_score(both.filter(F.col("as_of_date") == F.lit(day)), cfg)
        assert alone.weights == pytest.approx(weights)
        mine = together.scores.filter(F.col("as_of_date") == F.lit(day)).select("customer_id", "composite_score").collect()
        assert sorted(mine) == sorted(alone.scores.select("customer_id", "composite_score").collect())
    with pytest.raises(ValueError, match="different weights"):
        together.weights


def test_unknown_settings_are_an_error_and_published_names_are_read():
    with pytest.raises(ValueError, match="unknown setting"):
        merge(TIERING, {"weigthing": "entropy"})
    with pytest.raises(ValueError, match="validation.fold"):
        merge(TIERING, {"validation": {"fold": 3}})
    cfg = merge(TIERING, {"weighting_method": "entropy", "winsorize_quantiles": [0.05, 0.95], "segmentation": {"k_range": [3, 4], "random_state": 7},
                          "tiers": [{"name": "A", "share": 0.4}, {"name": "B", "share": 0.6}], "validation": {"cv_folds": 3}})
    assert (cfg["weighting"], cfg["winsor"], cfg["segments"]["seed"], cfg["tiers"]) == ("entropy", [0.05, 0.95], 7, (("A", 0.4), ("B", 0.6)))
    assert cfg["validation"]["folds"] == 3


@pytest.mark.parametrize("method", ["minmax", "zscore"])
def test_other_normalizations_stay_in_bounds(run, method):
    oriented = run.scored.oriented
    wide = SC.normalize(oriented, NAMES, method).toPandas()
    assert wide[NAMES].min().min() >= 0 and wide[NAMES].max().max() <= 1


def test_weights(run):
    entropy = SC.entropy_weights(run.scored.oriented, NAMES)
    assert sum(entropy.values()) == pytest.approx(1)
    expert = SC.expert_weights(TIERING)
    blend = SC.resolve_weights("blend", expert, entropy)
    assert blend["monetary_12m"] == pytest.approx((expert["monetary_12m"] + entropy["monetary_12m"]) / 2)
    with pytest.raises(ValueError):
        SC.resolve_weights("other", expert, entropy)
    with pytest.raises(ValueError):
        SC.scale_to_one({"a": 0.0})


def test_tier_shares(spark):
    scores = spark.range(1000).select("id", (F.col("id") * 100 / 999).alias("s"))
    tiered = TR.assign_tiers(scores, TIERING["tiers"], "s", "id")
    counts = {r["tier"]: r["count"] for r in tiered.groupBy("tier").count().collect()}
    assert counts == {"Platinum": 100, "Gold": 200, "Silver": 300, "Bronze": 400}
    assert tiered.filter("id = 999").first()["tier"] == "Platinum"


def test_no_active_customer_is_an_error(frames):
    with pytest.raises(ValueError):
        TR.score_customers(*frames, date(1990, 1, 1))


def test_labels(frames, run):
    orders, _, _ = frames
    labels = FT.forward_labels(orders, run.features, AS_OF, 180).toPandas()
    threshold = labels.future_revenue.quantile(0.8)
    assert ((labels.future_revenue > threshold).astype(int) == labels.high_value).all()
    assert ((labels.future_orders == 0).astype(int) == labels.churned).all()


def test_holm(spark):
    p = literal_rows(spark, [(1, 0.01), (2, 0.04), (3, 0.03)], "i int, p_value double")
    got = [r["p_holm"] for r in V.holm_adjust(p).orderBy("i").collect()]
    assert got == pytest.approx([0.03, 0.06, 0.06])


def test_psi(spark):
    normal = spark.range(5000).select(F.randn(1).alias("v")).cache()
    same = spark.range(5000).select(F.randn(2).alias("v")).cache()
    moved = same.select((F.col("v") + 1).alias("v"))
    assert V.population_stability_index(normal, same, "v").first()[0] < 0.02
    assert V.population_stability_index(normal, moved, "v").first()[0] > 0.2


def test_tails_against_tables():
    assert tails.chi2_upper(7.814728, 3) == pytest.approx(0.05, abs=1e-7)
    assert tails.chi2_upper(464.1, 3) == pytest.approx(2.87e-100, rel=0.01)
    assert tails.f_upper(264.1, 3, 789) == pytest.approx(1.22e-118, rel=0.01)
    assert tails.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert tails.normal_upper(1.959964) == pytest.approx(0.025, abs=1e-7)


def test_separation_tests_find_a_clear_order(spark):
    judged = spark.range(400).select(
        F.col("id").alias("customer_id"),
        F.element_at(F.array(*[F.lit(t) for t in ("Platinum", "Gold", "Silver", "Bronze")]), (F.col("id") % 4 + 1).cast("int")).alias("tier"),
        (F.col("id") % 4 + 1).cast("int").alias("tier_rank"),
        (100 - 20 * (F.col("id") % 4)).cast("double").alias("composite_score"),
        (1000 - 300 * (F.col("id") % 4) + F.col("id") % 50).cast("double").alias("future_revenue"),
        (F.col("id") % 4 == 3).cast("int").alias("churned"),
        (F.col("id") % 4 == 0).cast("int").alias("high_value"),
    ).cache()
    pairs = V.adjacent_tier_tests(judged).orderBy("pair").collect()
    assert [r["prob_superiority"] for r in pairs] == [1.0, 1.0, 1.0]
    assert all(r["significant"] for r in pairs)
    assert V.kruskal_wallis(judged).first()["p_value"] < 1e-50
    assert V.churn_chi_square(judged).first()["cramers_v"] == pytest.approx(1.0)
    assert V.monotonic_outcomes(judged).first() == (True, True)
    boot = V.bootstrap_spearman(judged, "composite_score", "future_revenue", 200).first()
    assert boot["ci_low"] - 0.01 <= boot["spearman_rho"] <= boot["ci_high"] + 0.01


@pytest.mark.parametrize("bins", [4, 1024])
def test_sensitivity_counts_agree_with_pandas(run, bins):
    """Tier agreement of each draw, redone row by row in pandas."""
    weights = run.scored.weights
    got = {
        r["draw"]: (r["tau"], r["agreement"])
        for r in V.sensitivity_draws(run.normalized(), weights, TIERING["tiers"], draws=4, bins=bins).collect()
    }
    frame = run.normalized().toPandas().sort_values("customer_id").set_index("customer_id")

    def tiers(w):
        score = (sum(frame[n] * v for n, v in w.items()) * 100).clip(0, 100).round(4)
        share = score.rank(ascending=False, method="first") / len(score)
        return score, pd.cut(share - 1e-12, [-1, 0.1, 0.3, 0.6, 2], labels=False)

    base_score, base = tiers(weights)
    for draw, w in enumerate(V.perturbed_weights(weights, 4, 0.2, 42)):
        score, tier = tiers(w)
        tau, agreement = got[draw]
        assert agreement == pytest.approx((tier == base).mean())
        a, b = np.sign(np.subtract.outer(*[base_score.to_numpy()] * 2)), np.sign(np.subtract.outer(*[score.to_numpy()] * 2))
        want = (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())
        assert tau == pytest.approx(want)


def test_stability_of_a_run_with_itself(run):
    row = V.tier_stability(run.tiers, run.tiers, ["Platinum", "Gold", "Silver", "Bronze"]).first()
    assert row["same_tier_rate"] == 1 and row["weighted_kappa"] == 1
    assert row["score_psi"] == pytest.approx(0, abs=1e-12)
