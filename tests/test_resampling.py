"""Exact rank statistics over many partitions and blocks, against pair counts and plain numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acctiers.plans import resampling as RS
from acctiers.plans import validation as V
from acctiers.plans.scoring import weighted_score


def tau_b(x, y):
    a, b = (np.sign(np.subtract.outer(v, v)) for v in (x, y))
    norm = np.sqrt((a * a).sum() * (b * b).sum())
    return (a * b).sum() / norm if norm else None


def test_signed_pairs_of_blocks():
    rng = np.random.default_rng(1)
    block, x, y, n = rng.integers(0, 5, 400) * 7, rng.integers(0, 30, 400).astype(float), rng.random(400).round(2), rng.integers(1, 4, 400)
    want = []
    for b in np.unique(block):
        k = block == b
        sign = np.sign(np.subtract.outer(x[k], x[k])) * np.sign(np.subtract.outer(y[k], y[k]))
        want.append(int((sign * np.outer(n[k], n[k])).sum() / 2))
    assert V.signed_pairs(block, x, y, n).tolist() == want
    assert V.signed_pairs(*(np.empty(0, int) for _ in range(4))).tolist() == []


@pytest.mark.parametrize("cuts", [1, 3, 40])
@pytest.mark.parametrize("bucket", [50, 400_000])
def test_tau_does_not_depend_on_the_blocks(spark, monkeypatch, cuts, bucket):
    """5,000 customers a draw, a value that fills a third of them, and any number of blocks: equal to pair counting."""
    monkeypatch.setattr(V, "BUCKET_POINTS", bucket * 100)
    rng = np.random.default_rng(2)
    frames, want = [], {}
    for draw in range(2):
        x = np.where(rng.random(5000) < 0.3, 0.0, rng.random(5000).round(3))
        y = (x + rng.normal(0, 0.3, 5000)).round(2)
        want[draw] = tau_b(x, y)
        edges = [np.quantile(v, np.linspace(0, 1, cuts + 1)[1:-1]) for v in (x, y)]
        frames.append(pd.DataFrame({"draw": draw, "bx": np.searchsorted(edges[0], x, "right"), "by": np.searchsorted(edges[1], y, "right"), "x": x, "y": y}))
    points = spark.createDataFrame(pd.concat(frames)).withColumn("draw", F.col("draw").cast("int"))
    got = {r["draw"]: r["tau"] for r in V.kendall_tau(points, 5000).collect()}
    assert got == {d: pytest.approx(t, abs=1e-13) for d, t in want.items()}


def test_tau_without_spread_is_null(spark):
    points = spark.createDataFrame([(0, 0, 0, 1.0, float(i)) for i in range(5)], "draw int, bx int, by int, x double, y double")
    assert V.kendall_tau(points, 5).first()["tau"] is None


def test_scores_of_draws_round_as_spark_does(spark):
    """Halves of the last place, nulls, not-a-numbers and totals beyond 0..100."""
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b)) for a, b in zip(rng.integers(0, 2_000_001, 3000) / 2e6, rng.integers(-20, 30, 3000) / 16, strict=True)]
    rows += [(None, 0.5), (0.5, None), (float("nan"), 0.1), (0.0, 0.0), (0.1234565, 0.0), (0.5, 9.0)]
    frame = spark.createDataFrame(rows, "a double, b double")
    weights = [{"a": 1.0, "b": 0.0}, {"a": 0.7, "b": 0.3}, {"a": 0.3, "b": 0.1}]
    found = V._Draws(weights, [])
    features, null = found.features(frame.toArrow())
    for draw, w in enumerate(weights):
        want = [r[0] for r in frame.select(weighted_score(w)).collect()]
        total = [None if a is None or b is None else a for a, b in rows]
        want = [v if t is not None else 0.0 for v, t in zip(want, total, strict=True)]
        assert (found.scores(features, null, draw) / 10_000).tolist() == want


@pytest.mark.parametrize("bins", [1, 6, 200])
def test_draws_over_many_buckets(spark, monkeypatch, bins):
    """Equal scores across tier bounds, a third of the customers alike, points moved a few customers at a time: as counted pair by pair;
    no row but the customers is copied to every draw."""
    monkeypatch.setattr(V, "BUCKET_CUSTOMERS", 40)
    monkeypatch.setattr(V, "BUCKET_POINTS", 300)
    monkeypatch.setattr(V, "SPAN_CUSTOMERS", 50)
    monkeypatch.setattr(V.F, "explode", None)  # draws are worked out inside tasks
    rng = np.random.default_rng(8)
    n, names, tiers = 400, ["a", "b", "c"], [("Gold", 0.25), ("Silver", 0.35), ("Bronze", 0.4)]
    frame = pd.DataFrame({"customer_id": rng.permutation(n) + 10**12, **{c: (rng.integers(0, 11, n) / 10) for c in names}})
    frame.loc[rng.random(n) < 0.3, names] = 0.5
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    got = {r["draw"]: (r["tau"], r["agreement"]) for r in V.sensitivity_draws(spark.createDataFrame(frame), weights, tiers, 5, 0.9, 3, bins).collect()}

    def judged(w):
        score = (sum(frame[c] * v for c, v in w.items()) * 100).clip(0, 100).round(4).to_numpy()
        place = np.empty(n, int)
        place[np.lexsort((frame["customer_id"], -score))] = np.arange(1, n + 1)
        return score, np.where(place / n - 1e-12 <= 0.25, "Gold", np.where(place / n - 1e-12 <= 0.6, "Silver", "Bronze"))

    x, base = judged(weights)
    assert len(got) == 5
    for draw, w in enumerate(V.perturbed_weights(weights, 5, 0.9, 3)):
        y, tier = judged(w)
        assert got[draw] == (pytest.approx(tau_b(x, y), abs=1e-12), pytest.approx((tier == base).mean(), abs=1e-12))


def table(n=700, seed=3):
    rng = np.random.default_rng(seed)
    x = np.where(rng.random(n) < 0.35, 0.0, rng.integers(0, 40, n)).astype(float)  # a hot value over many partitions
    y = np.where(rng.random(n) < 0.5, -0.0, x + rng.normal(0, 20, n))
    return pd.DataFrame({"customer_id": rng.permutation(n) + 10**12, "x": x, "y": y, "label": (rng.random(n) < 0.3).astype(float), "part": "extra"})


def places(v, w):
    return np.array([w[v < a].sum() + w[v == a].sum() / 2 for a in v])


def own_weights(frame, replicates, seed):
    return RS.weights(frame["customer_id"].to_numpy(), 0, replicates, seed)


@pytest.mark.parametrize("rows,step", [(7, 4), (100, 3), (10_000, 250)])
def test_weighted_spearman_over_partitions(spark, monkeypatch, rows, step):
    monkeypatch.setattr(RS, "PART_ROWS", rows)
    monkeypatch.setattr(RS, "PASS", step)
    frame = table(300)
    got = {r["replicate"]: r["rho"] for r in RS.spearman_draws(spark.createDataFrame(frame), "x", "y", "customer_id", 9, 5).collect()}
    w = own_weights(frame, 9, 5)
    for r in range(9):
        a, b = (places(frame[c].to_numpy() + 0.0, w[:, r]) for c in ("x", "y"))
        c = np.cov(a, b, fweights=w[:, r])
        assert got[r] == pytest.approx(c[0, 1] / np.sqrt(c[0, 0] * c[1, 1]), abs=1e-12)
    assert len(got) == 9


@pytest.mark.parametrize("rows", [11, 10_000])
def test_weighted_auc_difference(spark, monkeypatch, rows):
    monkeypatch.setattr(RS, "PART_ROWS", rows)
    frame = table(250, 4)
    got = {r["replicate"]: r["diff"] for r in RS.auc_difference_draws(spark.createDataFrame(frame), "x", "y", "label", "customer_id", 6, 1).collect()}
    w, one = own_weights(frame, 6, 1), frame["label"].to_numpy() == 1
    for r in range(6):
        area = [(w[one, r] * np.array([w[~one & (v < a), r].sum() + w[~one & (v == a), r].sum() / 2 for a in v[one]])).sum() for v in (frame["x"].to_numpy(), frame["y"].to_numpy())]
        assert got[r] == pytest.approx((area[0] - area[1]) / (w[one, r].sum() * w[~one, r].sum()), abs=1e-12)


def test_weights_are_poisson_and_their_own():
    w = RS.weights(np.arange(2000), 0, 500, 42)
    assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.02)
    assert (RS.weights(np.arange(2000), 100, 3, 42) == w[:, 100:103]).all()
    assert (RS.weights(np.arange(2000), 0, 500, 43) != w).mean() > 0.5
    assert abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.1 and abs(np.corrcoef(w[0], w[1])[0, 1]) < 0.2


def test_empty_and_null_rows(spark):
    none = spark.createDataFrame([], "customer_id bigint, x double, y double, label double")
    assert RS.spearman_draws(none, "x", "y", "customer_id", 5, 1).count() == 0
    assert RS.auc_difference_draws(none, "x", "y", "label", "customer_id", 5, 1).count() == 0
    one = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 3.0), ("c", 4.0, None)], "customer_id string, x double, y double")
    assert [r["rho"] for r in RS.spearman_draws(one, "x", "y", "customer_id", 3, 1).collect()] == [None] * 3
