"""Boosted trees against trees grown row by row, over partitions, nulls and odd tables."""

import math

import numpy as np
import pandas as pd
import pytest

from acctiers.plans import boosting as X

INPUTS = ["a", "b", "c"]
SCHEMA = "id bigint, label double, fold int, a double, b double, c double"


def rows(n: int, seed: int = 5) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    out = pd.DataFrame({"id": np.arange(n), **{c: np.round(rng.normal(size=n), 1) for c in INPUTS}})
    out["label"] = ((out.a * out.b + out.c + rng.normal(size=n) * 0.3) > 0.3).astype(float)
    out["fold"] = (np.arange(n) % 3).astype("int32")
    out.loc[rng.random(n) < 0.15, "c"] = np.nan
    return out[["id", "label", "fold", *INPUTS]]


def frame(spark, pdf):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(), SCHEMA)


def grown(x, y, settings, edges):
    """Margins of all rows after every round, by plain recursion over rows; no draws."""
    margin = np.full(len(y), math.log((y.sum() + 1e-6) / (len(y) - y.sum() + 1e-6)))
    value = lambda g, h: g.sum() ** 2 / (h.sum() + settings.ridge)

    def node(at, depth, g, h, out):
        best = None
        if depth < settings.depth:
            for j in range(x.shape[1]):
                for cut in edges[j]:
                    for missing in (True, False):
                        left = np.where(np.isnan(x[at, j]), missing, x[at, j] <= cut)
                        one, two = at[left], at[~left]
                        if h[one].sum() < settings.least or h[two].sum() < settings.least:
                            continue
                        gain = value(g[one], h[one]) + value(g[two], h[two]) - value(g[at], h[at])
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, one, two)
        if best is None:
            out[at] = -settings.step * g[at].sum() / (h[at].sum() + settings.ridge)
        else:
            node(best[1], depth + 1, g, h, out)
            node(best[2], depth + 1, g, h, out)

    for _ in range(settings.rounds):
        p = 1 / (1 + np.exp(-margin))
        out = np.zeros(len(y))
        node(np.arange(len(y)), 0, p - y, p * (1 - p), out)
        margin = margin + out
    return margin


def test_same_as_trees_grown_row_by_row(spark):
    pdf = rows(160)
    settings = X.Settings(rounds=3, depth=3, step=0.3, rows=1.0, features=1.0, bins=16, keep=2)
    model, margins = X.fit(frame(spark, pdf), INPUTS, [0, None], "id", settings)
    got = np.array(margins.toPandas().sort_values("id")["margins"].tolist())
    for fit, keep in ((0, pdf.fold != 0), (1, pdf.fold >= 0)):
        part = pdf[keep]
        want = grown(part[INPUTS].to_numpy(), part.label.to_numpy(), settings, model.edges)
        assert np.allclose(got[keep.to_numpy(), fit], want, atol=1e-6)


def test_same_trees_however_rows_are_cut(spark, monkeypatch):
    df, settings = frame(spark, rows(300)), X.Settings(rounds=4, keep=3)
    one, kept = X.fit(df, INPUTS, [0, 1, 2, None], "id", settings)
    monkeypatch.setattr(X, "ROWS_IN_ONE_TASK", 10)  # a job per level, several tasks
    monkeypatch.setattr(X, "ROWS_PER_TASK", 70)
    two, again = X.fit(df.orderBy("a"), INPUTS, [0, 1, 2, None], "id", settings)
    for a, b in zip(one.trees, two.trees, strict=True):
        for field in ("feature", "upto", "missing", "leaf"):
            assert np.array_equal(getattr(a, field), getattr(b, field))
    assert sorted(kept.toPandas().margins.map(tuple)) == sorted(again.toPandas().margins.map(tuple))


def test_a_task_per_fit_also_beyond_100_000_rows(spark, monkeypatch):
    """No job per level at that size, and each fit has the trees of the passes over partitions."""
    df = spark.range(101_000).selectExpr(
        "id", "cast(id % 7 < 2 as double) label", "cast(id % 3 as int) fold", "id % 7 + id % 11 / 4.0 a", "cast(id % 13 as double) b", "cast(null as double) c"
    )
    jobs, real = [], X._job
    monkeypatch.setattr(X, "_job", lambda *rest: jobs.append(1) or real(*rest))
    one, _ = X.fit(df, INPUTS, [0, 1, None], "id", X.Settings(rounds=2))
    assert not jobs and len(one.trees) == 2 and one.splits.min(1).tolist() == [0, 0, 0] and one.splits.max() > 0
    monkeypatch.setattr(X, "ROWS_IN_ONE_TASK", 100_000)
    two, _ = X.fit(df, INPUTS, [0, 1, None], "id", X.Settings(rounds=2))
    assert len(jobs) == 8 and np.array_equal(one.gain, two.gain)
    for a, b in zip(one.trees, two.trees, strict=True):
        assert all(np.array_equal(getattr(a, name), getattr(b, name)) for name in ("feature", "upto", "missing", "leaf"))


def test_model_scores_rows_like_its_margins(spark):
    df = frame(spark, rows(200))
    model, margins = X.fit(df, INPUTS, [0, 1, 2, None], "id", X.Settings(rounds=12, keep=5))
    kept = margins.toPandas().sort_values("id")
    scored = model.transform(df.selectExpr("*", "'x' as margins"), "p").toPandas().sort_values("id")
    assert list(scored.margins.unique()) == ["x"]  # a column of the table keeps its name and value
    assert np.allclose(scored.p, 1 / (1 + np.exp([-m[3] for m in kept.margins])))
    out = X.held_out(margins, "id", "p").toPandas().sort_values("id")
    assert np.allclose(out.p, 1 / (1 + np.exp([-m[f] for m, f in zip(kept.margins, kept.fold, strict=True)])))
    assert model.importances().argmax() == 2


def test_held_out_rows_are_ranked_well(spark):
    pdf = rows(900)
    _, margins = X.fit(frame(spark, pdf), INPUTS, [0, 1, 2, None], "id", X.Settings(rounds=25, step=0.2))
    p = X.held_out(margins, "id", "p").toPandas().merge(pdf, on="id")
    good, bad = p[p.label == 1].p.to_numpy(), p[p.label == 0].p.to_numpy()
    assert (good[:, None] > bad).mean() > 0.85


@pytest.mark.parametrize("values", [[], [(1, 1.0, 0, 2.0, None, float("nan")), (2, 1.0, 1, 2.0, None, None), (3, None, 0, 1.0, 1.0, 1.0)]])
def test_empty_tables_and_one_class(spark, values):
    model, margins = X.fit(spark.createDataFrame(values, SCHEMA), INPUTS, [0, None], "id", X.Settings(rounds=2))
    assert margins.count() == sum(v[1] is not None for v in values)
    assert all((t.upto == model.settings.bins).all() for t in model.trees)
    assert not model.splits.any()
