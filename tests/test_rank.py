"""Whole-table ranks and quantiles against pandas, on data where one value holds 40 % of all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acctiers.operators import rank as R


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    n = 8000
    value = np.where(rng.random(n) < 0.4, 0.0, np.round(rng.normal(size=n), 2))
    frame = pd.DataFrame({"id": np.arange(n), "g": rng.integers(0, 3, n), "v": value})
    return frame, spark.createDataFrame(frame).repartition(5).cache()


def by_id(df):
    return df.toPandas().sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("method", ["average", "min"])
def test_average_rank_per_group(skewed, method):
    frame, df = skewed
    got = by_id(R.average_rank(df, "v", ["g"], total="n", method=method))
    want = frame.groupby("g")["v"].rank(method=method)
    assert np.array_equal(got["rank"], want)
    assert np.array_equal(got["n"], frame.groupby("g")["v"].transform("size"))


def test_average_rank_of_one_value_only(spark):
    df = spark.range(100).select("id", F.lit(3.0).alias("v"))
    assert {r["rank"] for r in R.average_rank(df, "v").collect()} == {50.5}


def test_ordinal_rank_breaks_ties_by_id(skewed):
    frame, df = skewed
    got = by_id(R.ordinal_rank(df, [F.col("v").desc(), F.col("id").asc()], partitions=7))
    assert np.array_equal(got["rank"], frame["v"].rank(ascending=False, method="first"))


def test_ordinal_rank_spreads_a_hot_value(skewed):
    _, df = skewed
    placed = R.sorted_positions(df, [F.col("v").desc(), F.col("id").asc()], 8)
    hot = placed.filter("v = 0").groupBy("_part").count().collect()
    assert len(hot) >= 3


def test_ordinal_rank_per_group(skewed):
    frame, df = skewed
    got = by_id(R.ordinal_rank(df, [F.col("v").desc(), F.col("id").asc()], total="n", by=["g"]))
    want = frame.groupby("g")["v"].rank(ascending=False, method="first")
    assert np.array_equal(got["rank"], want)


def test_running_total(skewed):
    frame, df = skewed
    got = R.running_total(df, [F.col("v").asc(), F.col("id").asc()], "v", partitions=6).toPandas().sort_values("rank")
    want = frame.sort_values(["v", "id"])["v"].cumsum().to_numpy()
    assert np.allclose(got["running"], want)
    assert np.allclose(got["total"], frame["v"].sum())


PROBS = [0, 0.01, 0.2, 0.5, 0.8, 0.99, 1.0]


def test_exact_quantiles(skewed):
    frame, df = skewed
    got = {(r["g"], r["p"]): r["quantile"] for r in R.exact_quantiles(df, "v", PROBS, ["g"]).collect()}
    want = frame.groupby("g")["v"].quantile(PROBS)
    assert len(got) == len(want)
    assert all(got[k] == pytest.approx(v, abs=1e-12) for k, v in want.items())


def test_quantiles_of_a_whole_table(skewed):
    frame, df = skewed
    got = R.exact_quantiles(df, "v", [0.31, 0.77]).collect()
    assert sorted(r["quantile"] for r in got) == pytest.approx(sorted(frame["v"].quantile([0.31, 0.77])))
    assert R.exact_quantiles(df.where("v is null"), "v", [0.5]).count() == 0
