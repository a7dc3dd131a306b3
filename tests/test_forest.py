"""Random forests from histograms: the same trees by every way, and what they find."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctiers.plans import baselines as B
from acctiers.plans import forest

SMALL = forest.Settings(numTrees=12, maxDepth=8)
INPUTS = ["x", "y", "z"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):
        x, y, z = (float(v) for v in rng.normal(size=3))
        hit = float(x > 0.4 and y > -0.5)
        rows.append((i, hit, i % 3, None if i % 11 == 0 else x, y, math.nan if i % 13 == 0 else z))
    return spark.createDataFrame(rows, "customer_id long, label double, fold int, x double, y double, z double").cache()


def _scores(rows):
    return {r["customer_id"]: r["value"] for r in rows.collect()}


@pytest.fixture(scope="module")
def grown(data):
    model, scores = forest.fit(data, INPUTS, [0, 1, 2, None], "customer_id", SMALL)
    return model, _scores(scores)


def test_finds_the_classes_and_scores_every_row_once(data, grown):
    model, scores = grown
    assert len(scores) == 1500
    hits = {r["customer_id"]: r["label"] for r in data.where("x is not null").collect()}
    assert np.mean([(scores[i] > 0.5) == (hits[i] == 1) for i in hits]) > 0.95
    parts = model.importances()
    assert parts.sum() == pytest.approx(1) and parts[2] < 0.1 < min(parts[:2])


def test_trees_do_not_depend_on_the_way(data, grown, monkeypatch):
    """Tables beyond one task are cut by passes first, and in several batches: same scores, same importances."""
    monkeypatch.setattr(forest, "GROUP_ROWS", 150)
    monkeypatch.setattr(forest, "BATCH_ROWS", 1500 * 10)
    model, scores = forest.fit(data.repartition(5), INPUTS, [0, 1, 2, None], "customer_id", SMALL)
    assert _scores(scores) == pytest.approx(grown[1], abs=1e-12)
    assert model.importances() == pytest.approx(grown[0].importances(), abs=1e-9)
    assert any(len(top.heap) > 1 for top in model.tops.values())
    both = [{r["customer_id"]: r["p"] for r in m.transform(data, "p").collect()} for m in (model, grown[0])]
    assert len(both[0]) == 1500 and both[0] == pytest.approx(both[1], abs=1e-12)


def test_scores_leave_a_task_summed(spark, data, grown, monkeypatch):
    """One packed row per fit and piece of its trees, not one row per tree and customer."""
    monkeypatch.setattr(forest, "TREES_PER_TASK", 5)
    model, scores = forest.fit(data, INPUTS, [0, 1, 2, None], "customer_id", SMALL)
    stored = spark.read.parquet(model.path.removesuffix("/kind=nodes"))
    kinds = {r["kind"]: r["count"] for r in stored.groupBy("kind").count().collect()}
    assert kinds["sums"] == 4 * 3 and kinds["nodes"] == 12 and "score" not in kinds
    assert _scores(scores) == pytest.approx(grown[1], abs=1e-12)


@pytest.mark.parametrize("width", [3, 9])
def test_cells_with_rows_give_the_cuts_of_all_cells(width):
    """A tree grown from the cells that hold rows is the one grown from dense counts, level by level."""
    rng = np.random.default_rng(5)
    settings = forest.Settings(maxDepth=7, minInstancesPerNode=3, bins=16)
    plan = forest.Plan([-1], np.zeros((1, width), np.uint8), np.array([[0.7, 1.9]]), width, 42, settings)
    bins = rng.integers(1, 16, (900, width)).astype(np.uint8)
    label = ((bins[:, 0] > 9) ^ (rng.random(900) < 0.2)).astype(np.uint8)
    n = plan.drawn(rng.integers(0, 1 << 62, 900), 4)
    nodes, gains = forest._grow(plan, 4, 0, bins, label, n)
    share, gained, ends = np.full(900, np.nan), np.zeros(width), [(0, np.arange(900), 0)]
    while ends:
        heap, rows, depth = ends.pop()
        chosen = plan.chosen(np.array([heap]), 4)
        counts = forest._counts(bins[rows], label[rows], n[rows], np.zeros(len(rows), int), chosen, 16)
        gain, feature, upto, part = forest._cut(counts, chosen, plan.weights[0], 3)
        if gain[0] and depth < 7:
            gained[feature[0]] += gain[0]
            left = bins[rows, feature[0]] <= upto[0]
            ends += [(2 * heap + 1, rows[left], depth + 1), (2 * heap + 2, rows[~left], depth + 1)]
        else:
            share[rows] = part[0]
    assert np.array_equal(nodes.share[nodes.place(bins)], share)
    assert gains == pytest.approx(gained, rel=1e-9)


def test_one_class_and_leaves_of_too_few_rows(spark):
    schema = "customer_id long, label double, fold int, x double"
    one = spark.createDataFrame([(i, 0.0, i % 2, float(i)) for i in range(30)], schema)
    _, scores = forest.fit(one, ["x"], [0, 1, None], "customer_id", forest.Settings(numTrees=3))
    assert set(_scores(scores).values()) == {0.0} and len(_scores(scores)) == 30
    few = spark.createDataFrame([(i, float(i > 1), i % 2, float(i)) for i in range(4)], schema)
    model, scores = forest.fit(few, ["x"], [0, 1, None], "customer_id", forest.Settings(numTrees=3))
    assert model.importances().sum() == 0 and len(_scores(scores)) == 4


def test_fits_read_partitions_by_row_count(spark, data):
    """The ranks that deal the folds leave one partition per shuffle partition, here 40; a fit needs one."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "40")
    seen = []
    real = forest.fit
    try:
        forest.fit = lambda rows, *rest: seen.append(rows.rdd.getNumPartitions()) or real(rows, *rest)
        judged = data.select("customer_id", F.col("label").alias("high_value"), F.lit(1.0).alias("composite_score"), *INPUTS)
        settings = {"random_forest": {"numTrees": 4, "minInstancesPerNode": 5, "maxDepth": 6}}
        found = B.out_of_fold(judged, INPUTS, folds=3, models=settings)
    finally:
        forest.fit = real
        if before is None:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        else:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", before)
    assert seen == [1]
    assert found.predictions.where("random_forest between 0 and 1").count() == 1500
