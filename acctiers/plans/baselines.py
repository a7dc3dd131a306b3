"""Supervised baselines on the same features, and how far the composite score is from them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctiers.operators.rank import average_rank, ordinal_rank
from acctiers.plans import boosting, forest
from acctiers.plans.resampling import auc_difference_draws
from acctiers.session import freeze, literal_rows, reload

# --- fixed values: model settings --------------------------------------------------------------
MODELS = {
    "logistic_regression": {"maxIter": 2000},
    "random_forest": {"numTrees": 300, "minInstancesPerNode": 5, "maxDepth": 30},
    "gradient_boosting": {"rounds": 300, "depth": 4, "step": 0.05, "rows": 0.8, "features": 0.8},
}

TOGETHER = ("gradient_boosting", "random_forest")  # one call grows all fits
ROWS_PER_TASK = 50_000


def stratified_folds(df: DataFrame, label: str, folds: int, seed: int) -> DataFrame:
    """Fold = place in hash order within the class, modulo the fold count: sizes differ by one at most."""
    order = [F.col(label).asc(), F.xxhash64("customer_id", F.lit(seed)).asc(), F.col("customer_id").asc()]
    placed = ordinal_rank(df, order, "_place")
    starts = placed.groupBy(label).agg(F.min("_place").alias("_start"))  # one row per class
    return placed.join(F.broadcast(starts), label).select(
        *df.columns, ((F.col("_place") - F.col("_start")) % folds).cast("int").alias("fold")
    )


def _pipeline(inputs: Sequence[str], rows: int, settings: dict) -> Pipeline:
    filled = [f"{c}_filled" for c in inputs]
    common = {"labelCol": "label", "probabilityCol": "probability", "featuresCol": "_scaled", "weightCol": "weight"}
    return Pipeline(
        stages=[
            Imputer(strategy="median", relativeError=1e-4, inputCols=list(inputs), outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True),
            # inverse strength 1 over weights that add up to the row count
            LogisticRegression(**common, regParam=1.0 / rows, standardization=False, **settings),
        ]
    )


def _balanced(train: DataFrame, counts: dict[int, int]) -> DataFrame:
    total, classes = sum(counts.values()), len(counts)
    weight = reduce(
        lambda acc, item: acc.when(F.col("label") == item[0], total / (classes * item[1])),
        counts.items(),
        F.when(F.lit(False), 0.0),
    )
    return train.withColumn("weight", weight)


def _detached(model: PipelineModel) -> PipelineModel:
    """The pipeline without its training summary (see ``reload``): a linear model is small enough to save and read back."""
    return reload(SparkSession.active(), model)


@dataclass
class Fitted:
    predictions: DataFrame  # customer_id, label, composite_score, one out-of-fold probability per model
    models: dict[str, PipelineModel | boosting.Boosted | forest.Forest]
    inputs: list[str]


def out_of_fold(
    judged: DataFrame,
    inputs: Sequence[str],
    label: str = "high_value",
    folds: int = 5,
    seed: int = 42,
    models: dict | None = None,
    parallel: int = 6,
) -> Fitted:
    """Out-of-fold probability of every customer under every model, and a final fit on all rows.

    The linear model takes one fit per fold; both kinds of trees grow for all folds and the final fit together.
    """
    models = models or MODELS
    base = judged.select(
        "customer_id",
        F.col(label).cast("double").alias("label"),
        "composite_score",
        *[F.col(c).cast("double").alias(c) for c in inputs],
    )
    placed = freeze(stratified_folds(base, "label", folds, seed))
    # ranking leaves as many partitions as the session shuffles to, which every pass of a fit would pay for
    data = freeze(placed.repartition(max(1, math.ceil(placed.count() / ROWS_PER_TASK)), "customer_id"))
    sizes = {(r["fold"], r["label"]): r["count"] for r in data.groupBy("fold", "label").count().collect()}  # folds x 2

    def counts(leave_out: int | None) -> dict[float, int]:
        out: dict[float, int] = {}
        for (fold, y), n in sizes.items():
            if fold != leave_out:
                out[y] = out.get(y, 0) + n
        return out

    def fit(task: tuple[str, int | None]):
        name, fold = task
        if name == "gradient_boosting":
            settings = boosting.Settings(**models[name])
            model, margins = boosting.fit(data, inputs, [*range(folds), None], "customer_id", settings, seed)
            return [(name, None, model), (name, 0, boosting.held_out(margins, "customer_id", name))]
        if name == "random_forest":
            settings = forest.Settings(**models[name])
            model, scores = forest.fit(data, inputs, [*range(folds), None], "customer_id", settings, seed)
            return [(name, None, model), (name, 0, scores.withColumnRenamed("value", name))]
        per_class = counts(fold)
        train = data if fold is None else data.filter(F.col("fold") != fold)
        pipeline = _pipeline(inputs, sum(per_class.values()), models[name])
        model = pipeline.fit(_balanced(train, per_class))
        if fold is None:
            return [(name, fold, model)]
        model = _detached(model)
        held = model.transform(data.filter(F.col("fold") == fold))
        return [(name, fold, held.select("customer_id", F.get(vector_to_array("probability"), 1).alias(name)))]

    tasks = [(name, fold) for name in models for fold in ([None] if name in TOGETHER else [*range(folds), None])]
    tasks.sort(key=lambda task: task[0] != "gradient_boosting")  # the longest first
    with ThreadPoolExecutor(parallel) as pool:
        done = [one for several in pool.map(fit, tasks) for one in several]
    final = {name: result for name, fold, result in done if fold is None}
    out = data.select("customer_id", "label", "composite_score")
    for name in models:
        parts = [r for n, fold, r in done if n == name and fold is not None]
        out = out.join(reduce(DataFrame.unionByName, parts), "customer_id")
    return Fitted(freeze(out), final, list(inputs))


# --- ranking quality ----------------------------------------------------------------------------


def roc_auc(df: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Exact area from average ranks."""
    ranked = average_rank(df.select(score, label), score, rank="_r")
    hit = F.col(label) == 1
    one = ranked.agg(
        F.sum(F.when(hit, F.col("_r"))).alias("r"),
        F.count_if(hit).cast("double").alias("p"),
        F.count_if(~hit).cast("double").alias("q"),
    )
    p, q = F.col("p"), F.col("q")
    return one.select(F.when((p > 0) & (q > 0), (F.col("r") - p * (p + 1) / 2) / (p * q)).alias("roc_auc"))


def average_precision(df: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Sum of recall steps times precision, from scores folded to distinct values.

    The running counts come from range-partitioned prefix sums, so no task sees the whole ladder.
    """
    from acctiers.operators.rank import running_total

    ladder = df.groupBy(F.col(score).alias("s")).agg(
        F.sum(label).cast("double").alias("hits"), F.count(F.lit(1)).cast("double").alias("rows")
    )
    order = [F.col("s").desc()]
    hits = running_total(ladder, order, "hits", "_i", "true_above", "positives")
    both = running_total(hits.drop("_i"), order, "rows", "_i", "above", "_all")
    step = F.col("hits") / F.col("positives") * F.col("true_above") / F.col("above")
    return both.agg(F.sum(step).alias("pr_auc"))


def brier_score(df: DataFrame, score: str, label: str = "label") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def model_metrics(fitted: Fitted) -> DataFrame:
    """roc_auc, pr_auc and brier per model; the composite score counts as a probability of score / 100."""
    named = [("composite_score", fitted.predictions.withColumn("_p", F.col("composite_score") / 100))]
    named += [(n, fitted.predictions.withColumn("_p", F.col(n))) for n in fitted.models]

    def judged(item: tuple[str, DataFrame]) -> DataFrame:
        name, df = item
        one = roc_auc(df, "_p").withColumn("pr_auc", average_precision(df, "_p").scalar())
        brier = F.lit(None).cast("double") if name == "composite_score" else brier_score(df, "_p").scalar()
        return one.select(F.lit(name).alias("model"), "roc_auc", "pr_auc", brier.alias("brier"))

    with ThreadPoolExecutor(len(named)) as pool:  # ranks and prefix sums take jobs of their own
        rows = list(pool.map(judged, named))
    return freeze(reduce(DataFrame.unionByName, rows))


def best_model(metrics: DataFrame) -> DataFrame:
    return metrics.filter("model <> 'composite_score'").agg(F.max_by("model", "roc_auc").alias("best_model"))


def paired_bootstrap_auc(
    df: DataFrame, a: str, b: str, label: str = "label", iterations: int = 1000, seed: int = 42, key: str = "customer_id"
) -> DataFrame:
    """AUC(a) - AUC(b): exact difference, 95 % bootstrap interval over all rows and two-sided p-value."""
    draws = auc_difference_draws(df, a, b, label, key, iterations, seed)
    side = lambda keep: F.count_if(keep) / F.count("diff")
    d = F.col("diff")
    ends = draws.agg(
        F.percentile("diff", F.array(F.lit(0.025), F.lit(0.975))).alias("q"),
        F.least(F.lit(1.0), 2 * F.least(side(d <= 0), side(d >= 0))).alias("p"),
    )
    point = roc_auc(df, a, label).withColumn("auc_difference", F.col("roc_auc") - roc_auc(df, b, label).scalar())
    return point.withColumn("_e", ends.select(F.struct("*")).scalar()).select(
        "auc_difference", F.get("_e.q", 0).alias("ci_low"), F.get("_e.q", 1).alias("ci_high"), F.col("_e.p").alias("p_value")
    )


# --- what the models look at ---------------------------------------------------------------------


def importances(fitted: Fitted) -> DataFrame:
    """Normalised importance (or absolute coefficient) per feature and model: inputs x models rows."""
    rows = []
    for name, model in fitted.models.items():
        if isinstance(model, (boosting.Boosted, forest.Forest)):
            values = model.importances()
        else:
            values = np.abs(model.stages[-1].coefficients.toArray())
        values = values / values.sum() if values.sum() else values
        rows += [(name, f, float(v)) for f, v in zip(fitted.inputs, values, strict=True)]
    return literal_rows(fitted.predictions.sparkSession, rows, "model string, feature string, importance double")


def _place(column: str):
    one = Window.partitionBy(F.lit(0))
    below = F.rank().over(one.orderBy(column))
    return below + (F.count(F.lit(1)).over(Window.partitionBy(column)) - 1) / 2.0


def weights_vs_importance(importance: DataFrame, expert: dict[str, float], model: str) -> DataFrame:
    """Spearman correlation of expert weights and one model's importances (one row per score feature)."""
    spark = importance.sparkSession
    weights = literal_rows(spark, list(expert.items()), "feature string, weight double")
    both = importance.filter(F.col("model") == model).join(weights, "feature")
    ranked = both.select(_place("weight").alias("a"), _place("importance").alias("b"))
    return ranked.agg(F.corr("a", "b").alias("weights_vs_importance_spearman"))
