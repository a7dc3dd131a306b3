"""Behavioural segments: k-means on normalised features, k by silhouette, names from centroids."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctiers.session import freeze, reload


@dataclass
class Segmentation:
    labels: DataFrame  # customer_id, segment
    profiles: DataFrame  # cluster_id, segment, customers, one centroid value per feature
    k: int
    silhouette: float
    by_k: dict[int, float]


def standardized(normalized: DataFrame, names: list[str]) -> DataFrame:
    """customer_id, the features, and their standardised vector; frozen, as every fit passes over it."""
    assembled = VectorAssembler(inputCols=names, outputCol="_raw").transform(normalized)
    scaler = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
    return freeze(scaler.fit(assembled).transform(assembled).drop("_raw"))


def fit_best(points: DataFrame, ks: list[int], n_init: int, seed: int, parallel: int = 8) -> dict[int, KMeansModel]:
    """Best of ``n_init`` seeded fits per k by training cost.  Fits are independent Spark jobs."""
    tries = [(k, seed + i) for k in ks for i in range(n_init)]

    def fit(task: tuple[int, int]) -> tuple[int, float, KMeansModel]:
        k, start = task
        model = KMeans(k=k, seed=start, maxIter=300, tol=1e-4, featuresCol="features", predictionCol="cluster").fit(points)
        return k, model.summary.trainingCost, model

    best: dict[int, tuple[float, KMeansModel]] = {}
    with ThreadPoolExecutor(parallel) as pool:
        for k, cost, model in pool.map(fit, tries):
            if k not in best or cost < best[k][0]:
                best[k] = (cost, model)
    return {k: reload(points.sparkSession, model) for k, (_, model) in best.items()}


def silhouettes(points: DataFrame, models: dict[int, KMeansModel]) -> dict[int, float]:
    """Mean silhouette per k over all points, on squared distances.

    The mean squared distance of a point to a cluster follows from the cluster's count, sum and sum of
    squares, so each k is two aggregates and no pair of points is formed.
    """
    scorer = ClusteringEvaluator(predictionCol="cluster", featuresCol="features", distanceMeasure="squaredEuclidean")

    def one(model: KMeansModel) -> float:
        labelled = model.transform(points)
        several = labelled.select("cluster").distinct().limit(2).count() > 1
        return scorer.evaluate(labelled) if several else 0.0

    with ThreadPoolExecutor(max(1, len(models))) as pool:
        return dict(zip(models, pool.map(one, models.values()), strict=True))


def segment_name(names: list[str]) -> Column:
    """Name from a centroid row; rules are tried in order.  An absent feature never triggers its rule."""

    def has(feature: str) -> bool:
        return feature in names

    value = reduce(lambda a, b: a + b, [F.col(n) for n in names]) / F.lit(len(names))
    no = F.lit(False)
    growing = F.col("revenue_growth") >= 0.6 if has("revenue_growth") else no
    silent = F.col("recency_days") < 0.35 if has("recency_days") else no
    sparse = F.col("active_month_ratio") < 0.3 if has("active_month_ratio") else no
    often = F.col("frequency_12m") >= 0.55 if has("frequency_12m") else no
    small = F.col("monetary_12m") < 0.5 if has("monetary_12m") else no
    rich = F.col("gross_margin_pct") >= 0.6 if has("gross_margin_pct") else no
    late = F.col("late_payment_rate") < 0.35 if has("late_payment_rate") else no
    returns = F.col("return_rate") < 0.35 if has("return_rate") else no
    return (
        F.when(value >= 0.65, "Champions")
        .when(growing & (value >= 0.45), "Rising Stars")
        .when(silent | sparse, "At Risk")
        .when(often & small, "Frequent Small Buyers")
        .when(rich, "Profitable Niche")
        .when(late | returns, "Credit / Service Risk")
        .otherwise("Steady Core")
    )


def segment_profiles(clustered: DataFrame, names: list[str]) -> DataFrame:
    """Centroid, size and name per cluster.  A name used again gets a number, best centroid first."""
    centroids = clustered.groupBy(F.col("cluster").alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("customers"), *[F.avg(n).alias(n) for n in names]
    )
    mean = reduce(lambda a, b: a + b, [F.col(n) for n in names]) / F.lit(len(names))
    named = centroids.withColumns({"_name": segment_name(names), "_mean": mean})
    turn = F.row_number().over(Window.partitionBy("_name").orderBy(F.col("_mean").desc(), "cluster_id"))
    numbered = named.withColumn("_turn", turn)
    label = F.when(F.col("_turn") == 1, F.col("_name")).otherwise(F.concat_ws(" ", "_name", F.col("_turn").cast("string")))
    return numbered.select("cluster_id", label.alias("segment"), "customers", *names)


def behavioral_segments(normalized: DataFrame, names: list[str], cfg: dict) -> Segmentation:
    points = standardized(normalized, names)
    low, high = cfg["k_range"]
    ks = list(range(low, min(high, points.count() - 1) + 1))
    models = fit_best(points, ks, cfg.get("n_init", 10), cfg["seed"])
    by_k = silhouettes(points, models)
    k = max(by_k, key=by_k.get)
    clustered = models[k].transform(points)
    profiles = freeze(segment_profiles(clustered, names))
    names_by_cluster = profiles.select(F.col("cluster_id").alias("cluster"), "segment")
    labels = clustered.select("customer_id", "cluster").join(F.broadcast(names_by_cluster), "cluster")  # at most k rows
    return Segmentation(labels.select("customer_id", "segment"), profiles, k, by_k[k], by_k)
