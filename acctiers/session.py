"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime SQL settings the jobs rely on.  Cluster-level sizing (executors, memory) stays with
# spark-submit; AQE sizes the shuffles at run time from a generous initial partition count.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where the split costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # collect_set keeps its hash map instead of sorting after 128 keys
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def build_session(app: str = "acctiers", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        # no call-site capture on every column expression: plans here are built from many
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else made."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    # Python workers of a session started elsewhere import this package, too
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; the cluster names it in ``spark.checkpoint.dir``.

    A session on one machine that names none gets a local folder; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="acctiers-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of driver-side rows as a plan literal: no Python data source, one task."""
    fields = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [
        F.struct(*[F.lit(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields, strict=True)]) for row in rows
    ]
    return spark.sql("select 1").select(F.inline(F.array(*structs)))


def reload(spark: SparkSession, model):
    """A fitted model saved to the shared folder and read back, without its training summary.

    The summary keeps a handle on the session, which cannot travel to executors once the session has
    observed metrics.
    """
    path = scratch_path(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def freeze(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage, survives a lost executor, fixes the row set.

    Used where a later step takes several passes over a derived table (quantiles then ranks, say)
    and must see the same rows each time.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder.

    Like ``freeze``, for wide tables whose readers take a few columns each.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
