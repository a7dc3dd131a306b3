"""Session settings and small DataFrame helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctiers.session import scratch_path

# Rows of one Arrow batch.  Texts differ in length by four orders of magnitude, so a worker's
# memory is bounded by few rows per batch and by the byte limit inside ``words.chunks``.
BATCH_ROWS = "512"


def prepare(spark: SparkSession) -> SparkSession:
    wanted = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        # shuffle files go when their job ends; what later jobs need is stored by then
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    # Python workers of a session started elsewhere import this package, too
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def keyed_text(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc_id long, text string) with null texts as empty, whatever else the table holds, and columns of choice."""
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def extended(ddl: str, *more: T.StructField) -> T.StructType:
    """A schema from text and fields whose names text may not express."""
    return T.StructType([*T._parse_datatype_string(ddl).fields, *more])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: str, n: int):
    """crc32 of the id's decimal text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(n)


_OPEN: list[list[str]] = []  # paths of the stored tables of each open ``temporary`` block


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if _OPEN:
        _OPEN[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table, in whatever file system it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator:
    """Tables stored inside the block go when it ends, but for what is stored with the function it hands out.

    A DataFrame that reads them must not leave the block.
    """
    _OPEN.append([])

    def outlive(df: DataFrame, name: str) -> DataFrame:
        kept = stored(df, name)
        path = _OPEN[-1].pop()
        if len(_OPEN) > 1:
            _OPEN[-2].append(path)
        return kept

    try:
        yield outlive
    finally:
        for path in _OPEN.pop():
            remove(spark, path)
