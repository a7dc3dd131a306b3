"""Streaming forms of the scheduled loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctiers.operators.latest import latest_record
from acctiers.session import freeze
from acctiers.sources.landing import conform, empty_to_null, text_schema, tidy_names
from acctiers.sources.store import with_audit


def stream_csv(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """New files in the landing folder of a contracted source, as text columns.

    A file whose header does not name the contract's columns in their order fails its batch.
    """
    read = spark.readStream.schema(text_schema(source)).options(header=True, escape='"', multiLine=True, enforceSchema=False)
    return read.csv(folder)


def stream_parquet(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def ingest(source: str, landed: DataFrame, target: str, checkpoint: str):
    """Conform and append every new file, then stop.

    The checkpoint replaces the watermark query: a late row in a new file is loaded, not lost.  A
    micro-batch owns one ``_batch_id`` partition, so a replayed batch overwrites its own output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        typed, _ = conform(source, empty_to_null(tidy_names(batch)))
        rows = with_audit(typed, f"stream-{batch_id}", datetime.now(UTC))
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch_id")
            .parquet(target)
        )

    return _until_done(landed.writeStream.foreachBatch(write), checkpoint)


BUCKETS = 64
BUCKET = "_bucket"


def key_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _touched(batch: DataFrame) -> list[int]:
    """Buckets of a micro-batch; as many numbers at most as there are buckets."""
    return sorted(r[0] for r in batch.select(BUCKET).distinct().collect())


def append_new(events: DataFrame, keys: list[str], target: str, checkpoint: str, name: str = "_batch_id", buckets: int = BUCKETS):
    """Append every event whose key is not stored yet, then stop; late ones are kept, repeats are not.

    The stored keys are the state, in ``buckets`` partitions by key hash: a micro-batch is checked by an anti join
    against the keys of its own buckets, so nothing is released by a watermark.  A replayed batch overwrites
    its own partitions.
    """
    run = checkpoint.rstrip("/").rpartition("/")[2]

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(keys).withColumn(BUCKET, key_bucket(keys, buckets))
        part = f"{run}-{batch_id}"
        if _holds_data(batch.sparkSession, target):
            kept = batch.sparkSession.read.parquet(target).filter(F.col(BUCKET).isin(_touched(fresh)) & (F.col(name) != part)).select(*keys)
            fresh = fresh.join(kept, keys, "left_anti")
        rows = fresh.withColumn(name, F.lit(part)).hint("rebalance", F.col(BUCKET))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, name).parquet(target)

    return _until_done(events.writeStream.foreachBatch(write), checkpoint)


# --- newest version per key ------------------------------------------------------------------------
# A store is a folder per committed version: <target>/version=<run>-<batch>/_bucket=<n>.  A version holds the whole
# new content of the buckets it touched; the current content of a bucket is in the last version that has it.


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list[str]:
    where, files = _files(spark, path)
    return sorted(str(s.getPath().getName()) for s in files.listStatus(where)) if files.exists(where) else []


def _versions(spark: SparkSession, target: str, besides: str | None = None) -> dict[int, list[str]]:
    """Committed versions of each bucket, oldest first; names alone are read."""
    held: dict[int, list[str]] = {}
    for version in _listed(spark, target):
        names = _listed(spark, f"{target}/{version}") if version.startswith("version=") and version != besides else []
        for name in names if "_SUCCESS" in names else ():
            if name.startswith(f"{BUCKET}="):
                held.setdefault(int(name.rpartition("=")[2]), []).append(version)
    return held


def newest(spark: SparkSession, target: str, buckets: Sequence[int] | None = None, besides: str | None = None) -> DataFrame | None:
    """Current rows of a store that ``keep_newest`` made, or of some of its buckets; None where there are none."""
    held = _versions(spark, target, besides)
    paths = [f"{target}/{versions[-1]}/{BUCKET}={b}" for b, versions in sorted(held.items()) if buckets is None or b in buckets]
    return spark.read.parquet(*paths) if paths else None


def keep_newest(events: DataFrame, keys: list[str], order_by: list[str], target: str, checkpoint: str, buckets: int = BUCKETS):
    """Keep the newest version of every key, however late it or an older one arrives, then stop.

    A micro-batch reads and writes the buckets of its own keys.  What it writes is a new version of them, in use
    once its folder is committed; a failed or replayed batch reads the versions before its own and writes its
    folder again.  One older version of a bucket stays for readers that have already listed it.
    ``order_by`` names the columns that order versions, largest first; it should settle ties.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        coming = freeze(latest_record(batch, keys, order_by).withColumn(BUCKET, key_bucket(keys, buckets)))
        touched = _touched(coming)
        if not touched:
            return
        number = _number(spark, target, checkpoint, batch_id)
        before = newest(spark, target, touched, number)
        rows = coming
        if before is not None:
            rows = latest_record(coming.drop(BUCKET).unionByName(before), keys, order_by).withColumn(BUCKET, key_bucket(keys, buckets))
        rows = rows.hint("rebalance", F.col(BUCKET))
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{target}/{number}")
        for bucket, versions in _versions(spark, target).items():
            for version in versions[:-2] if bucket in touched else ():
                where, files = _files(spark, f"{target}/{version}/{BUCKET}={bucket}")
                files.delete(where, True)

    return _until_done(events.writeStream.foreachBatch(write), checkpoint)


def _number(spark: SparkSession, target: str, checkpoint: str, batch_id: int) -> str:
    """Folder name of a batch: after all committed ones, and the same one when the batch is run again."""
    owner = f"{checkpoint.rstrip('/').rpartition('/')[2]}-{batch_id}"
    names = [n for n in _listed(spark, target) if n.startswith("version=")]
    own = [n for n in names if n.split(".", 1)[1] == owner]
    return own[0] if own else f"version={max((int(n[8:].split('.')[0]) for n in names), default=0) + 1:012d}.{owner}"


def without_repeats(events: DataFrame, keys: list[str], time: str, lateness: str = "1 day") -> DataFrame:
    """Drop repeats that arrive within ``lateness``; state older than that is released.

    Rows older than the watermark are dropped, too: for sources that are never later than ``lateness``.
    ``append_new`` keeps late rows, ``keep_newest`` the newest version of each key.
    """
    return events.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def daily_counts(events: DataFrame, time: str, source: str) -> DataFrame:
    """Rows per source and day; the state is one row for each, which late rows still change."""
    counted = events.groupBy(F.window(time, "1 day"), F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("rows_loaded"))
    return counted.select(F.col("window.start").alias("batch_start"), "source", "rows_loaded")


def keep_current(counts: DataFrame, target: str, checkpoint: str):
    """Write the whole small result of a streaming aggregate anew after each micro-batch, then stop."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    return _until_done(counts.writeStream.outputMode("complete").foreachBatch(write), checkpoint)


def _until_done(writer, checkpoint: str):
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _holds_data(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def run_once(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Process what is there into Parquet and stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", target)
    _until_done(writer, checkpoint).awaitTermination()
