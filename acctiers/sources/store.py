"""Parquet tables under one root: append, replace, partition replace, pruned reads."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctiers.session import freeze


class Store:
    """``name`` is a path below the root, such as ``raw/orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _file(self, path: str):
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return marker, marker.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        marker, files = self._file(self.path(name))
        return files.exists(marker)

    def listed(self, name: str) -> list[str]:
        """Names in a folder of the store, in order; none where there is no folder."""
        marker, files = self._file(self.path(name))
        return sorted(str(s.getPath().getName()) for s in files.listStatus(marker)) if files.exists(marker) else []

    def remove(self, name: str) -> None:
        marker, files = self._file(self.path(name))
        files.delete(marker, True)

    def _schema_path(self, name: str) -> str:
        return f"{self.root}/_schemas/{name}.json"

    def schema(self, name: str) -> T.StructType | None:
        """Schema noted at the last write, so a read opens no footer to learn it."""
        marker, files = self._file(self._schema_path(name))
        if not files.exists(marker):
            return None
        stream = files.open(marker)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return T.StructType.fromJson(json.loads(text))

    def note_schema(self, name: str, schema: T.StructType) -> None:
        marker, files = self._file(self._schema_path(name))
        stream = files.create(marker, True)
        stream.write(bytearray(schema.json().encode()))
        stream.close()

    def read(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        """Columns added by later appends are null in older files.  A table this class did not write
        has no noted schema; its file schemas are merged instead."""
        schema = self.schema(name)
        reader = self.spark.read.schema(schema) if schema else self.spark.read.option("mergeSchema", True)
        df = reader.parquet(self.path(name))
        return df.select(*columns) if columns else df

    def read_or_none(self, name: str, columns: Sequence[str] | None = None) -> DataFrame | None:
        return self.read(name, columns) if self.exists(name) else None

    def write(self, df: DataFrame, name: str, mode: str = "append", partition_by: Sequence[str] = ()) -> int:
        """Write and return the row count, taken while writing.  ``mode`` is append or replace."""
        counted = Observation()
        if partition_by:  # a few files per partition, however many tasks hold its rows
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.mode({"append": "append", "replace": "overwrite"}[mode]).parquet(self.path(name))
        self.note_schema(name, df.schema)
        return counted.get["rows"]

    def append_evolving(self, df: DataFrame, name: str) -> int:
        """Append with additive evolution: known columns keep their stored type, missing ones are null."""
        if self.exists(name):
            known = self.read(name).schema
            typed = [
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in known
            ]
            df = df.select(*typed, *[c for c in df.columns if c not in known.names])
        return self.write(df, name, "append")

    def replace_partition(self, df: DataFrame, name: str, column: str) -> None:
        """Replace only the partitions present in ``df``; running twice leaves one copy."""
        (
            df.hint("rebalance", F.col(column))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(self.path(name))
        )
        self.note_schema(name, df.schema)

    def replace_from_itself(self, df: DataFrame, name: str) -> int:
        """Replace a table by a result computed from it: the result is checkpointed first."""
        return self.write(freeze(df), name, "replace")

    def max_value(self, name: str, column: str):
        """Largest value of a column, or None without the table; a scan of that column alone."""
        if not self.exists(name):
            return None
        return self.read(name, [column]).agg(F.max(column)).first()[0]

    def rows(self, name: str) -> int:
        """Row count of a table; without columns the files' footers answer it."""
        return self.read(name).count()


def after_watermark(df: DataFrame, column: str, watermark, lookback: str | None = None) -> DataFrame:
    """Rows newer than the watermark (strictly).  ``lookback`` ("2 days") re-reads late rows as well;
    the newest-version step then drops the repeats."""
    if watermark is None:
        return df
    start: Column = F.lit(watermark)
    if lookback:
        start = start - F.expr(f"interval {lookback}")
    return df.filter(F.col(column) > start)


def with_audit(df: DataFrame, batch_id: str, loaded_at, source_file: str | Column | None = None) -> DataFrame:
    """Audit columns; without a name the file each row came from is used."""
    file = F.lit(source_file) if source_file is not None else F.element_at(F.split(F.input_file_name(), "/"), -1)
    return df.withColumns(
        {"_batch_id": F.lit(batch_id), "_loaded_at": F.lit(loaded_at).cast("timestamp"), "_source_file": file}
    )
