"""Scheduled load of a landing folder as a stream of files whose headers may differ.

The stream carries file names; no content passes through it.  A micro-batch groups its files by header line, reads each
group by its own column names, and then does what the batch load does: drift check, conform, write, volume
check, audit row.  The checkpoint stands for the watermark, so a late row in a new file is loaded.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from acctiers import settings as S
from acctiers.operators import monitor as M
from acctiers.operators.checks import CHECK_DDL
from acctiers.sources.landing import conform, extract_csv
from acctiers.sources.loader import AUDIT, AUDIT_SCHEMA, check_volume, checksum_of, persist_checks
from acctiers.sources.store import Store, with_audit

FILES_PER_BATCH = 200  # names the driver holds at a time, and header lines it looks at
FILE = "_source_file"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, folder: str, pattern: str = "*.csv", per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(path, length) of new files; their content is not read."""
    read = spark.readStream.format("binaryFile").schema(_FILES)
    return read.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_batch).load(folder).select("path", "length")


def header_line(spark: SparkSession, path: str) -> str | None:
    """First line of a file, read up to its end alone; None for an empty file."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def by_header(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Paths of the files that share a header line, in order; empty files are left out."""
    groups: dict[str, list[str]] = {}
    for path in sorted(paths):
        line = header_line(spark, path)
        if line is not None:
            groups.setdefault(line, []).append(path)
    return dict(sorted(groups.items()))


def ingest_files(store: Store, source: str, files: DataFrame, checkpoint: str, run_id: str | None = None):
    """Load every new file of a contracted source into ``streamed/<source>``, then stop.

    Columns are matched by name, so files may order them differently, lack some or have more.  A group of files that
    breaks the contract fails its micro-batch: the drift checks are stored, no row of the batch is, and the next
    start meets the same files again.  A micro-batch owns one ``_batch_id`` partition.  Replayed, it writes its
    partition again, and leaves alone what its audit row says is complete.
    """
    spark, table = store.spark, f"streamed/{source}"
    owner = checkpoint.rstrip("/").rpartition("/")[2]

    def write(batch: DataFrame, number: int) -> None:
        started, batch_id = datetime.now(UTC), f"{owner}-{number}"
        audit = store.read_or_none(AUDIT)
        if audit is not None and not audit.filter((F.col("batch_id") == batch_id) & (F.col("source") == source)).isEmpty():
            return
        names = [r["path"] for r in batch.select("path").collect()]  # FILES_PER_BATCH at most
        groups = list(by_header(spark, names).values())
        if not groups:
            return
        landed = [extract_csv(spark, paths, file_column=FILE) for paths in groups]
        drift = reduce(DataFrame.unionByName, [M.check_landed(source, df.drop(FILE)) for df in landed]).collect()  # one row per header
        bad = [r["message"] for r in drift if r["severity"] == "error"]
        if bad:
            persist_checks(store, spark.createDataFrame(drift, CHECK_DDL), run_id, started)
            raise M.SchemaDriftError(f"{source}: {'; '.join(bad)}")

        typed, dropped = [], set()
        for df in landed:
            rows, left = conform(source, df, keep=[FILE])
            typed.append(rows)
            dropped |= set(left)
        kept, column = Observation(), S.SOURCES[source]["watermark"]
        fresh = with_audit(reduce(DataFrame.unionByName, typed), batch_id, started, F.col(FILE))
        fresh = fresh.observe(kept, F.count(F.lit(1)).alias("rows"), F.max(column).alias("newest"))
        store.replace_partition(fresh, table, "_batch_id")
        rows, newest, table_rows = kept.get["rows"], kept.get["newest"], store.rows(table)

        volume = check_volume(store, source, "incremental", rows, table_rows)
        finished = datetime.now(UTC)
        all_paths = [p for paths in groups for p in paths]
        record = (
            batch_id,
            run_id,
            source,
            "incremental",
            ",".join(p.rsplit("/", 1)[-1] for p in sorted(all_paths)),
            checksum_of(spark, all_paths),
            rows,
            rows,
            table_rows,
            None,
            None if newest is None else str(newest),
            ",".join(sorted(dropped)),
            started,
            finished,
            round((finished - started).total_seconds(), 3),
            "success",
        )
        persist_checks(store, spark.createDataFrame(drift + volume, CHECK_DDL), run_id, finished)
        store.append_evolving(spark.createDataFrame([record], AUDIT_SCHEMA), AUDIT)

    writer = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
