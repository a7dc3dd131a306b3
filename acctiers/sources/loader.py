"""Load one source, or all: extract, drift check, conform, watermark, write, volume check, audit."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from acctiers import settings as S
from acctiers.functions.exprs import utc
from acctiers.operators import monitor as M
from acctiers.operators.checks import CHECK_DDL, stamp
from acctiers.sources.landing import conform, extract_csv, file_checksums
from acctiers.sources.store import Store, after_watermark, with_audit

AUDIT_SCHEMA = (
    "batch_id string, run_id string, source string, load_strategy string, source_file string, file_checksum string, "
    "rows_extracted bigint, rows_loaded bigint, table_rows_after bigint, watermark_before string, "
    "watermark_after string, columns_dropped string, started_at timestamp, finished_at timestamp, "
    "duration_seconds double, status string"
)
CHECKS, AUDIT = "monitoring/check_results", "monitoring/load_audit"


@dataclass
class Loaded:
    source: str
    batch_id: str
    strategy: str
    rows_extracted: int
    rows_loaded: int
    table_rows: int
    dropped: list[str]


def empty_audit(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], AUDIT_SCHEMA)


def persist_checks(store: Store, checks: DataFrame, run_id: str | None, at: datetime) -> int:
    return store.append_evolving(stamp(checks, run_id, at), CHECKS)


def checksum_of(spark: SparkSession, path: str | Sequence[str]) -> str | None:
    """One digest for the landed path: file digests in path order, folded again when there are several."""
    files = file_checksums(spark, path).agg(F.sort_array(F.collect_list(F.struct("path", "checksum"))).alias("f"))
    sums = F.transform("f", lambda x: x["checksum"])
    folded = F.when(F.size("f") == 1, F.get(sums, 0)).otherwise(F.md5(F.array_join(sums, "")))
    return files.select(folded).first()[0]


def check_volume(store: Store, source: str, strategy: str, rows: int, table_rows: int) -> list[Row]:
    """The volume check of a batch, one row; call it before the batch has its own audit row."""
    history = store.read_or_none(AUDIT)
    batch = store.spark.createDataFrame(
        [(source, strategy, rows, table_rows)], "source string, strategy string, rows_loaded bigint, table_rows bigint"
    )
    return M.check_batch_volume(batch, empty_audit(store.spark) if history is None else history).collect()


def load_source(
    store: Store,
    source: str,
    path: str,
    batch_id: str | None = None,
    run_id: str | None = None,
    full_refresh: bool = False,
    started: datetime | None = None,
    lookback: str | None = None,
    gated: bool = False,
) -> Loaded:
    """One pass over the file writes the table and notes the rows read and kept and the newest one.

    The stored table is read for its watermark alone, one column; what it holds afterwards follows from that, the
    pass and the footers.  The checksum comes before the write, so that no load ends without its audit row.
    ``gated`` says the contract gate has just passed (and stored) this file's drift check, so it is
    not scanned for drift again.
    """
    spark, spec = store.spark, S.SOURCES[source]
    batch_id = batch_id or uuid.uuid4().hex[:12]
    started = utc(started or datetime.now(UTC))
    landed = extract_csv(spark, path)

    drift = [] if gated else M.check_landed(source, landed).collect()  # one row
    if drift and drift[0]["severity"] == "error":
        persist_checks(store, spark.createDataFrame(drift, CHECK_DDL), run_id, started)
        raise M.SchemaDriftError(f"{source}: {drift[0]['message']}")

    table, column = f"raw/{source}", spec["watermark"]
    strategy = "full_refresh" if full_refresh else spec["strategy"]
    before = store.max_value(table, column) if strategy == "incremental" else None
    checksum = checksum_of(spark, path)
    seen, kept = Observation(), Observation()
    typed, dropped = conform(source, landed.observe(seen, F.count(F.lit(1)).alias("rows")))
    fresh = with_audit(after_watermark(typed, column, before, lookback), batch_id, started, path.rsplit("/", 1)[-1])
    fresh = fresh.observe(kept, F.max(column).alias("newest"))
    if strategy == "full_refresh":
        rows = store.write(fresh, table, "replace")
    else:
        rows = store.append_evolving(fresh, table)
    extracted = seen.get["rows"]
    newest = [m for m in (before, kept.get["newest"]) if m is not None]
    table_rows, after = rows if strategy == "full_refresh" else store.rows(table), max(newest, default=None)

    volume = check_volume(store, source, strategy, rows, table_rows)
    finished = datetime.now(UTC)
    record = (
        batch_id,
        run_id,
        source,
        strategy,
        path,
        checksum,
        extracted,
        rows,
        table_rows,
        None if before is None else str(before),
        None if after is None else str(after),
        ",".join(dropped),
        started,
        finished,
        round((finished - started).total_seconds(), 3),
        "success",
    )
    store.append_evolving(spark.createDataFrame([record], AUDIT_SCHEMA), AUDIT)
    persist_checks(store, spark.createDataFrame(drift + volume, CHECK_DDL), run_id, finished)
    return Loaded(source, batch_id, strategy, extracted, rows, table_rows, dropped)


def load_all(
    store: Store, paths: dict[str, str], run_id: str | None = None, full_refresh: bool = False
) -> list[Loaded]:
    """Every source under one batch id, after the contract gate has passed all of them."""
    batch_id = uuid.uuid4().hex[:12]
    landed = {source: extract_csv(store.spark, path) for source, path in paths.items()}
    gate = M.contract_gate(landed, raise_on_error=False).collect()  # one row per source
    checks = store.spark.createDataFrame(gate, CHECK_DDL)
    persist_checks(store, checks, run_id, datetime.now(UTC))
    if any(r["severity"] == "error" for r in gate):
        M.raise_for_drift(checks)
    return [
        load_source(store, s, paths[s], batch_id, run_id, full_refresh, gated=True) for s in S.SOURCES if s in paths
    ]
