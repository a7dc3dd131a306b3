"""The check-result record every monitor and suite returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctiers.settings import SEVERITY_RANK

CHECK_SCHEMA = {
    "check_type": "string",
    "check_name": "string",
    "target": "string",
    "severity": "string",
    "message": "string",
    "observed_value": "double",
    "threshold": "double",
    "details": "string",
}
CHECK_COLUMNS = list(CHECK_SCHEMA)
CHECK_DDL = ", ".join(f"{name} {kind}" for name, kind in CHECK_SCHEMA.items())


def check_rows(df: DataFrame, **fields: Column) -> DataFrame:
    """Project ``df`` to check results.  The name defaults to the type, details to an empty object."""
    fields.setdefault("check_name", fields["check_type"])
    fields.setdefault("details", F.lit("{}"))
    return df.select(
        *[fields.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in CHECK_SCHEMA.items()]
    )


def stamp(checks: DataFrame, run_id: str | None, checked_at) -> DataFrame:
    """Add the run columns a stored result carries."""
    return checks.select(
        F.lit(checked_at).cast("timestamp").alias("checked_at"),
        F.lit(run_id).cast("string").alias("run_id"),
        *CHECK_COLUMNS,
    )


def severity_rank(severity: Column) -> Column:
    pairs = [F.lit(x) for name, rank in SEVERITY_RANK.items() for x in (name, rank)]
    return F.create_map(*pairs)[severity]


def worst_severity(checks: DataFrame, *by: str) -> DataFrame:
    worst = F.max_by("severity", severity_rank(F.col("severity")))
    return checks.groupBy(*by).agg(F.coalesce(worst, F.lit("pass")).alias("severity"))
