"""Published datasets as files for BI tools."""

from __future__ import annotations

from pyspark.sql import DataFrame

from acctiers.sources.store import Store

# --- fixed values: dataset name -> stored table ------------------------------------------------
DATASETS = {
    "customer_tiers": "marts/mart_customer_tiers",
    "tier_summary": "marts/mart_tier_summary",
    "tier_movement": "marts/mart_tier_movement",
    "customer_monthly_revenue": "marts/fct_customer_monthly",
    "orders": "marts/fct_orders",
    "segment_profiles": "tiering/segment_profiles",
    "tier_weights": "tiering/tier_weights",
    "backtest_lift": "tiering/backtest_lift",
    "validation_metrics": "tiering/validation_metrics",
    "data_health": "marts/mart_data_health",
}


def export_dataset(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A directory of part files; nothing is merged into one file or one task."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(kind).save(path)


def export_datasets(store: Store, out: str, kind: str = "csv") -> dict[str, str]:
    """Export every dataset whose table exists; the result maps name to path."""
    written = {}
    for name, table in DATASETS.items():
        df = store.read_or_none(table)
        if df is not None:
            written[name] = f"{out.rstrip('/')}/{name}"
            export_dataset(df, written[name], kind)
    return written
