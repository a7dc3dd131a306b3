"""Slowly changing history: apply a snapshot, or rebuild intervals from an append-only log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: attributes the customer snapshot keeps ------------------------------------
CUSTOMER_ATTRIBUTES = (
    "customer_id",
    "business_name",
    "industry",
    "region",
    "employee_count",
    "company_size_band",
    "account_manager",
    "signup_date",
    "updated_at",
)
INTERVAL = ("valid_from", "valid_to", "is_current")


def open_interval(df: DataFrame, updated_at: str = "updated_at") -> DataFrame:
    """First snapshot: every row is current."""
    start = F.col(updated_at)
    return df.withColumns({"valid_from": start, "valid_to": F.lit(None).cast(df.schema[updated_at].dataType), "is_current": F.lit(True)})


def scd2_apply(history: DataFrame, incoming: DataFrame, key: str = "customer_id", updated_at: str = "updated_at") -> DataFrame:
    """New full history after a snapshot.  A row changes only when its ``updated_at`` moved forward.

    Closed rows pass through; open rows meet the snapshot in one outer join and yield one row, or two
    (the closed old one and the new one) when the record advanced.
    """
    old = history.filter("is_current").select(F.col(key).alias("_key"), F.struct(*history.columns).alias("_old"))
    fresh = open_interval(incoming, updated_at).select(*history.columns)
    new = fresh.select(F.col(key).alias("_key"), F.struct(*history.columns).alias("_new"))
    advanced = F.col(f"_new.{updated_at}") > F.col(f"_old.{updated_at}")
    closed = (
        F.col("_old").withField("valid_to", F.col(f"_new.{updated_at}")).withField("is_current", F.lit(False))
    )
    rows = (
        F.when(F.col("_old").isNull(), F.array("_new"))
        .when(F.coalesce(advanced, F.lit(False)), F.array(closed, "_new"))
        .otherwise(F.array("_old"))
    )
    touched = old.join(new, "_key", "full_outer").select(F.inline(rows))
    return history.filter("not is_current").unionByName(touched)


def changed_rows(current: DataFrame, fresh: DataFrame, key: str = "customer_id", updated_at: str = "updated_at") -> DataFrame:
    """Rows that a snapshot adds to a history: new open rows, and closed forms of the rows they replace.

    ``current`` holds the open rows, ``fresh`` the snapshot as open intervals in the same columns.  Rows that
    did not advance leave no row here; null keys meet each other.
    """
    old = current.select(F.col(key).alias("_old_key"), F.struct(*fresh.columns).alias("_old"))
    new = fresh.select(F.col(key).alias("_key"), F.struct(*fresh.columns).alias("_new"))
    both = new.join(old, F.col("_key").eqNullSafe(F.col("_old_key")), "left")
    advanced = F.col(f"_new.{updated_at}") > F.col(f"_old.{updated_at}")
    closed = F.col("_old").withField("valid_to", F.col(f"_new.{updated_at}")).withField("is_current", F.lit(False))
    rows = F.when(F.col("_old").isNull(), F.array("_new")).when(advanced, F.array(closed, "_new"))
    return both.select(F.inline(rows))  # a null array has no rows


def scd2_from_log(
    log: DataFrame, key: str, updated_at: str = "updated_at", order_by: Sequence[str] = (), chunk: str = "month"
) -> DataFrame:
    """Validity intervals of every version in an append-only log.

    Versions repeated at the same time collapse to one first.  The next version's time is looked up
    inside (key, ``chunk`` of time) windows, and across chunks on a table of one row per key and
    chunk, so the versions of one very busy key are spread over its chunks.
    """
    keys = [key, updated_at]
    rest = [c for c in log.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in (order_by or rest)])
    versions = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    versions = versions.withColumn("_chunk", F.date_trunc(chunk, updated_at))
    in_order = Window.partitionBy(key).orderBy("_chunk")
    firsts = versions.groupBy(key, "_chunk").agg(F.min(updated_at).alias("_first"))
    firsts = firsts.withColumn("_after", F.lead("_first").over(in_order)).drop("_first")
    inside = Window.partitionBy(key, "_chunk").orderBy(updated_at)
    following = versions.withColumn("_next", F.lead(updated_at).over(inside)).join(firsts, [key, "_chunk"])
    until = F.coalesce("_next", "_after")
    return following.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in log.columns],
        F.col(updated_at).alias("valid_from"),
        until.alias("valid_to"),
        until.isNull().alias("is_current"),
    )
