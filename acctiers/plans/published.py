"""Published tier marts and the datasets behind the dashboards."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctiers.functions.exprs import safe_divide
from acctiers.operators.rank import average_rank, running_total


def _movement(rank: Column, previous_tier: Column, previous_rank: Column) -> Column:
    return (
        F.when(previous_tier.isNull(), "New")
        .when(rank < previous_rank, "Upgraded")
        .when(rank > previous_rank, "Downgraded")
        .otherwise("Stable")
    )


def previous_runs(history: DataFrame) -> DataFrame:
    """Each customer's tier with the one before it; a customer has one row per scoring run."""
    by_run = Window.partitionBy("customer_id").orderBy("as_of_date")
    return history.select(
        "customer_id",
        "as_of_date",
        "tier",
        "tier_rank",
        F.lag("tier").over(by_run).alias("previous_tier"),
        F.lag("tier_rank").over(by_run).alias("previous_tier_rank"),
        F.lag("as_of_date").over(by_run).alias("previous_as_of_date"),
    )


def mart_customer_tiers(tiers: DataFrame, customers: DataFrame, history: DataFrame) -> DataFrame:
    before = previous_runs(history).select("customer_id", "as_of_date", "previous_tier", "previous_tier_rank")
    who = customers.select(
        "customer_id", "business_name", "industry", "region", "company_size_band", "account_manager", "lifetime_revenue", "is_active"
    )
    optional = [c for c in ("segment", "run_id", "scored_at") if c in tiers.columns]
    joined = tiers.drop("industry", "region").join(who, "customer_id", "left").join(
        before, ["customer_id", "as_of_date"], "left"
    )
    return joined.select(
        "customer_id",
        "business_name",
        "industry",
        "region",
        "company_size_band",
        "account_manager",
        "as_of_date",
        "composite_score",
        "score_percentile",
        "tier",
        "tier_rank",
        "previous_tier",
        _movement(F.col("tier_rank"), F.col("previous_tier"), F.col("previous_tier_rank")).alias("tier_movement"),
        "monetary_12m",
        "frequency_12m",
        "avg_order_value",
        "recency_days",
        "gross_margin_pct",
        "revenue_growth",
        "category_breadth",
        "active_month_ratio",
        "late_payment_rate",
        "return_rate",
        "tenure_days",
        "lifetime_revenue",
        "is_active",
        *optional,
    )


def mart_tier_summary(mart: DataFrame) -> DataFrame:
    """KPIs per tier.  The grand totals are sums over the four tier rows, not a second scan."""
    per_tier = mart.groupBy("tier", "tier_rank").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("composite_score").alias("avg_composite_score"),
        F.min("composite_score").alias("min_composite_score"),
        F.sum("monetary_12m").alias("revenue_12m"),
        F.avg("monetary_12m").alias("avg_revenue_12m"),
        F.avg("frequency_12m").alias("avg_orders_12m"),
        F.avg("gross_margin_pct").alias("avg_gross_margin_pct"),
        F.avg("revenue_growth").alias("avg_revenue_growth"),
        F.avg("late_payment_rate").alias("avg_late_payment_rate"),
        F.avg("recency_days").alias("avg_recency_days"),
        F.count_if(F.col("tier_movement") == "Upgraded").alias("upgraded"),
        F.count_if(F.col("tier_movement") == "Downgraded").alias("downgraded"),
    )
    every_tier = Window.partitionBy(F.lit(0))  # one row per tier
    return per_tier.withColumns(
        {
            "customer_share": safe_divide(F.col("customers"), F.sum("customers").over(every_tier)),
            "revenue_share": safe_divide(F.col("revenue_12m"), F.sum("revenue_12m").over(every_tier)),
        }
    )


def mart_tier_movement(history: DataFrame) -> DataFrame:
    runs = previous_runs(history)
    return runs.groupBy(
        "as_of_date",
        "previous_as_of_date",
        F.coalesce("previous_tier", F.lit("New")).alias("from_tier"),
        F.col("tier").alias("to_tier"),
        _movement(F.col("tier_rank"), F.col("previous_tier"), F.col("previous_tier_rank")).alias("movement"),
    ).agg(F.count(F.lit(1)).alias("customers"))


# --- dashboard datasets ------------------------------------------------------------------------


def pareto_curve(tiers: DataFrame) -> DataFrame:
    """Cumulative revenue share by customer rank, coloured by tier."""
    base = tiers.select("customer_id", "tier", "monetary_12m")
    order = [F.col("monetary_12m").desc(), F.col("customer_id").asc()]
    run = running_total(base, order, "monetary_12m", rank="customer_rank", running="cumulative_revenue", total="_all")
    return run.withColumn("cumulative_share", safe_divide(F.col("cumulative_revenue"), F.col("_all"))).drop("_all")


def tier_pyramid(mart: DataFrame) -> DataFrame:
    return mart_tier_summary(mart).select("tier", "tier_rank", "customers", "customer_share", "revenue_12m", "revenue_share")


def kpi_tiles(mart: DataFrame) -> DataFrame:
    revenue = F.sum("monetary_12m")
    top = F.sum(F.when(F.col("tier").isin("Platinum", "Gold"), F.col("monetary_12m")))
    return mart.agg(
        F.count_if("is_active").alias("active_customers"),
        revenue.alias("revenue_12m"),
        safe_divide(top, revenue).alias("top_two_tier_share"),
    )


def movement_trend(movement: DataFrame) -> DataFrame:
    return movement.groupBy("as_of_date", "movement").agg(F.sum("customers").alias("customers"))


def monthly_trend(monthly: DataFrame) -> DataFrame:
    """Revenue and margin per month with the same month a year before.  One row per month."""
    months = monthly.groupBy("month").agg(
        F.sum("net_revenue").alias("net_revenue"), F.sum("gross_margin").alias("gross_margin")
    )
    year_ago = months.select(
        F.add_months("month", 12).alias("month"), F.col("net_revenue").alias("net_revenue_year_ago")
    )
    joined = months.join(year_ago, "month", "left")
    growth = safe_divide(F.col("net_revenue") - F.col("net_revenue_year_ago"), F.col("net_revenue_year_ago"))
    return joined.withColumn("yoy_growth", growth)


def revenue_cube(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Recognised revenue for every combination of region, industry and channel.

    Orders fold to one row per customer and channel before the join, so a hot customer crosses it
    as a handful of rows.
    """
    folded = orders.groupBy("customer_id", "channel").agg(
        F.sum("recognized_revenue").alias("revenue"), F.count(F.lit(1)).alias("orders")
    )
    joined = folded.join(customers.select("customer_id", "region", "industry"), "customer_id")
    return joined.cube("region", "industry", "channel").agg(
        F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders")
    )


def payment_by_tier(orders: DataFrame, mart: DataFrame) -> DataFrame:
    """Late share and days to pay per tier; sums per customer come first."""
    paid = orders.filter("is_paid").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_late_payment").alias("late"),
        F.sum("days_to_pay").alias("days"),
    )
    joined = paid.join(mart.select("customer_id", "tier", "tier_rank"), "customer_id")
    grouped = joined.groupBy("tier", "tier_rank").agg(F.sum("n").alias("paid_orders"), F.sum("late").alias("l"), F.sum("days").alias("d"))
    return grouped.select(
        "tier",
        "tier_rank",
        "paid_orders",
        safe_divide(F.col("l"), F.col("paid_orders")).alias("late_payment_rate"),
        safe_divide(F.col("d"), F.col("paid_orders")).alias("avg_days_to_pay"),
    )


def status_grid(health: DataFrame, targets: list[str]) -> DataFrame:
    """Check by target, filled with the last severity.  ``targets`` fixes the columns."""
    return health.groupBy("check_type", "check_name").pivot("target", targets).agg(F.max("last_severity"))


def row_count_history(audit: DataFrame) -> DataFrame:
    return audit.filter("status = 'success'").select("source", "finished_at", "rows_loaded", "table_rows_after")


def quarters_until(as_of: date, count: int) -> list[date]:
    first = date(as_of.year, 3 * ((as_of.month - 1) // 3) + 1, 1)
    out = []
    for _ in range(count):
        out.append(first)
        first = date(first.year - (first.month == 1), (first.month - 4) % 12 + 1, 1)
    return out[::-1]


def prep_flow(
    mart: DataFrame, monthly: DataFrame, profiles: DataFrame | None, as_of: date, quarters: int = 4
) -> DataFrame:
    """Blended extract: quarterly revenue in columns, tiers, segment size, revenue rank, flags."""
    starts = quarters_until(as_of, quarters)
    quarter = F.trunc("month", "QUARTER")
    columns = [
        F.sum(F.when(quarter == F.lit(q), F.col("net_revenue"))).alias(f"revenue_{q.year}_q{(q.month + 2) // 3}")
        for q in starts
    ]
    recent = monthly.filter(F.col("month") >= F.lit(starts[0])).groupBy("customer_id").agg(*columns)
    falling = mart.withColumn("_falling", -F.col("monetary_12m"))
    ranked = average_rank(falling, "_falling", rank="revenue_rank", total="_n", method="min").drop("_falling")
    flags = ranked.withColumn("revenue_rank", F.col("revenue_rank").cast("bigint")).withColumns(
        {
            "is_top_20": F.col("revenue_rank") <= F.col("_n") * 0.2,
            "tier_changed": F.coalesce(F.col("previous_tier") != F.col("tier"), F.lit(False)),
        }
    ).drop("_n")
    out = flags.join(recent, "customer_id", "left")
    if profiles is not None and "segment" in mart.columns:
        sizes = profiles.select("segment", F.col("customers").alias("segment_customers"))
        out = out.join(F.broadcast(sizes), "segment", "left")  # at most seven rows
    return out
