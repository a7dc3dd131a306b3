"""Point-in-time customer features and forward labels.

All order-based features of one as-of date come from a single aggregate keyed by customer, so a
customer with a large share of all orders reaches the shuffle as one partial row per map task.
Only category breadth needs order lines; it is a distinct count with its own partial step.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctiers.operators.rank import exact_quantiles
from acctiers.settings import MODEL_FEATURES

DAYS_PER_MONTH = 30.4
_MONTH_BITS = 62


def as_date(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day


def _sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value))


def _rounded(value: Column) -> Column:
    """Money has at most four decimals; rounding takes out the noise of the summation order."""
    return F.round(F.coalesce(value, F.lit(0.0)), 4)


def order_aggregates(orders: DataFrame, keys: Sequence[str], as_of: Column, lookback_days: int) -> DataFrame:
    """Windowed sums per key; ``orders`` is already limited to the look-back window of ``as_of``."""
    day = F.col("order_date")
    done = F.col("status") == "completed"
    # the midpoint of an odd window falls on noon, so whole days compare with its floor
    second_half = F.datediff(day, F.date_sub(as_of, lookback_days)) > lookback_days // 2
    due = F.date_add(day, F.col("payment_terms_days").cast("int"))
    paid = F.col("paid_date").isNotNull() & (F.col("paid_date") <= as_of)
    overdue = due < as_of
    late = F.when(paid, F.col("paid_date") > due).otherwise(overdue)
    net, margin = F.col("net_revenue"), F.col("gross_margin")
    month = (F.months_between(F.trunc(as_of, "MM"), F.trunc(day, "MM"))).cast("int")
    if lookback_days // 28 < _MONTH_BITS:
        # one bit per calendar month: a distinct count that stays in a plain hash aggregate
        months = F.bit_count(F.bit_or(F.when(done, F.call_function("shiftleft", F.lit(1).cast("bigint"), month))))
    else:
        months = F.count_distinct(F.when(done, month))
    return orders.groupBy(*keys).agg(
        _rounded(_sum_if(done, net)).alias("monetary_12m"),
        F.count_if(done).alias("frequency_12m"),
        _rounded(_sum_if(done, margin)).alias("_margin"),
        F.avg(F.when(done, F.col("discount_pct"))).alias("avg_discount"),
        F.coalesce(months.cast("bigint"), F.lit(0)).alias("_months"),
        _rounded(_sum_if(done & ~second_half, net)).alias("_h1"),
        _rounded(_sum_if(done & second_half, net)).alias("_h2"),
        F.max(F.when(done, day)).alias("_last"),
        F.count_if(F.col("status") == "returned").alias("_returned"),
        F.avg(F.when(done & (paid | overdue), late.cast("double"))).alias("late_payment_rate"),
    )


def category_breadth(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct categories per key, of lines or of orders that carry a mask of their categories."""
    done = lines.filter(F.col("status") == "completed")
    if "category_bits" in lines.columns:
        breadth = F.bit_count(F.bit_or("category_bits")).cast("bigint")
    else:
        breadth = F.count_distinct("category")
    return done.groupBy(*keys).agg(breadth.alias("category_breadth"))


def lines_from_orders(orders: DataFrame) -> DataFrame:
    """What breadth needs, when orders carry their categories: a mask as it is, a set as order-category pairs."""
    if "category_bits" in orders.columns:
        return orders.select("order_id", "customer_id", "order_date", "status", "category_bits")
    return orders.select(
        "order_id", "customer_id", "order_date", "status", F.explode("categories").alias("category")
    )


def _derive(base: DataFrame, customers: DataFrame, as_of: Column, lookback_days: int, extra: Sequence[str]) -> DataFrame:
    revenue, orders = F.col("monetary_12m"), F.col("frequency_12m")
    halves = F.col("_h1") + F.col("_h2")
    returned = F.col("_returned")
    attributes = customers.select(
        "customer_id",
        F.col("employee_count").cast("string").alias("_employees"),
        "signup_date",
        "industry",
        "region",
    )
    joined = base.join(attributes, "customer_id", "left")
    return joined.select(
        "customer_id",
        "monetary_12m",
        "frequency_12m",
        F.datediff(as_of, F.col("_last")).cast("double").alias("recency_days"),
        F.when(revenue > 0, F.col("_margin") / revenue).otherwise(0.0).alias("gross_margin_pct"),
        F.when(halves > 0, (F.col("_h2") - F.col("_h1")) / halves).otherwise(0.0).alias("revenue_growth"),
        F.coalesce("category_breadth", F.lit(0).cast("bigint")).alias("category_breadth"),
        (F.col("_months") / F.lit(max(lookback_days / DAYS_PER_MONTH, 1.0))).alias("active_month_ratio"),
        "late_payment_rate",
        (returned / (orders + returned)).alias("return_rate"),
        (revenue / orders).alias("avg_order_value"),
        "avg_discount",
        F.greatest(F.datediff(as_of, F.col("signup_date")), F.lit(0)).cast("double").alias("tenure_days"),
        F.col("_employees").try_cast("double").alias("employee_count"),
        "industry",
        "region",
        *extra,
    )


def _between(df: DataFrame, after: date, until: date) -> DataFrame:
    """Rows dated in ``(after, until]``; where the table is stored by order_month its partitions are bounded, too."""
    rows = df.filter((F.col("order_date") > F.lit(after)) & (F.col("order_date") <= F.lit(until)))
    if "order_month" in df.columns:
        months = [F.lit(d.replace(day=1)) for d in (after, until)]
        rows = rows.filter(F.col("order_month").between(*months))
    return rows


def build_features(
    orders: DataFrame,
    lines: DataFrame,
    customers: DataFrame,
    as_of: date | str,
    lookback_days: int = 365,
    min_orders: int = 1,
) -> DataFrame:
    """One row per customer with at least ``min_orders`` completed orders in the window.

    Uses nothing dated after ``as_of``.  One limit is inherited: ``status`` is the order's latest
    status, so a return booked after ``as_of`` shows in an earlier window.
    """
    end = as_date(as_of)
    start = end - timedelta(days=lookback_days)
    today = F.lit(end)
    sums = order_aggregates(_between(orders, start, end), ["customer_id"], today, lookback_days)
    active = sums.filter(F.col("frequency_12m") >= min_orders).filter(F.col("frequency_12m") > 0)
    breadth = category_breadth(_between(lines, start, end), ["customer_id"])
    base = active.join(breadth, "customer_id", "left").withColumn("as_of_date", today)
    return _derive(base, customers, today, lookback_days, ["as_of_date"])


def build_features_multi(
    orders: DataFrame,
    lines: DataFrame,
    customers: DataFrame,
    as_of_dates: Sequence[date | str],
    lookback_days: int = 365,
    min_orders: int = 1,
) -> DataFrame:
    """The same features for several as-of dates in one pass over orders.

    Each order is copied only to the dates whose window holds it; the copy is an ``explode`` of the
    filtered date list, so it happens before the shuffle and without a join.
    """
    days = [as_date(d) for d in as_of_dates]
    dates = F.array(*[F.lit(d) for d in days])
    start = min(days) - timedelta(days=lookback_days)

    def spread(df: DataFrame) -> DataFrame:
        day = F.col("order_date")
        fits = F.filter(dates, lambda d: (day <= d) & (day > F.date_sub(d, lookback_days)))
        return _between(df, start, max(days)).withColumn("as_of_date", F.explode(fits))

    keys = ["customer_id", "as_of_date"]
    as_of = F.col("as_of_date")
    sums = order_aggregates(spread(orders), keys, as_of, lookback_days)
    active = sums.filter(F.col("frequency_12m") >= max(min_orders, 1))
    breadth = category_breadth(spread(lines), keys)
    return _derive(active.join(breadth, keys, "left"), customers, as_of, lookback_days, ["as_of_date"])


def feature_catalog(features: DataFrame) -> DataFrame:
    """Per-feature count, null count, mean and range: one aggregate, reshaped to long form."""
    stats = [
        F.struct(
            F.lit(name).alias("feature"),
            F.count(name).alias("present"),
            F.count_if(F.col(name).isNull()).alias("missing"),
            F.avg(F.col(name).cast("double")).alias("mean"),
            F.min(F.col(name).cast("double")).alias("low"),
            F.max(F.col(name).cast("double")).alias("high"),
        )
        for name in MODEL_FEATURES
    ]
    return features.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def forward_labels(
    orders: DataFrame,
    customers: DataFrame,
    as_of: date | str,
    horizon_days: int = 180,
    high_value_quantile: float = 0.8,
) -> DataFrame:
    """Outcomes in ``(as_of, as_of + horizon]`` for the customers given in ``customers``.

    ``high_value`` is revenue strictly above the quantile over those customers.
    """
    start = as_date(as_of)
    end = start + timedelta(days=horizon_days)
    future = _between(orders, start, end).filter(F.col("status") == "completed")
    sums = future.groupBy("customer_id").agg(
        _rounded(F.sum("net_revenue")).alias("future_revenue"), F.count(F.lit(1)).alias("future_orders")
    )
    labels = customers.select("customer_id").join(sums, "customer_id", "left")
    labels = labels.select(
        "customer_id",
        F.coalesce("future_revenue", F.lit(0.0)).alias("future_revenue"),
        F.coalesce("future_orders", F.lit(0).cast("bigint")).alias("future_orders"),
    )
    threshold = exact_quantiles(labels, "future_revenue", [high_value_quantile]).select("quantile").scalar()
    return labels.withColumns(
        {
            "churned": (F.col("future_orders") == 0).cast("int"),
            "high_value": (F.col("future_revenue") > threshold).cast("int"),
        }
    )
