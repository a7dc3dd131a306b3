"""Order, product, customer and monthly marts.

Shuffle budget of ``fct_orders``: order lines move once to find their newest version and once as
*partial sums* keyed by order (a huge order collapses inside each map task); orders move once.
The order join then reuses the ``order_id`` partitioning of both inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctiers.functions import exprs as X
from acctiers.settings import ACTIVE_WINDOW_DAYS, RECOGNIZED_STATUSES

MASK_BITS = 63


def int_order_lines(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lines priced net of the order discount, with cost and margin."""
    head = orders.select("order_id", "customer_id", "order_date", "order_month", "status", "discount_pct")
    goods = products.select("product_id", "category", "unit_cost")
    joined = items.join(head, "order_id").join(goods, "product_id")
    net = F.col("line_amount") * (1 - F.col("discount_pct"))
    cost = F.col("quantity") * F.col("unit_cost")
    return joined.select(
        "order_item_id",
        "order_id",
        "customer_id",
        "order_date",
        "order_month",
        "status",
        "product_id",
        "category",
        "quantity",
        "unit_price",
        F.col("line_amount").alias("gross_revenue"),
        net.alias("net_revenue"),
        cost.alias("cost"),
        (net - cost).alias("gross_margin"),
    )


def fct_order_lines(lines: DataFrame) -> DataFrame:
    return lines


def int_order_totals(lines: DataFrame) -> DataFrame:
    """Totals per order from priced lines."""
    return lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.size(F.collect_set("category")).cast("bigint").alias("category_count"),
        F.sum("quantity").alias("units"),
        F.sum("gross_revenue").alias("gross_revenue"),
        F.sum("net_revenue").alias("net_revenue"),
        F.sum("cost").alias("cost"),
        F.sum("gross_margin").alias("gross_margin"),
    )


def category_names(products: DataFrame) -> list[str] | None:
    """The product categories in order, where a bit mask can hold them; None where there are more."""
    found = products.select("category").where("category is not null").distinct().limit(MASK_BITS + 1).collect()
    return sorted(r[0] for r in found) if len(found) <= MASK_BITS else None


def _category_bit(category: Column, names: Sequence[str]) -> Column:
    if not names:
        return F.lit(None).cast("bigint")
    bits = F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, 1 << i)])[category].cast("bigint")
    unknown = F.raise_error(F.concat(F.lit("category outside the list: "), category)).cast("bigint")
    return F.when(category.isNotNull(), F.coalesce(bits, unknown))


def order_rollup(items: DataFrame, products: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Per-order sums that need no order header, so the roll-up happens before the order join.

    The discount is one number per order, so it can be applied to the summed amount afterwards.
    With the categories' ``names`` an order's categories are a bit mask, ``category_bits``: a plain hash
    aggregate, where sets of strings are kept as objects and sorted.  Without, ``categories`` holds at most one
    entry per product category.
    """
    goods = products.select("product_id", "category", "unit_cost")
    if names is None:
        kept = F.collect_set("category").alias("categories")
    else:
        goods = goods.withColumn("category", _category_bit(F.col("category"), names))
        kept = F.coalesce(F.bit_or("category"), F.lit(0).cast("bigint")).alias("category_bits")
    return (
        items.join(goods, "product_id")
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            kept,
            F.sum("quantity").alias("units"),
            F.sum("line_amount").alias("gross_revenue"),
            F.sum(F.col("quantity") * F.col("unit_cost")).alias("cost"),
        )
    )


def fct_orders(
    orders: DataFrame,
    rollup: DataFrame,
    statuses: Sequence[str] = RECOGNIZED_STATUSES,
    keep_categories: bool = False,
) -> DataFrame:
    """One row per order that has lines; ``keep_categories`` keeps the roll-up's set or mask of categories."""
    masked = "category_bits" in rollup.columns
    categories = "category_bits" if masked else "categories"
    priced = orders.join(rollup, "order_id").withColumn(
        "net_revenue", F.col("gross_revenue") * (1 - F.col("discount_pct"))
    )
    priced = priced.withColumn("gross_margin", F.col("net_revenue") - F.col("cost"))
    recognized = X.is_recognized(F.col("status"), statuses)
    return priced.select(
        "order_id",
        "customer_id",
        "order_date",
        "order_month",
        "status",
        "channel",
        "discount_pct",
        "payment_terms_days",
        "due_date",
        "paid_date",
        "is_paid",
        "days_to_pay",
        "is_late_payment",
        "line_count",
        (F.bit_count(categories) if masked else F.size(categories)).cast("bigint").alias("category_count"),
        "units",
        "gross_revenue",
        "net_revenue",
        "cost",
        "gross_margin",
        X.safe_divide(F.col("gross_margin"), F.col("net_revenue")).alias("gross_margin_pct"),
        F.when(recognized, F.col("net_revenue")).otherwise(F.lit(0.0)).alias("recognized_revenue"),
        F.when(recognized, F.col("gross_margin")).otherwise(F.lit(0.0)).alias("recognized_margin"),
        "updated_at",
        *([categories] if keep_categories else []),
    )


def fct_customer_monthly(orders: DataFrame, statuses: Sequence[str] = RECOGNIZED_STATUSES) -> DataFrame:
    grouped = orders.groupBy("customer_id", F.col("order_month").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(X.is_recognized(F.col("status"), statuses)).alias("completed_orders"),
        F.sum("recognized_revenue").alias("net_revenue"),
        F.sum("recognized_margin").alias("gross_margin"),
    )
    return grouped.withColumn(
        "gross_margin_pct", X.safe_divide(F.col("gross_margin"), F.col("net_revenue"))
    )


def customer_order_stats(orders: DataFrame, statuses: Sequence[str] = RECOGNIZED_STATUSES) -> DataFrame:
    recognized = X.is_recognized(F.col("status"), statuses)
    return orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max(F.when(recognized, F.col("order_date"))).alias("last_order_date"),
        F.count_if(recognized).alias("lifetime_orders"),
        F.sum("recognized_revenue").alias("lifetime_revenue"),
        F.sum("recognized_margin").alias("lifetime_margin"),
    )


def latest_order_date(orders: DataFrame) -> DataFrame:
    """The one-row as-of table."""
    return orders.agg(F.max("order_date").alias("as_of_date"))


def dim_customers(
    customers: DataFrame,
    orders: DataFrame,
    statuses: Sequence[str] = RECOGNIZED_STATUSES,
    active_days: int = ACTIVE_WINDOW_DAYS,
) -> DataFrame:
    stats = customer_order_stats(orders, statuses)
    as_of = latest_order_date(orders).scalar()
    last = F.col("last_order_date")
    return (
        customers.join(stats, "customer_id", "left")
        .withColumn("_as_of", as_of)
        .select(
            "customer_id",
            "business_name",
            "industry",
            "region",
            "employee_count",
            "company_size_band",
            "account_manager",
            "signup_date",
            "first_order_date",
            "last_order_date",
            F.coalesce("lifetime_orders", F.lit(0).cast("bigint")).alias("lifetime_orders"),
            F.coalesce("lifetime_revenue", F.lit(0.0)).alias("lifetime_revenue"),
            F.coalesce("lifetime_margin", F.lit(0.0)).alias("lifetime_margin"),
            X.days_between(last, F.col("_as_of")).alias("days_since_last_order"),
            F.coalesce(last > F.date_sub("_as_of", active_days), F.lit(False)).alias("is_active"),
        )
    )


def dim_products(products: DataFrame, lines: DataFrame, statuses: Sequence[str] = RECOGNIZED_STATUSES) -> DataFrame:
    """Lines are summed per product before the join, so a best seller arrives as partial sums."""
    sold = (
        lines.filter(X.is_recognized(F.col("status"), statuses))
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units_sold"), F.sum("net_revenue").alias("net_revenue"))
    )
    return products.join(sold, "product_id", "left").select(
        "product_id",
        "product_name",
        "category",
        "unit_cost",
        "list_price",
        "list_margin_pct",
        F.coalesce("units_sold", F.lit(0).cast("bigint")).alias("units_sold"),
        F.coalesce("net_revenue", F.lit(0.0)).alias("net_revenue"),
    )
