"""Staging models: newest version per key, typed and with derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers.functions import exprs as X
from acctiers.operators.latest import latest_record

AUDIT_ORDER = ("updated_at", "_loaded_at")


def _version_order(df: DataFrame, *tie_break: str) -> list[str]:
    return [c for c in (*AUDIT_ORDER, *tie_break) if c in df.columns]


def stg_customers(raw: DataFrame) -> DataFrame:
    latest = latest_record(raw, "customer_id", _version_order(raw, "business_name", "region"))
    return latest.select(
        "customer_id",
        F.trim("business_name").alias("business_name"),
        "industry",
        "region",
        "employee_count",
        X.size_band(F.col("employee_count")).alias("company_size_band"),
        "signup_date",
        "account_manager",
        "updated_at",
        *[c for c in ("_loaded_at",) if c in raw.columns],
    )


def stg_products(raw: DataFrame) -> DataFrame:
    latest = latest_record(raw, "product_id", _version_order(raw, "list_price", "unit_cost"))
    typed = latest.withColumns(
        {"unit_cost": X.money(F.col("unit_cost")), "list_price": X.money(F.col("list_price"))}
    )
    margin = X.safe_divide(F.col("list_price") - F.col("unit_cost"), F.col("list_price"))
    return typed.select(
        "product_id",
        "product_name",
        "category",
        "unit_cost",
        "list_price",
        margin.alias("list_margin_pct"),
        "updated_at",
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    latest = latest_record(raw, "order_id", _version_order(raw, "status", "customer_id"))
    typed = latest.select(
        "order_id",
        "customer_id",
        "order_date",
        F.lower("status").alias("status"),
        "channel",
        F.col("discount_pct").cast("double").alias("discount_pct"),
        "payment_terms_days",
        X.add_days(F.col("order_date"), F.col("payment_terms_days")).alias("due_date"),
        "paid_date",
        "updated_at",
        *[c for c in ("_loaded_at",) if c in raw.columns],
    )
    paid = F.col("paid_date").isNotNull()
    return typed.withColumns(
        {
            "order_month": X.month_start(F.col("order_date")),
            "is_paid": paid,
            "days_to_pay": F.when(paid, X.days_between(F.col("order_date"), F.col("paid_date"))),
            "is_late_payment": F.when(paid, F.col("paid_date") > F.col("due_date")),
        }
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    latest = latest_record(raw, "order_item_id", _version_order(raw, "product_id", "unit_price", "quantity"))
    price = X.money(F.col("unit_price"))
    return latest.select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        price.alias("unit_price"),
        (F.col("quantity") * price).alias("line_amount"),
        "updated_at",
    )
