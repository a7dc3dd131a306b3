"""Adapter: the generated star-schema tables seen as the four contracted sources.

Ids stay ``bigint`` so that joins stay cheap.  Money is cut to whole cents with ``floor`` because
rounding a double to two places differs between engines at ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(expr: str) -> str:
    return f"cast(cast(cast(floor({expr}) as bigint) as decimal(18,0)) * cast('0.01' as decimal(3,2)) as decimal(28,6))"


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    where = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer = table(spark, sf_dir, "customer")
    return customer.join(where, customer.c_nationkey == where.n_nationkey).selectExpr(
        "c_custkey as customer_id",
        "c_name as business_name",
        "c_mktsegment as industry",
        "r_name as region",
        "case when c_acctbal < -500 then null else cast(floor(abs(c_acctbal) / 10) as bigint) + 1 end as employee_count",
        "date_add(date '1993-01-01', cast((c_custkey * 37) % 900 as int)) as signup_date",
        "concat('AM-', lpad(cast(c_custkey % 15 + 1 as string), 2, '0')) as account_manager",
        "timestamp_ntz '2001-07-30 00:00:00' as updated_at",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as product_id",
        "p_name as product_name",
        "p_type as category",
        f"{_cents('p_retailprice * (60 + p_size % 30)')} as unit_cost",
        "cast(p_retailprice as decimal(28,6)) as list_price",
        "timestamp_ntz '2001-07-30 00:00:00' as updated_at",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as order_id",
        "o_custkey as customer_id",
        "cast(o_orderdate as date) as order_date",
        "case when o_orderstatus in ('F', 'O') then 'completed' when o_orderkey % 2 = 0 then 'cancelled' else 'returned' end as status",
        "o_orderpriority as channel",
        "cast(o_orderkey % 11 as double) / 100 as discount_pct",
        "cast(case o_orderkey % 4 when 0 then 15 when 1 then 30 when 2 then 45 else 60 end as bigint) as payment_terms_days",
    )
    paid = F.expr(
        "case when status = 'completed' and order_id % 9 <> 0 then date_add(order_date, "
        "cast(greatest(payment_terms_days + (order_id * 7) % 40 - 20, 0) as int)) end"
    )
    return base.withColumn("paid_date", paid).withColumn(
        "updated_at", F.coalesce("paid_date", "order_date").cast("timestamp_ntz")
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber as order_item_id",
        "l_orderkey as order_id",
        "l_partkey as product_id",
        "cast(l_quantity as bigint) as quantity",
        f"{_cents('l_extendedprice * 100 / l_quantity')} as unit_price",
        "l_shipdate as updated_at",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": raw_customers(spark, sf_dir),
        "products": raw_products(spark, sf_dir),
        "orders": raw_orders(spark, sf_dir),
        "order_items": raw_order_items(spark, sf_dir),
    }
