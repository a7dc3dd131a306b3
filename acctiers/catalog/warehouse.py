"""Queries for scalar expressions, staging, marts, windows and top-k (sections B to G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from acctiers.catalog.registry import query
from acctiers.functions import exprs as X
from acctiers.operators import latest, rank
from acctiers.plans import marts
from acctiers.plans.warehouse import Warehouse
from acctiers.sources import testtables as T

ORDERS_4 = "net_revenue:4 gross_margin:4 gross_revenue:4 cost:4 recognized_revenue:4 recognized_margin:4"


def wh(spark, sf) -> Warehouse:
    return Warehouse.from_test_tables(spark, sf)


# --- B: scalar expressions ------------------------------------------------------------------


@query(
    "B1_safe_divide",
    "select order_id, case when discount_pct <> 0 then cast(payment_terms_days as double) / discount_pct end as ratio from raw_orders",
    "ratio",
)
def _(spark, sf):
    return T.raw_orders(spark, sf).select(
        "order_id", X.safe_divide(F.col("payment_terms_days"), F.col("discount_pct")).alias("ratio")
    )


@query(
    "B2_month_start",
    "select order_id, cast(date_trunc('month', order_date) as date) as order_month from raw_orders",
)
def _(spark, sf):
    return T.raw_orders(spark, sf).select("order_id", X.month_start(F.col("order_date")).alias("order_month"))


@query(
    "B3_is_recognized",
    "select status in ('completed') as recognized, count(*) as orders from raw_orders group by 1",
)
def _(spark, sf):
    flagged = T.raw_orders(spark, sf).withColumn("recognized", X.is_recognized(F.col("status")))
    return flagged.groupBy("recognized").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "B4_size_band",
    "select company_size_band, count(*) as customers from stg_customers group by 1",
)
def _(spark, sf):
    banded = T.raw_customers(spark, sf).withColumn("company_size_band", X.size_band(F.col("employee_count")))
    return banded.groupBy("company_size_band").agg(F.count(F.lit(1)).alias("customers"))


@query(
    "B5_date_arithmetic",
    """select order_id, order_date + cast(payment_terms_days as integer) as due_date,
              date_diff('day', order_date, paid_date) as days_to_pay, order_date - 90 as window_start from raw_orders""",
)
def _(spark, sf):
    day = F.col("order_date")
    return T.raw_orders(spark, sf).select(
        "order_id",
        X.add_days(day, F.col("payment_terms_days")).alias("due_date"),
        X.days_between(day, F.col("paid_date")).alias("days_to_pay"),
        X.add_days(day, -90).alias("window_start"),
    )


@query(
    "B6_string_ops",
    """select customer_id, trim(concat('  ', business_name, ' ')) as trimmed, lower(industry) as lowered,
              regexp_replace(concat(chr(9), business_name, ' ', chr(10)), '^\\s+|\\s+$', '', 'g') as tidied from raw_customers""",
)
def _(spark, sf):
    name = F.col("business_name")
    return T.raw_customers(spark, sf).select(
        "customer_id",
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.lower("industry").alias("lowered"),
        X.tidy(F.concat(F.lit("\t"), name, F.lit(" \n"))).alias("tidied"),
    )


@query(
    "B7_null_logic",
    """select order_id, coalesce(paid_date, order_date) as settled, paid_date is not null as is_paid,
              case when paid_date is not null then paid_date > order_date + cast(payment_terms_days as integer) end as is_late
       from raw_orders""",
)
def _(spark, sf):
    due = X.add_days(F.col("order_date"), F.col("payment_terms_days"))
    paid = F.col("paid_date").isNotNull()
    return T.raw_orders(spark, sf).select(
        "order_id",
        F.coalesce("paid_date", "order_date").alias("settled"),
        paid.alias("is_paid"),
        F.when(paid, F.col("paid_date") > due).alias("is_late"),
    )


@query(
    "B8_casts",
    """select l_orderkey as order_id, cast(l_linenumber as bigint) as line, cast(cast(l_quantity as decimal(28,6)) as double) as quantity_money,
              cast(l_quantity as double) as quantity_float, cast(l_shipdate as date) as ship_day from lineitem""",
    "quantity_money quantity_float",
)
def _(spark, sf):
    return T.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        X.money(F.col("l_quantity")).alias("quantity_money"),
        F.col("l_quantity").cast("double").alias("quantity_float"),
        F.col("l_shipdate").cast("date").alias("ship_day"),
    )


@query(
    "B9_numeric_transforms",
    """select c_custkey as customer_id, ln(1 + greatest(c_acctbal, 0.0)) as logged,
              least(greatest(c_acctbal, 0.0), 5000.0) as clipped, coalesce(nullif(c_acctbal, 0.0), 1.0) as filled from customer""",
    "logged clipped:4 filled:4",
)
def _(spark, sf):
    value = F.col("c_acctbal")
    return T.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        X.log_positive(value).alias("logged"),
        X.clip(value, F.lit(0.0), F.lit(5000.0)).alias("clipped"),
        F.coalesce(F.nullif(value, F.lit(0.0)), F.lit(1.0)).alias("filled"),
    )


@query(
    "B10_regex_predicates",
    r"""select count(*) as n, count(*) filter (where regexp_matches(c_name, '^Customer#\d{9}$')) as named,
               count(*) filter (where regexp_matches(cast(c_custkey as varchar), '^[+-]?\d+$')) as integers,
               count(*) filter (where regexp_matches(cast(c_custkey as varchar), '^C\d{5}$')) as contract_ids
        from customer""",
)
def _(spark, sf):
    key = F.col("c_custkey").cast("string")
    return T.table(spark, sf, "customer").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("c_name").rlike(r"^Customer#\d{9}$")).alias("named"),
        F.count_if(key.rlike(X.INTEGER_TEXT)).alias("integers"),
        F.count_if(key.rlike(X.CUSTOMER_ID_TEXT)).alias("contract_ids"),
    )


@query(
    "B11_json_details",
    """select order_id, concat('{"status":"', status, '","terms":', payment_terms_days, '}') as details from raw_orders""",
)
def _(spark, sf):
    details = X.as_json(status=F.col("status"), terms=F.col("payment_terms_days"))
    return T.raw_orders(spark, sf).select("order_id", details.alias("details"))


@query("B12_normal_cdf")
def _(spark, sf):
    balance = T.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    stats = balance.agg(F.struct(F.avg("c_acctbal").alias("m"), F.stddev_pop("c_acctbal").alias("s"))).scalar()
    z = balance.withColumn("_s", stats).withColumn("z", (F.col("c_acctbal") - F.col("_s.m")) / F.col("_s.s"))
    return z.select("c_custkey", F.round(X.normal_cdf("z"), 6).alias("phi"))


# --- C: staging ----------------------------------------------------------------------------------


@query(
    "C1_latest_record",
    """select order_item_id, order_id, product_id, quantity, unit_price, updated_at from raw_order_items
       qualify row_number() over (partition by order_item_id order by updated_at desc, product_id desc, unit_price desc, quantity desc) = 1""",
    "unit_price:4",
)
def _(spark, sf):
    return latest.latest_record(
        T.raw_order_items(spark, sf), "order_item_id", ["updated_at", "product_id", "unit_price", "quantity"]
    )


query("C2_stg_customers", "select * from stg_customers")(lambda s, d: wh(s, d).stg_customers)
query("C3_stg_products", "select * from stg_products", "unit_cost:4 list_price:4 list_margin_pct")(
    lambda s, d: wh(s, d).stg_products
)
query("C4_stg_orders", "select * from stg_orders", "discount_pct")(lambda s, d: wh(s, d).stg_orders)
query("C5_stg_order_items", "select * from stg_order_items", "unit_price:4 line_amount:4")(
    lambda s, d: wh(s, d).stg_order_items
)


@query(
    "C6_row_filters",
    """select order_id, customer_id, order_date, status from raw_orders
       where order_date > date '2000-08-01' and order_date <= date '2001-08-01' and status in ('completed', 'returned')""",
)
def _(spark, sf):
    day = F.col("order_date")
    return (
        T.raw_orders(spark, sf)
        .filter((day > F.lit("2000-08-01").cast("date")) & (day <= F.lit("2001-08-01").cast("date")))
        .filter(F.col("status").isin("completed", "returned"))
        .select("order_id", "customer_id", "order_date", "status")
    )


LINES = "unit_price:4 gross_revenue:4 net_revenue:4 cost:4 gross_margin:4"
query("C7_fct_order_lines", "select * from int_order_lines", LINES)(lambda s, d: wh(s, d).fct_order_lines)

# --- D: joins ----------------------------------------------------------------------------------------

query("D1_int_order_lines", "select * from int_order_lines", LINES)(lambda s, d: wh(s, d).int_order_lines)
query("D2_fct_orders", "select * from fct_orders", f"discount_pct gross_margin_pct {ORDERS_4}")(
    lambda s, d: wh(s, d).fct_orders
)
query("D3_dim_customers", "select * from dim_customers", "lifetime_revenue:4 lifetime_margin:4")(
    lambda s, d: wh(s, d).dim_customers
)
query(
    "D4_dim_products", "select * from dim_products", "unit_cost:4 list_price:4 list_margin_pct net_revenue:4"
)(lambda s, d: wh(s, d).dim_products)

# --- E: aggregations -----------------------------------------------------------------------------------

query(
    "E1_int_order_totals", "select * from int_order_totals", "gross_revenue:4 net_revenue:4 cost:4 gross_margin:4"
)(lambda s, d: wh(s, d).int_order_totals)
query(
    "E2_fct_customer_monthly", "select * from fct_customer_monthly", "net_revenue:4 gross_margin:4 gross_margin_pct"
)(lambda s, d: wh(s, d).fct_customer_monthly)
query("E3_order_stats", "select * from order_stats", "lifetime_revenue:4 lifetime_margin:4")(
    lambda s, d: marts.customer_order_stats(wh(s, d).fct_orders)
)


@query(
    "E4_global_scalars",
    """select max(order_date) as as_of_date, cast(sum(cast(round(net_revenue, 4) as decimal(18,4))) as double) as total_revenue,
              count(*) as total_orders from fct_orders""",
    "total_revenue:4",
)
def _(spark, sf):
    return wh(spark, sf).fct_orders.agg(
        F.max("order_date").alias("as_of_date"),
        F.sum(F.round("net_revenue", 4).cast("decimal(18,4)")).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
    )


@query(
    "E8_having",
    """select customer_id, count(*) as orders, sum(net_revenue) as net_revenue from fct_orders
       group by customer_id having sum(net_revenue) > 1000000""",
    "net_revenue:4",
)
def _(spark, sf):
    grouped = wh(spark, sf).fct_orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("net_revenue").alias("net_revenue")
    )
    return grouped.filter("net_revenue > 1000000")


@query(
    "E9_exact_quantiles",
    """select l_returnflag, p, quantile from (
         select l_returnflag, unnest([0.01, 0.5, 0.99]) as p,
                unnest(quantile_cont(l_extendedprice, [0.01, 0.5, 0.99])) as quantile from lineitem group by l_returnflag)""",
    "p:2 quantile:4",
)
def _(spark, sf):
    # an unknown, large row count: the bracket path used beyond a million rows
    return rank.exact_quantiles(
        T.table(spark, sf, "lineitem"), "l_extendedprice", [0.01, 0.5, 0.99], ["l_returnflag"]
    )


@query(
    "E10_crosstab",
    """select r_name as region, count(*) filter (where company_size_band = 'Unknown') as unknown,
              count(*) filter (where company_size_band = 'Small (<50)') as small,
              count(*) filter (where company_size_band = 'Mid-market (50-249)') as mid,
              count(*) filter (where company_size_band = 'Enterprise (250+)') as large
       from region left join stg_customers on region = r_name group by r_name""",
)
def _(spark, sf):
    banded = wh(spark, sf).stg_customers.select("region", "company_size_band")
    bands = {"unknown": "Unknown", "small": "Small (<50)", "mid": "Mid-market (50-249)", "large": "Enterprise (250+)"}
    counts = banded.groupBy("region").agg(*[F.count_if(F.col("company_size_band") == v).alias(k) for k, v in bands.items()])
    every = T.table(spark, sf, "region").select(F.col("r_name").alias("region"))
    return every.join(counts, "region", "left").fillna(0)


@query(
    "E11_distinct_counts",
    """select customer_id, count(distinct order_month) as active_months, count(distinct category) as categories
       from int_order_lines where status = 'completed' group by customer_id""",
)
def _(spark, sf):
    done = wh(spark, sf).int_order_lines.filter("status = 'completed'")
    # one row per customer, month and category first: a hot customer shrinks before the second step
    seen = done.groupBy("customer_id", "order_month", "category").agg(F.lit(1).alias("_one"))
    return seen.groupBy("customer_id").agg(
        F.count_distinct("order_month").alias("active_months"), F.count_distinct("category").alias("categories")
    )


# --- F: whole-table ranks -----------------------------------------------------------------------------------


@query(
    "F1_newest_order_per_customer",
    """select customer_id, order_id, order_date from raw_orders
       qualify row_number() over (partition by customer_id order by order_date desc, order_id desc) = 1""",
)
def _(spark, sf):
    orders = T.raw_orders(spark, sf).select("customer_id", "order_id", "order_date")
    return latest.latest_record(orders, "customer_id", ["order_date", "order_id"])


@query(
    "F5_average_percent_rank",
    """select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_extendedprice, l_quantity,
              (rank() over (partition by l_returnflag order by l_quantity)
               + (count(*) over (partition by l_returnflag, l_quantity) - 1) / 2.0)
              / count(*) over (partition by l_returnflag) as pct
       from lineitem""",
    "pct l_extendedprice:4 l_quantity:4",
)
def _(spark, sf):
    lines = T.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_returnflag"
    )
    return rank.percent_rank_average(lines, "l_quantity", ["l_returnflag"], out="pct").drop("l_returnflag")


@query(
    "F6_ordinal_rank",
    """select c_custkey, c_mktsegment, row_number() over (order by c_mktsegment desc, c_custkey) as place,
              count(*) over () as n from customer""",
)
def _(spark, sf):
    rows = T.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    order = [F.col("c_mktsegment").desc(), F.col("c_custkey").asc()]
    return rank.ordinal_rank(rows, order, rank="place", total="n")
