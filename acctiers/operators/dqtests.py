"""Data tests: each function returns the failing rows; ``count_failures`` runs many at once.

Row-level tests on one relation share a single aggregate; key tests use a grouped count with a
map-side partial step, so a key repeated a billion times is one partial row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctiers import settings as S


def duplicate_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Key values (all parts non-null for a single key) that appear more than once."""
    rows = df.filter(F.col(columns[0]).isNotNull()) if len(columns) == 1 else df
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


unique = duplicate_keys
unique_combination = duplicate_keys


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    counts = df.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(~F.col("value_field").isin(list(values)))


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-null key has no parent.

    Child keys are counted per value first: a hot key crosses the join once.
    """
    keys = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("from_field"))
    children = keys.agg(F.count(F.lit(1)).alias("n_records"))
    parents = parent.select(F.col(parent_column).alias("from_field"))
    return children.join(parents, "from_field", "left_anti")


def out_of_range(column: str, low=None, high=None, inclusive: bool = True) -> Column:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | ~(c >= F.lit(low) if inclusive else c > F.lit(low))
    if high is not None:
        bad = bad | ~(c <= F.lit(high) if inclusive else c < F.lit(high))
    return F.coalesce(bad, F.lit(False))


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    return df.filter(out_of_range(column, low, high, inclusive))


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    return df.filter(~F.expr(expression))


def totals_reconcile(orders: DataFrame, lines: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Orders whose net revenue differs from the sum of their lines."""
    sums = lines.groupBy("order_id").agg(F.sum("net_revenue").alias("line_total"))
    joined = orders.select("order_id", "net_revenue").join(sums, "order_id")
    return joined.filter(F.abs(F.col("net_revenue") - F.col("line_total")) > tolerance)


def orders_outside_customer_life(orders: DataFrame, customers: DataFrame, now: datetime) -> DataFrame:
    """Orders before the customer's signup, or dated after ``now``."""
    joined = orders.select("order_id", "order_date", "customer_id").join(
        customers.select("customer_id", "signup_date"), "customer_id"
    )
    early = F.col("order_date") < F.col("signup_date")
    late = F.col("order_date") > F.lit(now.date())
    return joined.filter(early | late).select("order_id", "order_date", "signup_date")


def tier_scores_out_of_order(tiers: DataFrame) -> DataFrame:
    """Neighbouring tiers whose score ranges overlap; works on one row per tier."""
    bounds = tiers.groupBy("tier_rank").agg(
        F.min("composite_score").alias("min_score"), F.max("composite_score").alias("max_score")
    )
    better = bounds.select("tier_rank", "min_score", (F.col("tier_rank") + 1).alias("_next"))
    worse = bounds.select(F.col("tier_rank").alias("_next"), "max_score")
    return better.join(worse, "_next").filter("min_score < max_score").select("tier_rank", "min_score", "max_score")


@dataclass(frozen=True)
class DataTest:
    """A declared test.  ``kind`` picks the rule, ``args`` its parameters."""

    relation: str
    kind: str
    column: str
    args: tuple = ()

    @property
    def label(self) -> str:
        return f"{self.kind}:{self.column}"


def _row_rule(test: DataTest) -> Column | None:
    c = F.col(test.column) if test.kind != "expression_is_true" else None
    if test.kind == "not_null":
        return c.isNull()
    if test.kind == "accepted_range":
        return out_of_range(test.column, *test.args)
    if test.kind == "expression_is_true":
        return ~F.expr(test.column)
    return None


def _failing(test: DataTest, model: Callable[[str], DataFrame]) -> DataFrame:
    df = model(test.relation)
    if test.kind in ("unique", "unique_combination"):
        return duplicate_keys(df, *test.column.split(","))
    if test.kind == "accepted_values":
        return accepted_values(df, test.column, test.args)
    if test.kind == "relationships":
        return relationships(df, test.column, model(test.args[0]), test.args[1])
    raise ValueError(test.kind)


def count_failures(tests: Sequence[DataTest], model: Callable[[str], DataFrame]) -> DataFrame:
    """One row per declared test: relation, test, failures."""
    by_relation: dict[str, list[DataTest]] = {}
    parts: list[DataFrame] = []
    for test in tests:
        if test.kind in ("not_null", "accepted_range", "expression_is_true"):
            by_relation.setdefault(test.relation, []).append(test)
        else:
            failing = _failing(test, model).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(
                failing.select(F.lit(test.relation).alias("relation"), F.lit(test.label).alias("test"), "failures")
            )
    for relation, rules in by_relation.items():
        counts = [
            F.struct(F.lit(t.label).alias("test"), F.count_if(_row_rule(t)).alias("failures")) for t in rules
        ]
        one = model(relation).agg(F.array(*counts).alias("r")).select(F.lit(relation).alias("relation"), F.inline("r"))
        parts.append(one)
    return reduce(DataFrame.unionByName, parts)


def _keys(relation: str, column: str) -> list[DataTest]:
    return [DataTest(relation, "unique", column), DataTest(relation, "not_null", column)]


RAW_TESTS = [
    DataTest("raw_customers", "not_null", "customer_id"),
    *_keys("raw_products", "product_id"),
    DataTest("raw_orders", "not_null", "order_id"),
    DataTest("raw_order_items", "not_null", "order_item_id"),
]
STAGING_TESTS = [
    *_keys("stg_customers", "customer_id"),
    DataTest("stg_customers", "accepted_values", "company_size_band", S.SIZE_BANDS),
    DataTest("stg_customers", "accepted_values", "region", S.REGIONS),
    *_keys("stg_products", "product_id"),
    DataTest("stg_products", "accepted_range", "list_price", (0, None, False)),
    *_keys("stg_orders", "order_id"),
    DataTest("stg_orders", "not_null", "customer_id"),
    DataTest("stg_orders", "relationships", "customer_id", ("stg_customers", "customer_id")),
    DataTest("stg_orders", "accepted_values", "status", S.ORDER_STATUSES),
    DataTest("stg_orders", "accepted_range", "discount_pct", (0, 0.5)),
    *_keys("stg_order_items", "order_item_id"),
    DataTest("stg_order_items", "relationships", "order_id", ("stg_orders", "order_id")),
    DataTest("stg_order_items", "relationships", "product_id", ("stg_products", "product_id")),
    DataTest("stg_order_items", "accepted_range", "quantity", (1,)),
]
MART_TESTS = [
    *_keys("int_order_lines", "order_item_id"),
    *_keys("int_order_totals", "order_id"),
    *_keys("fct_orders", "order_id"),
    DataTest("fct_orders", "not_null", "customer_id"),
    DataTest("fct_orders", "relationships", "customer_id", ("dim_customers", "customer_id")),
    DataTest("fct_orders", "accepted_range", "net_revenue", (0,)),
    DataTest("fct_orders", "expression_is_true", "recognized_revenue <= net_revenue + 0.01"),
    *_keys("fct_order_lines", "order_item_id"),
    DataTest("fct_customer_monthly", "unique_combination", "customer_id,month"),
    DataTest("fct_customer_monthly", "accepted_range", "net_revenue", (0,)),
    *_keys("dim_customers", "customer_id"),
    DataTest("dim_customers", "accepted_range", "lifetime_revenue", (0,)),
    *_keys("dim_products", "product_id"),
]
HEALTH_TESTS = [DataTest("mart_data_health", "accepted_values", "last_severity", ("pass", "warn", "error"))]
TIERING_TESTS = [
    *_keys("mart_customer_tiers", "customer_id"),
    DataTest("mart_customer_tiers", "relationships", "customer_id", ("dim_customers", "customer_id")),
    DataTest("mart_customer_tiers", "not_null", "composite_score"),
    DataTest("mart_customer_tiers", "accepted_range", "composite_score", (0, 100)),
    DataTest("mart_customer_tiers", "not_null", "tier"),
    DataTest("mart_customer_tiers", "accepted_values", "tier", tuple(S.tier_names())),
    DataTest("mart_customer_tiers", "accepted_values", "tier_movement", S.MOVEMENTS),
    DataTest("mart_customer_tiers", "not_null", "segment"),
    *_keys("mart_tier_summary", "tier"),
    # a customer that skips a run makes two rows with one (date, from, to): the previous date
    # belongs to the key
    DataTest("mart_tier_movement", "unique_combination", "as_of_date,previous_as_of_date,from_tier,to_tier"),
]
DECLARED = [*RAW_TESTS, *STAGING_TESTS, *MART_TESTS, *HEALTH_TESTS, *TIERING_TESTS]
