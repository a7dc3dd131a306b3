"""The model graph: each attribute is one lazily planned model over the four raw sources.

Nothing but the list of categories runs until an action; Catalyst sees a model chain as one plan.  ``store`` writes the two
nodes that fan out, so a production run reads them instead of planning them again.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from acctiers.plans import marts, staging


class Warehouse:
    def __init__(self, raw: dict[str, DataFrame]):
        self.raw = raw

    @classmethod
    def from_test_tables(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        from acctiers.sources.testtables import raw_tables

        return cls(raw_tables(spark, sf_dir))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.raw["customers"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw["orders"])

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["order_items"])

    @cached_property
    def int_order_lines(self) -> DataFrame:
        return marts.int_order_lines(self.stg_order_items, self.stg_orders, self.stg_products)

    @cached_property
    def int_order_totals(self) -> DataFrame:
        return marts.int_order_totals(self.int_order_lines)

    @cached_property
    def fct_order_lines(self) -> DataFrame:
        return marts.fct_order_lines(self.int_order_lines)

    @cached_property
    def categories(self) -> list[str] | None:
        """Found by a small job over the raw products, all of their versions."""
        return marts.category_names(self.raw["products"])

    @cached_property
    def order_rollup(self) -> DataFrame:
        return marts.order_rollup(self.stg_order_items, self.stg_products, self.categories)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return marts.fct_orders(self.stg_orders, self.order_rollup)

    @cached_property
    def fct_orders_with_categories(self) -> DataFrame:
        return marts.fct_orders(self.stg_orders, self.order_rollup, keep_categories=True)

    @cached_property
    def fct_customer_monthly(self) -> DataFrame:
        return marts.fct_customer_monthly(self.fct_orders)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg_customers, self.fct_orders)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg_products, self.int_order_lines)

    MODELS = (
        "stg_customers",
        "stg_products",
        "stg_orders",
        "stg_order_items",
        "int_order_lines",
        "int_order_totals",
        "fct_orders",
        "fct_order_lines",
        "fct_customer_monthly",
        "dim_customers",
        "dim_products",
    )

    def model(self, name: str) -> DataFrame:
        if name not in self.MODELS:
            raise KeyError(name)
        return getattr(self, name)
