"""The stored orders that features, marts and suites share, and what they cost."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from acctiers.catalog import load, quality, tiering
from acctiers.operators.rank import sorted_positions
from acctiers.plans import features as FT
from acctiers.plans import marts
from acctiers.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def goods(spark):
    rows = [(1, "a", 2.0), (2, "b", 3.0), (3, None, 1.0), (4, "b", 5.0)]
    return spark.createDataFrame(rows, "product_id bigint, category string, unit_cost double")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(10, 1, 2, 4.0), (10, 2, 1, 6.0), (10, 4, 1, 1.0), (10, 3, 1, 1.0), (11, 3, 1, 2.0), (12, 2, 3, 9.0), (12, 4, 1, 1.0)]
    return spark.createDataFrame(rows, "order_id bigint, product_id bigint, quantity bigint, line_amount double")


def test_category_masks_count_what_sets_hold(goods, items):
    names = marts.category_names(goods)
    assert names == ["a", "b"]
    sets = {r.order_id: r for r in marts.order_rollup(items, goods).collect()}
    masks = {r.order_id: r for r in marts.order_rollup(items, goods, names).collect()}
    for key, one in sets.items():
        held = {n for i, n in enumerate(names) if masks[key].category_bits >> i & 1}
        assert held == set(one.categories)
        assert [one[c] for c in ("line_count", "units", "gross_revenue", "cost")] == [
            masks[key][c] for c in ("line_count", "units", "gross_revenue", "cost")
        ]
    assert masks[11].category_bits == 0


def test_no_products_and_too_many_categories(spark, goods, items):
    empty = goods.limit(0)
    assert marts.category_names(empty) == [] and marts.order_rollup(items, empty, []).count() == 0
    many = spark.range(marts.MASK_BITS + 1).selectExpr("id as product_id", "concat('c', id) as category")
    assert marts.category_names(many) is None
    assert len(marts.category_names(many.limit(marts.MASK_BITS))) == marts.MASK_BITS


def test_a_category_outside_the_list_is_an_error(goods, items):
    with pytest.raises(Exception, match="category outside the list"):
        marts.order_rollup(items, goods, ["a"]).collect()


def test_breadth_is_the_same_from_masks(spark):
    rows = [(1, 7, "completed", ["a", "b"], 3), (2, 7, "completed", ["b"], 2), (3, 7, "returned", ["c"], 4), (4, 8, "completed", [], 0)]
    orders = spark.createDataFrame(
        [Row(*r) for r in rows], "order_id bigint, customer_id bigint, status string, categories array<string>, category_bits bigint"
    ).withColumn("order_date", F.lit("2001-01-01").cast("date"))
    of_sets = FT.category_breadth(FT.lines_from_orders(orders.drop("category_bits")), ["customer_id"])
    of_masks = FT.category_breadth(FT.lines_from_orders(orders.drop("categories")), ["customer_id"])
    assert {r[0]: r[1] for r in of_sets.collect()} == {7: 2}
    assert {r[0]: r[1] for r in of_masks.collect() if r[1]} == {7: 2}


def test_a_small_order_mart_keeps_no_sets(spark):
    plan = Warehouse.from_test_tables(spark, SF).fct_orders._jdf.queryExecution().toString()
    assert "collect_set" not in plan


def test_a_small_table_is_not_cut_into_hundreds_of_ranges(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key)
    spark.conf.set(key, "300")
    try:
        placed = sorted_positions(spark.range(2000).withColumn("v", F.col("id") % 7), [F.col("v").asc(), F.col("id").asc()])
        assert placed.rdd.getNumPartitions() < 100
        rows = placed.orderBy("_part", "_index").select("v", "id").collect()
        assert rows == sorted(rows)
    finally:
        spark.conf.set(key, before)


def test_marts_of_a_scored_run_read_the_stored_orders(spark):
    scored = tiering.Scored(spark, SF)
    for table in (scored.mart, scored.warehouse.fct_customer_monthly):
        assert "lineitem" not in table._jdf.queryExecution().analyzed().toString()
        assert "l_orderkey" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_suites_and_tier_tests_build_the_orders_once(spark, monkeypatch):
    made = []

    class Counted(tiering.Inputs):
        def __init__(self, *a):
            made.append("orders")
            super().__init__(*a)

    monkeypatch.setattr(quality, "Inputs", Counted)
    find = quality._relation(spark, SF)
    orders, monthly = find("marts.fct_orders"), find("marts.fct_customer_monthly")
    assert made == ["orders"]
    assert all("l_orderkey" not in t._jdf.queryExecution().optimizedPlan().toString() for t in (orders, monthly))


def test_warehouse_tests_stage_the_lines_once(spark):
    plan = load()["J_warehouse_tests"].run(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1  # the test of the raw table itself
