"""Queries for data tests, expectation suites and their joins (sections D8 to D10, J, K)."""

from __future__ import annotations

from datetime import datetime
from functools import cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers import settings as S
from acctiers.catalog.registry import query
from acctiers.catalog.sql import PARTS
from acctiers.catalog import monitoring as MO
from acctiers.catalog.tiering import Inputs, Scored
from acctiers.operators import dqtests as D
from acctiers.operators import expect as K
from acctiers.operators import monitor as M
from acctiers.plans import published as P
from acctiers.plans.warehouse import Warehouse
from acctiers.session import freeze, kept
from acctiers.sources import testtables as T

NOW = datetime(2001, 7, 15)


def _list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


# --- J: data tests, failing rows ---------------------------------------------------------------

query(
    "J1_unique",
    "select order_item_id, count(*) as n_records from raw_order_items group by order_item_id having count(*) > 1",
)(lambda s, d: D.duplicate_keys(T.raw_order_items(s, d), "order_item_id"))
query("J2_not_null", "select customer_id, region from raw_customers where employee_count is null")(
    lambda s, d: D.not_null(T.raw_customers(s, d), "employee_count").select("customer_id", "region")
)
query(
    "J3_accepted_values",
    f"""select region as value_field, count(*) as n_records from stg_customers
        where region not in ({_list(S.REGIONS)}) group by region""",
)(lambda s, d: D.accepted_values(Warehouse.from_test_tables(s, d).stg_customers, "region", S.REGIONS))
_ORPHANS = """select order_id as from_field, count(*) as n_records from stg_orders o
              where not exists (select 1 from stg_order_items i where i.order_id = o.order_id) group by order_id"""


def _orders_without_lines(spark, sf) -> DataFrame:
    w = Warehouse.from_test_tables(spark, sf)
    return D.relationships(w.stg_orders, "order_id", w.stg_order_items, "order_id")


query("J4_relationships", _ORPHANS)(_orders_without_lines)
query("D8_left_anti", _ORPHANS)(_orders_without_lines)
query(
    "J5_accepted_range",
    "select order_id, net_revenue from fct_orders where not (net_revenue >= 1000 and net_revenue <= 500000)",
    "net_revenue:4",
)(
    lambda s, d: D.accepted_range(Warehouse.from_test_tables(s, d).fct_orders, "net_revenue", 1000, 500000).select(
        "order_id", "net_revenue"
    )
)
query(
    "J6_expression_is_true",
    "select order_id, gross_margin from fct_orders where not (recognized_margin >= 0)",
    "gross_margin:4",
)(
    lambda s, d: D.expression_is_true(Warehouse.from_test_tables(s, d).fct_orders, "recognized_margin >= 0").select(
        "order_id", "gross_margin"
    )
)
query(
    "J7_unique_combination",
    "select order_id, product_id, count(*) as n_records from raw_order_items group by order_id, product_id having count(*) > 1",
)(lambda s, d: D.unique_combination(T.raw_order_items(s, d), "order_id", "product_id"))


@query(
    "J8_totals_reconcile",
    """select o.order_id, o.net_revenue, sum(l.net_revenue) as line_total from fct_orders o
       join int_order_lines l on l.order_id = o.order_id group by o.order_id, o.net_revenue
       having abs(o.net_revenue - sum(l.net_revenue)) > 0.01""",
    "net_revenue:4 line_total:4",
)
def _(spark, sf):
    w = Warehouse.from_test_tables(spark, sf)
    return D.totals_reconcile(w.fct_orders, w.fct_order_lines)


_OUTSIDE = f"""select o.order_id, o.order_date, c.signup_date from fct_orders o join stg_customers c on c.customer_id = o.customer_id
               where o.order_date < c.signup_date or o.order_date > date '{NOW.date()}'"""


def _outside(spark, sf) -> DataFrame:
    w = Warehouse.from_test_tables(spark, sf)
    return D.orders_outside_customer_life(w.fct_orders, w.dim_customers, NOW)


query("J9_orders_outside_customer_life", _OUTSIDE)(_outside)
query("D10_signup_join", _OUTSIDE)(_outside)

_BOUNDS = """with b as (select tier_rank, min(composite_score) as min_score, max(composite_score) as max_score
                        from mart_customer_tiers group by tier_rank)
             select x.tier_rank, x.min_score, y.max_score from b x join b y on y.tier_rank = x.tier_rank + 1"""
query("J10_tier_scores_ordered", f"{_BOUNDS} where x.min_score < y.max_score", "min_score:4 max_score:4")(
    lambda s, d: D.tier_scores_out_of_order(Scored(s, d).mart)
)
# the current score against the tier of the run before: here neighbouring ranges do overlap
query(
    "D9_adjacent_tiers",
    """with b as (select previous_tier_rank as tier_rank, min(composite_score) as min_score, max(composite_score) as max_score
                  from scored_now t join previous h on h.customer_id = t.customer_id and h.as_of_date = t.as_of_date
                  where previous_tier_rank is not null group by 1)
       select x.tier_rank, x.min_score, y.max_score from b x join b y on y.tier_rank = x.tier_rank + 1
       where x.min_score < y.max_score""",
    "min_score:4 max_score:4",
)(
    lambda s, d: (
        lambda run: D.tier_scores_out_of_order(
            P.previous_runs(run.history)
            .filter("previous_tier_rank is not null")
            .select("customer_id", "as_of_date", F.col("previous_tier_rank").alias("tier_rank"))
            .join(run.tiers.select("customer_id", "as_of_date", "composite_score"), ["customer_id", "as_of_date"])
        )
    )(Scored(s, d))
)


def _count_sql(test: D.DataTest) -> str:
    relation = {"fct_order_lines": "int_order_lines"}.get(test.relation, test.relation)
    first = test.column.split(",")[0]
    if test.kind in ("unique", "unique_combination"):
        where = f"where {first} is not null" if test.kind == "unique" else ""
        body = f"select 1 from {relation} {where} group by {test.column} having count(*) > 1"
    elif test.kind == "not_null":
        body = f"select 1 from {relation} where {test.column} is null"
    elif test.kind == "accepted_values":
        body = f"select {first} from {relation} where {first} not in ({_list(test.args)}) group by {first}"
    elif test.kind == "relationships":
        parent, key = test.args
        body = f"select c.{first} from {relation} c left join {parent} p on p.{key} = c.{first} where p.{key} is null and c.{first} is not null group by 1"
    elif test.kind == "accepted_range":
        low, high, inclusive = (*test.args, *(None, None, True)[len(test.args) :])
        parts = [f"{first} {'<' if inclusive else '<='} {low}"] if low is not None else []
        parts += [f"{first} {'>' if inclusive else '>='} {high}"] if high is not None else []
        body = f"select 1 from {relation} where {' or '.join(parts)}"
    else:
        body = f"select 1 from {relation} where not ({test.column})"
    return f"select '{test.relation}' as relation, '{test.label}' as test, count(*) as failures from ({body})"


_WAREHOUSE_TESTS = [*D.RAW_TESTS, *D.STAGING_TESTS, *D.MART_TESTS]


@query("J_warehouse_tests", " union all ".join(_count_sql(t) for t in _WAREHOUSE_TESTS))
def _(spark, sf):
    w = Warehouse.from_test_tables(spark, sf)
    for name in ("stg_orders", "stg_order_items", "int_order_lines", "fct_orders"):  # the nodes that fan out
        setattr(w, name, kept(w.model(name), name))
    return D.count_failures(_WAREHOUSE_TESTS, lambda name: w.raw[name[4:]] if name.startswith("raw_") else w.model(name))


# segments come from clusters, which SQL does not make again: the checks ask that every customer has one
PARTS["segmented_mart"] = "select *, 'named' as segment from mart_customer_tiers"
PARTS["segmented_tiers"] = "select *, 'named' as segment from scored_now"


def _tiering_test_sql(test: D.DataTest) -> str:
    sql = _count_sql(test)
    return sql.replace("from mart_customer_tiers ", "from segmented_mart ") if test.column == "segment" else sql


@query("J_tiering_tests", " union all ".join(_tiering_test_sql(t) for t in D.TIERING_TESTS))
def _(spark, sf):
    scored = Scored(spark, sf)
    mart = freeze(P.mart_customer_tiers(scored.segmented(), scored.warehouse.dim_customers, scored.history))
    models = {
        "mart_customer_tiers": mart,
        "mart_tier_summary": P.mart_tier_summary(mart),
        "mart_tier_movement": P.mart_tier_movement(scored.history),
        "dim_customers": scored.warehouse.stg_customers,
    }
    return D.count_failures(D.TIERING_TESTS, models.__getitem__)


query("J_health_tests", " union all ".join(_count_sql(t) for t in D.HEALTH_TESTS))(
    lambda s, d: D.count_failures(D.HEALTH_TESTS, lambda name: M.mart_data_health(MO.check_log(s, d), MO.NOW))
)


# --- K: expectation suites ---------------------------------------------------------------------------

_RELATIONS = {
    "raw.customers": "raw_customers",
    "raw.products": "raw_products",
    "raw.orders": "raw_orders",
    "raw.order_items": "raw_order_items",
    "marts.fct_orders": "fct_orders",
    "marts.dim_customers": "dim_customers",
    "marts.fct_customer_monthly": "fct_customer_monthly",
    "tiering.customer_tiers": "segmented_tiers",
}
_NULLS = "cast(null as bigint) as element_count, cast(null as bigint) as unexpected_count"


def _expectation_sql(suite: K.Suite, position: int, e: K.Expectation, columns: dict[str, int]) -> str:
    relation, a = _RELATIONS[suite.relation], e.args
    head = f"select '{suite.name}' as suite, '{suite.relation}' as relation, '{suite.severity}' as severity, cast({position} as bigint) as position, '{e.kind}' as expectation, '{e.column}' as column_name"
    if e.kind == "row_count":
        return f"{head}, {_NULLS}, cast(count(*) as double) as observed_value, count(*) >= {a['low']} as success from {relation}"
    if e.kind == "columns_include":
        return f"{head}, {_NULLS}, cast({columns[suite.relation]} as double) as observed_value, true as success"
    if e.kind == "mean_between":
        return f"{head}, {_NULLS}, avg({e.column}) as observed_value, avg({e.column}) >= {a['low']} as success from {relation}"
    if e.kind == "distinct_equal":
        same = f"count(distinct {e.column}) = {len(a['values'])} and bool_and({e.column} in ({_list(a['values'])}))"
        return f"{head}, {_NULLS}, cast(count(distinct {e.column}) as double) as observed_value, {same} as success from {relation}"
    if e.kind in ("unique", "compound_unique"):
        some = " or ".join(f"{c} is not null" for c in e.column.split(","))
        source = f"(select count(*) as c from {relation} where {some} group by {e.column})"
        n, bad = "cast(sum(c) as bigint)", "cast(coalesce(sum(c) filter (where c > 1), 0) as bigint)"
    else:
        source = relation
        if e.kind == "pair_at_least":
            left, right = e.column.split(",")
            word = "and" if a.get("ignore") == "either_missing" else "or"
            seen, good = f"({left} is not null {word} {right} is not null)", f"coalesce({left} >= {right}, false)"
        else:
            seen = "true" if e.kind == "not_null" else f"{e.column} is not null"
            if e.kind == "not_null":
                good = f"{e.column} is not null"
            elif e.kind == "regex":
                good = f"regexp_matches(cast({e.column} as varchar), '{a['regex']}')"
            elif e.kind == "in_set":
                good = f"{e.column} in ({_list(a['values'])})"
            else:
                tests = [f"{e.column} {'>' if a.get('strict_low') else '>='} {a['low']}"] if a.get("low") is not None else []
                tests += [f"{e.column} <= {a['high']}"] if a.get("high") is not None else []
                good = " and ".join(tests)
        n, bad = f"count(*) filter (where {seen})", f"count(*) filter (where {seen} and not ({good}))"
    return f"{head}, {n} as element_count, {bad} as unexpected_count, cast(null as double) as observed_value, ({n} - {bad}) >= {n} * {e.mostly} as success from {source}"


_COLUMN_COUNTS = {"raw.customers": 8, "raw.orders": 9}
_EVERY = [suite for layer in K.LAYERS.values() for suite in layer]
PARTS["expectations"] = " union all ".join(
    f"select * from ({_expectation_sql(suite, i, e, _COLUMN_COUNTS)})"
    for suite in _EVERY
    for i, e in enumerate(suite.expectations, 1)
)


def _relation(spark, sf):
    raw = T.raw_tables(spark, sf)
    inputs = cache(lambda: Inputs(spark, sf))  # marts and tiers share the stored orders

    def find(name: str) -> DataFrame:
        layer, table = name.split(".")
        if layer == "tiering":
            return inputs().run(segment=True).tiers
        return raw[table] if layer == "raw" else inputs().warehouse.model(table)

    return find


def _suite_results(spark, sf) -> DataFrame:
    find = _relation(spark, sf)
    return reduce(DataFrame.unionByName, [K.run_suite(find(s.relation), s) for s in _EVERY])


query("K_all_expectations", "select * from expectations", "observed_value")(_suite_results)

_KINDS = {
    "K1_row_count": "row_count",
    "K2_columns_include": "columns_include",
    "K3_not_null": "not_null",
    "K4_unique": "unique",
    "K5_regex": "regex",
    "K6_between": "between",
    "K7_pair_at_least": "pair_at_least",
    "K8_compound_unique": "compound_unique",
    "K9_in_set": "in_set",
    "K10_mean_between": "mean_between",
}


def _only(kind: str):
    chosen = [
        K.Suite(s.name, s.relation, s.severity, tuple(e for e in s.expectations if e.kind == kind))
        for s in [*K.RAW, *K.MARTS]
        if any(e.kind == kind for e in s.expectations)
    ]
    sql = " union all ".join(
        f"select * from ({_expectation_sql(s, i, e, _COLUMN_COUNTS)})" for s in chosen for i, e in enumerate(s.expectations, 1)
    )

    def run(spark, sf) -> DataFrame:
        find = _relation(spark, sf)
        parts = [K.run_suite(find(s.relation), s) for s in chosen]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    return sql, run


for _name, _kind in _KINDS.items():
    _sql, _run = _only(_kind)
    query(_name, _sql, "observed_value")(_run)

query(
    "K11_distinct_equal",
    " union all ".join(
        f"select * from ({_expectation_sql(suite, i, e, _COLUMN_COUNTS)})" for suite in K.TIERING for i, e in enumerate(suite.expectations, 1)
    ),
    "observed_value",
)(lambda s, d: reduce(DataFrame.unionByName, [K.run_suite(find(suite.relation), suite) for find in [_relation(s, d)] for suite in K.TIERING]))

_SUMMARY = """
select 'data_quality' as check_type, suite as check_name, relation as target,
       case when bool_and(success) then 'pass' else severity end as severity,
       concat(count(*) filter (where success), '/', count(*), ' expectations passed',
              case when bool_and(success) then '' else
                concat('; failed: ', string_agg(expectation, ', ' order by position) filter (where not success)) end) as message,
       100.0 * count(*) filter (where success) / count(*) as observed_value, cast(100.0 as double) as threshold
from expectations group by suite, relation, severity"""
query("K12_suite_summary", _SUMMARY, "observed_value")(lambda s, d: K.summarize(_suite_results(s, d)).drop("details"))


@query("K13_run_layer", f"select split_part(target, '.', 1) as layer, * from ({_SUMMARY})", "observed_value")
def _(spark, sf):
    """All three layers."""
    find = _relation(spark, sf)
    done = [K.run_layer(spark, suites, find).withColumn("layer", F.lit(layer)) for layer, suites in K.LAYERS.items()]
    return reduce(DataFrame.unionByName, done).drop("details")


@query(
    "K_contract_nullability",
    " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as nulls from raw_orders"
        for c, (_, nullable) in S.CONTRACTS["orders"].items()
        if not nullable
    ),
)
def _(spark, sf):
    return K.contract_nullability(T.raw_orders(spark, sf), "orders")
