"""Expectation suites, one aggregate per relation.

Every value-level expectation is a pair of counts (considered, unexpected) inside a single ``agg``;
uniqueness adds one grouped count per key.  Nulls leave the denominator (except for not-null), a
duplicate group counts with all its members, and ``mostly`` is the passing share of considered rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctiers import settings as S
from acctiers.operators.checks import CHECK_COLUMNS, check_rows
from acctiers.session import literal_rows


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str = ""
    args: dict = field(default_factory=dict)
    mostly: float = 1.0


@dataclass(frozen=True)
class Suite:
    name: str
    relation: str
    severity: str
    expectations: tuple[Expectation, ...]


def _expected(e: Expectation) -> tuple[Column, Column]:
    """(row is considered, value is as expected) for a value-level expectation."""
    a = e.args
    if e.kind == "pair_at_least":
        left, right = (F.col(c) for c in e.column.split(","))
        both = left.isNotNull() & right.isNotNull()
        either = left.isNotNull() | right.isNotNull()
        considered = both if a.get("ignore") == "either_missing" else either
        good = left >= right if a.get("or_equal") else left > right
        return considered, F.coalesce(good, F.lit(False))
    value = F.col(e.column)
    if e.kind == "not_null":
        return F.lit(True), value.isNotNull()
    if e.kind == "regex":
        return value.isNotNull(), value.cast("string").rlike(a["regex"])
    if e.kind == "between":
        low, high = a.get("low"), a.get("high")
        good = F.lit(True)
        if low is not None:
            good = good & (value > low if a.get("strict_low") else value >= low)
        if high is not None:
            good = good & (value <= high)
        return value.isNotNull(), good
    if e.kind == "in_set":
        return value.isNotNull(), value.isin(list(a["values"]))
    raise ValueError(e.kind)


def _row(position: int, e: Expectation, considered: Column, unexpected: Column, observed: Column, success: Column):
    return F.struct(
        F.lit(position).cast("bigint").alias("position"),
        F.lit(e.kind).alias("expectation"),
        F.lit(e.column).alias("column_name"),
        considered.cast("bigint").alias("element_count"),
        unexpected.cast("bigint").alias("unexpected_count"),
        observed.cast("double").alias("observed_value"),
        success.alias("success"),
    )


def _mostly(considered: Column, unexpected: Column, e: Expectation) -> Column:
    share = (considered - unexpected) / considered
    return F.when(considered == 0, True).otherwise(share >= F.lit(e.mostly))


def _within(observed: Column, a: dict) -> Column:
    good = observed.isNotNull()
    if a.get("low") is not None:
        good = good & (observed >= a["low"])
    if a.get("high") is not None:
        good = good & (observed <= a["high"])
    return good


def _table_level(df: DataFrame, position: int, e: Expectation) -> Column:
    none = F.lit(None)
    rows = F.count(F.lit(1))
    if e.kind == "row_count":
        return _row(position, e, none, none, rows, _within(rows, e.args))
    if e.kind == "columns_include":
        missing = [c for c in e.args["columns"] if c not in df.columns]
        return _row(position, e, none, none, F.lit(float(len(df.columns))), F.lit(not missing))
    if e.kind == "mean_between":
        mean = F.avg(e.column)
        return _row(position, e, none, none, mean, _within(mean, e.args))
    if e.kind == "distinct_equal":
        # at most the expected values plus one marker for anything else
        wanted = list(e.args["values"])
        seen = F.collect_set(F.when(F.col(e.column).isin(wanted), F.col(e.column).cast("string")).when(
            F.col(e.column).isNotNull(), F.lit("~other")
        ))
        same = (F.size(seen) == len(wanted)) & ~F.array_contains(seen, "~other")
        return _row(position, e, none, none, F.size(seen), same)
    considered, good = _expected(e)
    n = F.count_if(considered)
    bad = F.count_if(considered & ~good)
    return _row(position, e, n, bad, none, _mostly(n, bad, e))


def _uniqueness(df: DataFrame, position: int, e: Expectation) -> DataFrame:
    columns = e.column.split(",")
    present = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])
    groups = df.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce(F.sum("_n"), F.lit(0))
    bad = F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0))
    row = _row(position, e, n, bad, F.lit(None), _mostly(n, bad, e))
    return groups.agg(F.array(row).alias("r")).select(F.inline("r"))


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """One row per expectation with its counts and outcome."""
    keyed = [(i, e) for i, e in enumerate(suite.expectations, 1) if e.kind in ("unique", "compound_unique")]
    plain = [(i, e) for i, e in enumerate(suite.expectations, 1) if e.kind not in ("unique", "compound_unique")]
    parts = [_uniqueness(df, i, e) for i, e in keyed]
    if plain:
        rows = F.array(*[_table_level(df, i, e) for i, e in plain])
        parts.append(df.agg(rows.alias("r")).select(F.inline("r")))
    named = reduce(DataFrame.unionByName, parts)
    return named.select(
        F.lit(suite.name).alias("suite"), F.lit(suite.relation).alias("relation"), F.lit(suite.severity).alias("severity"), "*"
    )


def summarize(results: DataFrame) -> DataFrame:
    """One check row per suite: pass, or the suite's own severity."""
    failed = F.sort_array(
        F.collect_list(
            F.when(
                ~F.col("success"),
                F.struct("position", "expectation", "column_name", "unexpected_count", "observed_value"),
            )
        )
    )
    grouped = results.groupBy("suite", "relation", "severity").agg(
        F.count_if("success").alias("ok"), F.count(F.lit(1)).alias("total"), failed.alias("failed")
    )
    names = F.array_join(F.transform("failed", lambda f: f["expectation"]), ", ")
    every = F.col("ok") == F.col("total")
    message = F.concat(
        F.format_string("%d/%d expectations passed", "ok", "total"),
        F.when(every, "").otherwise(F.concat(F.lit("; failed: "), names)),
    )
    return check_rows(
        grouped,
        check_type=F.lit("data_quality"),
        check_name=F.col("suite"),
        target=F.col("relation"),
        severity=F.when(every, "pass").otherwise(F.col("severity")),
        message=message,
        observed_value=100.0 * F.col("ok") / F.col("total"),
        threshold=F.lit(100.0),
        details=F.to_json(F.struct(F.col("failed").alias("failed_expectations"))),
    )


class DataQualityError(RuntimeError):
    pass


def run_layer(
    spark: SparkSession,
    suites: list[Suite],
    relation: Callable[[str], DataFrame | None],
    raise_on_error: bool = False,
) -> DataFrame:
    """All suites of a layer.  A missing relation fails its suite."""
    results, missing = [], []
    for suite in suites:
        df = relation(suite.relation)
        if df is None:
            missing.append((suite.name, suite.relation, suite.severity))
        else:
            results.append(run_suite(df, suite))
    parts = []
    if results:
        parts.append(summarize(reduce(DataFrame.unionByName, results)))
    if missing:
        absent = literal_rows(spark, missing, "suite string, relation string, severity string")
        parts.append(
            check_rows(
                absent,
                check_type=F.lit("data_quality"),
                check_name=F.col("suite"),
                target=F.col("relation"),
                severity=F.col("severity"),
                message=F.lit("relation does not exist"),
            )
        )
    checks = reduce(DataFrame.unionByName, parts).select(*CHECK_COLUMNS)
    if raise_on_error:
        errors = checks.filter("severity = 'error'").select("check_name", "message").collect()  # one row per suite
        if errors:
            raise DataQualityError("; ".join(f"{r['check_name']}: {r['message']}" for r in errors))
    return checks


def _e(kind: str, column: str = "", mostly: float = 1.0, **args) -> Expectation:
    return Expectation(kind, column, args, mostly)


def _contract(source: str) -> Expectation:
    return _e("columns_include", columns=tuple(S.CONTRACTS[source]))


_SOME_ROWS = _e("row_count", low=1)

RAW = [
    Suite(
        "raw_customers",
        "raw.customers",
        "error",
        (
            _SOME_ROWS,
            _contract("customers"),
            _e("not_null", "customer_id"),
            _e("unique", "customer_id"),
            _e("regex", "customer_id", regex=r"^C\d{5}$"),
            _e("not_null", "industry"),
            _e("between", "employee_count", 0.99, low=1, high=1_000_000),
            _e("not_null", "employee_count", 0.9),
        ),
    ),
    Suite(
        "raw_products",
        "raw.products",
        "error",
        (
            _SOME_ROWS,
            _e("unique", "product_id"),
            _e("between", "list_price", low=0, strict_low=True),
            _e("between", "unit_cost", low=0),
            _e("pair_at_least", "list_price,unit_cost", 0.98, or_equal=True),
        ),
    ),
    Suite(
        "raw_orders",
        "raw.orders",
        "error",
        (
            _SOME_ROWS,
            _contract("orders"),
            _e("not_null", "order_id"),
            _e("compound_unique", "order_id,updated_at"),
            _e("not_null", "customer_id"),
            _e("in_set", "status", values=S.ORDER_STATUSES),
            _e("in_set", "channel", values=S.CHANNELS),
            _e("between", "discount_pct", low=0, high=0.5),
            _e("in_set", "payment_terms_days", values=S.PAYMENT_TERMS),
            _e("pair_at_least", "paid_date,order_date", or_equal=True, ignore="either_missing"),
        ),
    ),
    Suite(
        "raw_order_items",
        "raw.order_items",
        "error",
        (
            _SOME_ROWS,
            _e("compound_unique", "order_item_id,updated_at"),
            _e("not_null", "order_id"),
            _e("not_null", "product_id"),
            _e("between", "quantity", low=1, high=10_000),
            _e("between", "unit_price", low=0, strict_low=True),
        ),
    ),
]
MARTS = [
    Suite(
        "marts_fct_orders",
        "marts.fct_orders",
        "error",
        (
            _SOME_ROWS,
            _e("unique", "order_id"),
            _e("not_null", "customer_id"),
            _e("between", "net_revenue", low=0),
            _e("between", "gross_margin_pct", 0.99, low=-1, high=1),
            _e("mean_between", "net_revenue", low=1),
        ),
    ),
    Suite(
        "marts_dim_customers",
        "marts.dim_customers",
        "error",
        (_e("unique", "customer_id"), _e("between", "lifetime_revenue", low=0)),
    ),
    Suite(
        "marts_fct_customer_monthly",
        "marts.fct_customer_monthly",
        "warn",
        (_e("compound_unique", "customer_id,month"), _e("between", "net_revenue", low=0)),
    ),
]
TIERING = [
    Suite(
        "tiering_customer_tiers",
        "tiering.customer_tiers",
        "error",
        (
            _SOME_ROWS,
            _e("unique", "customer_id"),
            _e("between", "composite_score", low=0, high=100),
            _e("in_set", "tier", values=tuple(S.tier_names())),
            _e("distinct_equal", "tier", values=tuple(S.tier_names())),
            _e("not_null", "segment"),
        ),
    ),
]
LAYERS = {"raw": RAW, "marts": MARTS, "tiering": TIERING}


def contract_nullability(df: DataFrame, source: str) -> DataFrame:
    """Nulls per column a contract declares non-null (an optional check)."""
    required = [c for c, (_, nullable) in S.CONTRACTS[source].items() if not nullable and c in df.columns]
    counts = [F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in required]
    return df.agg(F.array(*counts).alias("r")).select(F.inline("r"))
