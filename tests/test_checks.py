"""Monitors, suites and data tests on literal rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from acctiers import settings as S
from acctiers.operators import dqtests as D
from acctiers.operators import expect as K
from acctiers.operators import monitor as M
from acctiers.operators.checks import worst_severity
from acctiers.session import literal_rows

NOW = datetime(2026, 1, 2, 12)


def test_freshness_limits(spark):
    ages = [("a", 1.0), ("b", 24.0), ("c", 30.0), ("d", 48.0), ("e", None)]
    rows = [(t, "data_freshness", None if h is None else NOW - timedelta(hours=h), 24.0, 48.0) for t, h in ages]
    latest = literal_rows(
        spark, rows, "target string, check_name string, latest timestamp_ntz, warn double, error double"
    )
    got = {r["target"]: r for r in M.evaluate_freshness(latest, NOW).collect()}
    assert [got[t]["severity"] for t, _ in ages] == ["pass", "warn", "warn", "error", "error"]
    assert got["e"]["message"] == "no records found"
    assert got["c"]["message"] == "latest record 30.0h old (warn 24h / error 48h)"


def history(spark, values, source="t"):
    rows = [(source, datetime(2026, 1, 1) + timedelta(days=i), v, v, "success") for i, v in enumerate(values)]
    return literal_rows(
        spark, rows, "source string, finished_at timestamp, rows_loaded bigint, table_rows_after bigint, status string"
    )


@pytest.mark.parametrize(
    ("current", "values", "severity"),
    [
        (1003, [1000, 1020, 990, 1010, 1005], "pass"),
        (40, [1000, 1020, 990, 1010, 1005], "error"),
        (0, [1000, 1020, 990, 1010, 1005], "error"),
        (5000, [1, 2], "pass"),
        (10, [10, 10, 10], "pass"),
        (25, [10, 10, 10], "error"),
    ],
)
def test_batch_volume(spark, current, values, severity):
    batch = literal_rows(
        spark, [("t", "incremental", current, 0)], "source string, strategy string, rows_loaded bigint, table_rows bigint"
    )
    assert M.check_batch_volume(batch, history(spark, values)).first()["severity"] == severity


def test_shrunken_table_is_an_error(spark):
    sizes = literal_rows(spark, [("t", 90)], "source string, current bigint")
    row = M.check_table_volumes(sizes, history(spark, [98, 99, 100, 100])).first()
    assert row["severity"] == "error" and "shrank from 100 to 90" in row["message"]


def test_inferred_types(spark):
    cases = {
        "a": (["1", "2", None], "integer"),
        "b": (["1.5", " 2 ", "-3e4"], "float"),
        "c": (["2026-01-01", None, "2026-01-02"], "date"),
        "d": (["2026-01-01 10:00:00", "2026-01-01T10:00Z", None], "timestamp"),
        "e": (["abc", "1", None], "string"),
        "f": (["", None, "\t"], "unknown"),
        "g": (["TRUE", "no", "t"], "boolean"),
    }
    rows = list(zip(*[values for values, _ in cases.values()], strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cases))
    got = {r["column_name"]: r["logical_type"] for r in M.infer_logical_types(df).collect()}
    assert got == {c: kind for c, (_, kind) in cases.items()}


def test_drift(spark):
    observed = literal_rows(spark, [("a", "string"), ("c", "integer"), ("_x", "string")], "column_name string, logical_type string")
    differences = M.compare(observed, {"a": ("integer", True), "b": ("string", True)})
    assert {(r["column_name"], r["change"]) for r in differences.collect()} == {
        ("a", "type_change"),
        ("b", "removed"),
        ("c", "added"),
    }
    row = M.drift_to_check(differences, "x").first()
    assert row["severity"] == "error" and row["observed_value"] == 3
    assert row["message"] == "added columns ['c']; removed columns ['b']; type changes a: integer->string"
    clean = M.drift_to_check(differences.filter("false"), "x").first()
    assert clean["severity"] == "pass" and clean["message"] == "schema matches contract"
    added = M.drift_to_check(differences.filter("change = 'added'"), "x").first()
    assert added["severity"] == "warn"


def test_absent_table_lost_every_column(spark):
    row = M.check_table(spark, "products", None).first()
    assert row["severity"] == "error" and row["observed_value"] == len(S.CONTRACTS["products"])


def test_gate_names_the_bad_source(spark):
    good = spark.createDataFrame([("p", "n", "c", "1.5", "2", "2026-01-01 00:00:00")], ", ".join(f"{c} string" for c in S.CONTRACTS["products"]))
    assert M.contract_gate({"products": good}).first()["severity"] == "pass"
    with pytest.raises(M.SchemaDriftError, match="source.products"):
        M.contract_gate({"products": good.withColumn("list_price", F.lit("2 EUR"))})


def test_alerts_and_worst(spark):
    rows = [("volume", "n", "t", s, "m", None, None, "{}") for s in ("pass", "warn", "info", "error")]
    checks = spark.createDataFrame(rows, "check_type string, check_name string, target string, severity string, message string, observed_value double, threshold double, details string")
    alerts = M.select_alerts(checks).collect()
    assert [r["severity"] for r in alerts] == ["error", "warn"]
    assert alerts[0]["text"] == "[ERROR] volume | t: m"
    assert worst_severity(checks, "target").first()["severity"] == "error"


def items(spark, quantities):
    rows = [(f"I{i}", "O1", "P1", q, 5.0, NOW) for i, q in enumerate(quantities)]
    return literal_rows(spark, rows, "order_item_id string, order_id string, product_id string, quantity bigint, unit_price double, updated_at timestamp_ntz")


def test_suite_passes_then_fails(spark):
    suite = next(s for s in K.RAW if s.relation == "raw.order_items")
    good = K.summarize(K.run_suite(items(spark, [1, 3]), suite)).first()
    assert good["severity"] == "pass" and good["message"] == "6/6 expectations passed"
    bad = K.summarize(K.run_suite(items(spark, [0, 3]), suite)).first()
    assert bad["severity"] == "error" and bad["message"] == "5/6 expectations passed; failed: between"
    assert '"unexpected_count":1' in bad["details"]


def test_null_rules_of_expectations(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (None, None), (3, None)], "a int, b int")
    suite = K.Suite(
        "s",
        "x.y",
        "warn",
        (
            K.Expectation("between", "a", {"low": 2}),
            K.Expectation("pair_at_least", "a,b", {"or_equal": True}),
            K.Expectation("pair_at_least", "a,b", {"or_equal": True, "ignore": "either_missing"}),
            K.Expectation("unique", "b"),
            K.Expectation("not_null", "a", {}, 0.5),
        ),
    )
    got = {r["position"]: r for r in K.run_suite(df, suite).collect()}
    assert (got[1]["element_count"], got[1]["unexpected_count"]) == (2, 1)
    assert (got[2]["element_count"], got[2]["unexpected_count"]) == (3, 3)
    assert (got[3]["element_count"], got[3]["unexpected_count"]) == (1, 1)
    assert (got[4]["element_count"], got[4]["unexpected_count"]) == (2, 2)
    assert got[5]["success"]


def test_missing_relation_fails_its_layer(spark):
    suite = K.MARTS[1]
    assert K.run_layer(spark, [suite], lambda _: None).first()["message"] == "relation does not exist"
    with pytest.raises(K.DataQualityError):
        K.run_layer(spark, [suite], lambda _: None, raise_on_error=True)


def test_number_of_declared_tests_and_expectations():
    assert len(D.DECLARED) == 55
    assert sum(len(s.expectations) for s in [*K.RAW, *K.MARTS, *K.TIERING]) == 45


def test_tests_ignore_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert [tuple(r) for r in D.unique(df, "k").collect()] == [(1, 2)]
    parent = spark.createDataFrame([(2,)], "k int")
    assert [tuple(r) for r in D.relationships(df, "k", parent, "k").collect()] == [(1, 2)]


def test_data_health_keeps_the_newest(spark):
    rows = [
        (NOW - timedelta(days=40), "volume", "n", "t", "error", "old", 1.0, 2.0),
        (NOW - timedelta(days=2), "volume", "n", "t", "warn", "mid", 1.0, 2.0),
        (NOW - timedelta(days=1), "volume", "n", "t", "pass", "new", 1.0, 2.0),
        (NOW - timedelta(days=50), "volume", "n", "u", "pass", "stale", 1.0, 2.0),
    ]
    log = literal_rows(spark, rows, "checked_at timestamp, check_type string, check_name string, target string, severity string, message string, observed_value double, threshold double")
    got = {r["target"]: r for r in M.mart_data_health(log, NOW).collect()}
    assert (got["t"]["last_message"], got["t"]["runs_30d"], got["t"]["pass_rate_30d"]) == ("new", 2, 0.5)
    assert got["u"]["runs_30d"] is None and got["u"]["pass_rate_30d"] is None


def test_types_of_columns_with_quotes_in_their_names(spark):
    df = spark.createDataFrame([("1", "x", 2)], ["it's", "a`b", "back\\slash"])
    found = {r["column_name"]: r["logical_type"] for r in M.infer_logical_types(df).collect()}
    assert found == {"it's": "integer", "a`b": "string", "back\\slash": "integer"}
