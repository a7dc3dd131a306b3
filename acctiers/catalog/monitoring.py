"""Queries for freshness, volume, drift, alerts and data health (sections D7, E7, F2, G, L, S7)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers import settings as S
from acctiers.catalog.registry import query
from acctiers.catalog.sql import PARTS
from acctiers.functions.exprs import FLOAT_TEXT, INTEGER_TEXT
from acctiers.operators import checks as C
from acctiers.operators import latest
from acctiers.operators import monitor as M
from acctiers.plans import published as P
from acctiers.sources import testtables as T

NOW = datetime(2024, 1, 31)
ORDERS_NOW = datetime(2001, 12, 31, 12)


# --- batches: one load per event type and day, seen as an audit log ------------------------------

PARTS["batches"] = """
select event_type as source, cast(ts as date) as day, count(*) as rows_loaded, max(ts) as finished_at,
       cast(sum(count(*)) over (partition by event_type order by cast(ts as date)) as bigint) as table_rows_after
from events group by event_type, cast(ts as date)"""


def batches(spark, sf) -> DataFrame:
    from pyspark.sql import Window

    daily = T.table(spark, sf, "events").groupBy(F.col("event_type").alias("source"), F.col("ts").cast("date").alias("day"))
    counted = daily.agg(F.count(F.lit(1)).alias("rows_loaded"), F.max("ts").alias("finished_at"))
    # one row per source and day
    upto = Window.partitionBy("source").orderBy("day")
    return counted.withColumn("table_rows_after", F.sum("rows_loaded").over(upto))


def audit(spark, sf) -> DataFrame:
    return batches(spark, sf).withColumn("status", F.lit("success"))


_WINDOW = "over (partition by source order by day rows between 14 preceding and 1 preceding)"
PARTS["scored_batches"] = f"""
select *, case when std > 0 then (current - mean) / std when current = mean then 0.0 else cast('inf' as double) end as z,
       case when mean > 0 then (current - mean) / mean when current = 0 then 0.0 else cast('inf' as double) end as pct
from (select source, day, rows_loaded as current, count(rows_loaded) {_WINDOW} as n, avg(rows_loaded) {_WINDOW} as mean,
             coalesce(stddev_samp(rows_loaded) {_WINDOW}, 0.0) as std from batches)"""
_SEVERITY = """case when current = 0 then 'error' when n < 3 then 'pass'
                    when abs(z) >= 4.0 and abs(pct) >= 0.9 then 'error' when abs(z) >= 2.5 and abs(pct) >= 0.5 then 'warn' else 'pass' end"""


@query(
    "L4_volume_history",
    f"""select source, day, current, n, mean, case when n >= 3 then z end as z, case when n >= 3 then pct end as pct, {_SEVERITY} as severity
        from scored_batches""",
    "mean z pct",
)
def _(spark, sf):
    scored = M.volume_history(batches(spark, sf).withColumn("current", F.col("rows_loaded")), order="day")
    ready = F.col("n") >= 3
    return scored.select(
        "source", "day", "current", "n", "mean", F.when(ready, F.col("z")).alias("z"), F.when(ready, F.col("pct")).alias("pct"), "severity"
    )


def _check_sql(metric: str, skip: int, name: str, current: str) -> str:
    """Newest value of each source against the 14 batches after the first ``skip``."""
    return f"""
select 'volume' as check_type, '{name}' as check_name, concat('raw.', source) as target, severity, cast(current as double) as observed_value,
       case when current = 0 or n < 3 then null when severity = 'error' then 4.0 else 2.5 end as threshold
from (select *, {_SEVERITY} as severity from (
  select *, case when std > 0 then (current - mean) / std when current = mean then 0.0 else cast('inf' as double) end as z,
         case when mean > 0 then (current - mean) / mean else cast('inf' as double) end as pct from (
    select b.source, max({current}) as current, count(b.{metric}) filter (where age > {skip} and age <= {skip} + 14) as n,
           avg(b.{metric}) filter (where age > {skip} and age <= {skip} + 14) as mean,
           stddev_samp(b.{metric}) filter (where age > {skip} and age <= {skip} + 14) as std
    from (select *, row_number() over (partition by source order by finished_at desc) as age from batches) b group by b.source)))"""


def _newest(spark, sf) -> DataFrame:
    return latest.latest_record(batches(spark, sf), "source", ["finished_at"])


@query(
    "L3_evaluate_volume",
    _check_sql("rows_loaded", 1, "row_count_anomaly", "b.rows_loaded * cast(b.age = 1 as integer)"),
    "observed_value threshold",
)
def _(spark, sf):
    """The newest batch of each source against the 14 before it."""
    stats = M.trailing_stats(M.load_history(audit(spark, sf)), S.VOLUME["window"], skip_last=True)
    current = _newest(spark, sf).select("source", F.col("rows_loaded").alias("current"))
    joined = current.join(stats, "source", "left").withColumn("target", F.concat(F.lit("raw."), F.col("source")))
    return M.volume_checks(M.evaluate_volume(joined)).drop("details", "message")


@query(
    "L5_check_batch_volume",
    _check_sql("rows_loaded", 0, "row_count_anomaly", "case when age = 1 then 40 end"),
    "observed_value threshold",
)
def _(spark, sf):
    """A next batch of only 40 rows, judged on batch size."""
    next_batch = _newest(spark, sf).select(
        "source", F.lit("incremental").alias("strategy"), F.lit(40).cast("bigint").alias("rows_loaded"), F.lit(0).cast("bigint").alias("table_rows")
    )
    return M.check_batch_volume(next_batch, audit(spark, sf)).drop("details", "message")


@query(
    "L6_check_table_volumes",
    _check_sql("table_rows_after", 1, "table_row_count", "case when age = 1 then b.table_rows_after end"),
    "observed_value threshold",
)
def _(spark, sf):
    sizes = T.table(spark, sf, "events").groupBy(F.col("event_type").alias("source")).agg(F.count(F.lit(1)).alias("current"))
    return M.check_table_volumes(sizes, audit(spark, sf)).drop("details", "message")


query(
    "G1_load_history",
    "select source, finished_at, rows_loaded as value from batches",
)(lambda s, d: M.load_history(audit(s, d)))


@query(
    "G2_trailing_batches",
    """select source, count(*) as n, avg(rows_loaded) as mean, stddev_samp(rows_loaded) as std, max(rows_loaded) filter (where age = 1) as last_value
       from (select *, row_number() over (partition by source order by finished_at desc) as age from batches) where age <= 14 group by source""",
    "mean std",
)
def _(spark, sf):
    return M.trailing_stats(M.load_history(audit(spark, sf)), 14)


query("S7_row_count_history", "select source, finished_at, rows_loaded, table_rows_after from batches")(
    lambda s, d: P.row_count_history(audit(s, d))
)

# --- freshness ---------------------------------------------------------------------------------------

_LIMITS = {"orders": (36.0, 72.0), "order_items": (36.0, 72.0), "customers": (168.0, 336.0)}


def _fresh_sql(target: str, name: str, relation: str, column: str, warn: float, error: float) -> str:
    age = f"(epoch_us(timestamp '{ORDERS_NOW}') - epoch_us(max({column}))) / 3.6e9"
    severity = f"case when {age} >= {error} then 'error' when {age} >= {warn} then 'warn' else 'pass' end"
    return f"""select 'freshness' as check_type, '{name}' as check_name, '{target}' as target, {severity} as severity,
                      {age} as observed_value, case when {age} >= {error} then {error} else {warn} end as threshold from {relation}"""


_LOADED = "cast(timestamp '2001-12-30 09:30:00' as timestamp)"
PARTS["freshness_checks"] = " union all ".join(
    [
        _fresh_sql(f"raw.{s}", "load_freshness", f"(select {_LOADED} as _loaded_at from raw_{s})", "_loaded_at", 26.0, 50.0)
        for s in ("customers", "products", "orders", "order_items")
    ]
    + [_fresh_sql(f"raw.{s}", "data_freshness", f"raw_{s}", "updated_at", w, e) for s, (w, e) in _LIMITS.items()]
)


def _loaded_tables(spark, sf) -> dict[str, DataFrame]:
    at = F.lit("2001-12-30 09:30:00").cast("timestamp")
    return {s: t.withColumn("_loaded_at", at) for s, t in T.raw_tables(spark, sf).items()}


@query(
    "L1_evaluate_freshness",
    f"select * from ({_fresh_sql('raw.order_items', 'data_freshness', 'raw_order_items', 'updated_at', 36.0, 72.0)})",
    "observed_value:2 threshold",
)
def _(spark, sf):
    limits = {"load": S.FRESHNESS["load"], "data": S.FRESHNESS["order_items"]}
    latest_rows = M.latest_times("raw.order_items", T.raw_order_items(spark, sf), "updated_at", limits)
    return M.evaluate_freshness(latest_rows, ORDERS_NOW).drop("message", "details")


query("L2_check_freshness", "select * from freshness_checks", "observed_value:2 threshold")(
    lambda s, d: M.check_freshness(s, _loaded_tables(s, d), ORDERS_NOW).drop("message", "details")
)
query(
    "J11_source_freshness",
    f"""select 'raw.orders' as target, max(updated_at) as latest, {_fresh_sql('raw.orders', '', 'raw_orders', 'updated_at', 36.0, 72.0).split(' as target,')[1].split(' as severity')[0]} as severity
        from raw_orders""",
)(
    lambda s, d: (
        lambda rows: M.evaluate_freshness(rows, ORDERS_NOW)
        .select("target", "severity")
        .join(rows.select("target", F.col("latest").cast("timestamp_ntz").alias("latest")), "target")
    )(
        M.latest_times(
            "raw.orders", T.raw_orders(s, d), "updated_at", {"load": S.FRESHNESS["load"], "data": S.FRESHNESS["orders"]}
        )
    )
)

# --- drift ----------------------------------------------------------------------------------------------


def drifted_orders(spark, sf) -> DataFrame:
    """Orders landed as text, with an extra column and a unit glued to the payment terms."""
    text = T.raw_orders(spark, sf)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    return text.withColumns(
        {
            "sales_rep_id": F.concat(F.lit("R"), F.col("customer_id")),
            "payment_terms_days": F.concat(F.col("payment_terms_days"), F.lit(" days")),
        }
    )


PARTS["orders_text"] = """
select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id, cast(order_date as varchar) as order_date, status,
       channel, cast(discount_pct as varchar) as discount_pct, concat(payment_terms_days, ' days') as payment_terms_days,
       cast(paid_date as varchar) as paid_date, cast(updated_at as varchar) as updated_at, concat('R', customer_id) as sales_rep_id
from raw_orders"""


def _infer_sql(relation: str, columns: list[str]) -> str:
    tests = [
        ("integer", INTEGER_TEXT),
        ("float", FLOAT_TEXT),
        ("boolean", r"^(?i)(true|false|t|f|yes|no)$"),
        ("date", r"^\d{4}-\d{2}-\d{2}$"),
        ("timestamp", r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([+-]\d{2}:?\d{2}|Z)?$"),
    ]
    one = []
    for c in columns:
        arms = " ".join(f"when bool_and(regexp_matches(trim({c}), '{p}')) then '{n}'" for n, p in tests)
        one.append(f"select '{c}' as column_name, case when count({c}) = 0 then 'unknown' {arms} else 'string' end as logical_type from {relation}")
    return " union all ".join(one)


_TEXT_COLUMNS = [*S.CONTRACTS["orders"], "sales_rep_id"]
PARTS["orders_types"] = _infer_sql("orders_text", _TEXT_COLUMNS)
query("L7_infer_logical_types", "select * from orders_types")(lambda s, d: M.infer_logical_types(drifted_orders(s, d)))

_DECLARED = {
    "order_id": "integer",
    "customer_id": "integer",
    "order_date": "date",
    "status": "string",
    "channel": "string",
    "discount_pct": "float",
    "payment_terms_days": "integer",
    "paid_date": "date",
    "updated_at": "timestamp",
}
query(
    "L8_table_logical_types",
    " union all ".join(
        f"select '{c}' as column_name, case typeof(any_value({c})) when 'BIGINT' then 'integer' when 'DOUBLE' then 'float' "
        f"when 'DATE' then 'date' when 'TIMESTAMP' then 'timestamp' else 'string' end as logical_type, count({c}) as present from raw_orders"
        for c in _DECLARED
    ),
)(lambda s, d: M.stored_column_types(T.raw_orders(s, d)))

_CONTRACT = " union all ".join(f"select '{c}' as column_name, '{k}' as expected" for c, (k, _) in S.CONTRACTS["orders"].items())
_FITS = " or ".join(
    f"(o.logical_type = '{o}' and c.expected in ({', '.join(repr(x) for x in ok)}))" for o, ok in S.LOADABLE_AS.items()
)
PARTS["orders_drift"] = f"""
select * from (
  select coalesce(o.column_name, c.column_name) as column_name,
         case when c.expected is null then 'added' when o.logical_type is null then 'removed' when not ({_FITS}) then 'type_change' end as change,
         c.expected, o.logical_type as observed
  from orders_types o full outer join ({_CONTRACT}) c on c.column_name = o.column_name) where change is not null"""
query("L9_compare_contract", "select * from orders_drift")(
    lambda s, d: M.compare(M.infer_logical_types(drifted_orders(s, d)), S.CONTRACTS["orders"])
)
_DRIFT = """
select 'schema_drift' as check_type, 'contract_match' as check_name, 'source.orders' as target,
       case when count(*) filter (where change <> 'added') > 0 then 'error' when count(*) > 0 then 'warn' else 'pass' end as severity,
       concat_ws('; ',
         case when count(*) filter (where change = 'added') > 0 then
           concat('added columns [''', string_agg(column_name, ''', ''' order by column_name) filter (where change = 'added'), ''']') end,
         case when count(*) filter (where change = 'type_change') > 0 then
           concat('type changes ', string_agg(concat(column_name, ': ', expected, '->', observed), ', ' order by column_name)
                  filter (where change = 'type_change')) end) as message,
       cast(count(*) as double) as observed_value, cast(0 as double) as threshold
from orders_drift"""
query("L10_drift_to_check", _DRIFT, "observed_value threshold")(
    lambda s, d: M.drift_to_check(
        M.compare(M.infer_logical_types(drifted_orders(s, d)), S.CONTRACTS["orders"]), "source.orders"
    ).drop("details")
)
query("L11_check_landed", _DRIFT, "observed_value threshold")(
    lambda s, d: M.check_landed("orders", drifted_orders(s, d)).drop("details")
)


def _landed(spark, sf) -> dict[str, DataFrame]:
    as_text = {
        s: t.select(*[F.col(c).cast("string").alias(c) for c in t.columns]) for s, t in T.raw_tables(spark, sf).items()
    }
    return {**as_text, "orders": drifted_orders(spark, sf)}


_CLEAN = " union all ".join(
    f"""select 'schema_drift' as check_type, 'contract_match' as check_name, 'source.{s}' as target, 'pass' as severity,
               'schema matches contract' as message, cast(0 as double) as observed_value, cast(0 as double) as threshold
        from raw_{s} having count(*) > 0"""
    for s in ("customers", "products", "order_items")
)
query("L17_contract_gate", f"{_CLEAN} union all {_DRIFT}", "observed_value threshold")(
    lambda s, d: M.contract_gate(_landed(s, d), raise_on_error=False).drop("details")
)

# --- results, alerts, health ----------------------------------------------------------------------------------


def check_log(spark, sf) -> DataFrame:
    """Events seen as a log of check results: one result per event."""
    value = F.col("value")
    severity = F.when(value > 200, "error").when(value > 120, "warn").otherwise("pass")
    return T.table(spark, sf, "events").select(
        F.col("ts").alias("checked_at"),
        F.lit("volume").alias("check_type"),
        F.col("event_type").alias("check_name"),
        F.concat(F.lit("raw.t"), (F.col("user_id") % 7).cast("string")).alias("target"),
        severity.alias("severity"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
        value.alias("observed_value"),
        F.lit(200.0).alias("threshold"),
    )


PARTS["check_log"] = """
select ts as checked_at, 'volume' as check_type, event_type as check_name, concat('raw.t', user_id % 7) as target,
       case when value > 200 then 'error' when value > 120 then 'warn' else 'pass' end as severity,
       concat('event ', event_id) as message, value as observed_value, cast(200 as double) as threshold
from events"""
PARTS["health_history"] = """
select check_type, check_name, target, count(*) as runs_30d, count(*) filter (where severity = 'pass') as passes_30d,
       count(*) filter (where severity = 'warn') as warnings_30d, count(*) filter (where severity = 'error') as errors_30d
from check_log where checked_at >= timestamp '2024-01-31 00:00:00' - interval 30 day group by 1, 2, 3"""
PARTS["newest_checks"] = """
select * from check_log qualify row_number() over (partition by check_type, check_name, target order by checked_at desc, severity desc, message desc) = 1"""
PARTS["mart_data_health"] = """
select r.check_type, r.check_name, r.target, r.checked_at as last_checked_at, r.severity as last_severity, r.message as last_message,
       r.observed_value, r.threshold, h.runs_30d, h.passes_30d, h.warnings_30d, h.errors_30d,
       case when h.runs_30d <> 0 then cast(h.passes_30d as double) / h.runs_30d end as pass_rate_30d
from newest_checks r left join health_history h
  on h.check_type = r.check_type and h.check_name = r.check_name and h.target = r.target"""
query("L16_mart_data_health", "select * from mart_data_health", "observed_value:4 threshold pass_rate_30d")(
    lambda s, d: M.mart_data_health(check_log(s, d), NOW)
)
query(
    "D7_health_join",
    "select check_type, check_name, target, last_severity, runs_30d, pass_rate_30d from mart_data_health",
    "pass_rate_30d",
)(
    lambda s, d: M.mart_data_health(check_log(s, d), NOW).select(
        "check_type", "check_name", "target", "last_severity", "runs_30d", "pass_rate_30d"
    )
)
query("E7_health_history", "select * from health_history")(
    lambda s, d: M.mart_data_health(check_log(s, d), NOW).select(
        "check_type", "check_name", "target", "runs_30d", "passes_30d", "warnings_30d", "errors_30d"
    )
)
query(
    "F2_newest_check",
    "select check_type, check_name, target, checked_at, severity, message from newest_checks",
)(
    lambda s, d: latest.latest_record(
        check_log(s, d), ["check_type", "check_name", "target"], ["checked_at", "severity", "message"]
    ).select("check_type", "check_name", "target", "checked_at", "severity", "message")
)

_RANK = "case severity when 'error' then 2 when 'warn' then 1 else 0 end"
query(
    "L12_worst_severity",
    "select target, case max(case severity when 'error' then 2 when 'warn' then 1 else 0 end) when 2 then 'error' when 1 then 'warn' else 'pass' end as severity from check_log group by target",
)(lambda s, d: C.worst_severity(check_log(s, d), "target"))

_ALERTS = """select check_type, check_name, target, severity, message,
       concat('[', upper(severity), '] ', check_type, ' | ', target, ': ', message) as text
       from check_log where severity in ('warn', 'error')"""
_ALERT_COLUMNS = ["check_type", "check_name", "target", "severity", "message", "text"]
query("L15_select_alerts", _ALERTS)(lambda s, d: M.select_alerts(check_log(s, d)).select(*_ALERT_COLUMNS))
query("G3_alerts_by_severity", f"select *, cast({_RANK} as bigint) as severity_rank from ({_ALERTS}) where severity = 'error'")(
    lambda s, d: M.select_alerts(check_log(s, d), "error").select(
        *_ALERT_COLUMNS, C.severity_rank(F.col("severity")).alias("severity_rank")
    )
)
query(
    "L15_alert_headline",
    f"""select count(*) as alerts, 'ERROR' as worst, concat('[ERROR] ', count(*), ' check(s) need attention') as headline
        from ({_ALERTS}) having bool_or(severity = 'error')""",
)(lambda s, d: M.alert_headline(M.select_alerts(check_log(s, d))))

_TARGETS = [f"raw.t{i}" for i in range(7)]
query(
    "S7_status_grid",
    "select check_type, check_name, "
    + ", ".join(f"max(last_severity) filter (where target = '{t}') as \"{t}\"" for t in _TARGETS)
    + " from mart_data_health group by check_type, check_name",
)(
    lambda s, d: P.status_grid(
        M.mart_data_health(check_log(s, d), NOW), _TARGETS
    )
)


@query(
    "L14_run_all_checks",
    "select check_type, check_name, target, severity, observed_value from freshness_checks union all "
    + " union all ".join(
        f"select 'volume', 'table_row_count', 'raw.{s}', 'pass', cast(count(*) as double) from raw_{s} "
        f"union all select 'schema_drift', 'contract_match', 'raw.{s}', 'pass', 0.0 from raw_{s} having count(*) > 0"
        for s in S.SOURCES
    ),
    "observed_value:2",
)
def _(spark, sf):
    from acctiers.sources.loader import empty_audit

    checks = M.run_all_checks(spark, _loaded_tables(spark, sf), empty_audit(spark), ORDERS_NOW)
    return checks.select("check_type", "check_name", "target", "severity", "observed_value")


def stored_checks(spark, checks: DataFrame, at: datetime) -> DataFrame:
    """Append the results to a stored log and read them back."""
    from acctiers.session import scratch_path
    from acctiers.sources.loader import CHECKS, persist_checks
    from acctiers.sources.store import Store

    store = Store(spark, scratch_path(spark, "store"))
    persist_checks(store, checks, "run-1", at)
    return store.read(CHECKS, ["check_type", "check_name", "target", "severity", "observed_value"])


query(
    "L13_persisted_results",
    "select check_type, check_name, target, severity, observed_value from freshness_checks",
    "observed_value:2",
)(
    lambda s, d: stored_checks(
        s, M.check_freshness(s, _loaded_tables(s, d), ORDERS_NOW), ORDERS_NOW
    )
)
