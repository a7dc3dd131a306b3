"""Freshness, volume and schema-drift monitors, alert selection and the data-health mart."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctiers import settings as S
from acctiers.functions import exprs as X
from acctiers.operators.checks import CHECK_COLUMNS, check_rows, severity_rank
from acctiers.session import literal_rows

# --- freshness -------------------------------------------------------------------------------


def _plain(number: Column) -> Column:
    return F.regexp_replace(number.cast("string"), r"\.0$", "")


def age_hours(latest: Column, now: datetime) -> Column:
    """Hours since ``latest``; a naive timestamp counts as UTC (the session time zone)."""
    return (F.unix_micros(F.lit(X.utc(now)).cast("timestamp")) - F.unix_micros(latest.cast("timestamp"))) / F.lit(3.6e9)


def evaluate_freshness(latest: DataFrame, now: datetime) -> DataFrame:
    """Rows of (target, check_name, latest, warn, error) judged against ``now``."""
    aged = latest.withColumn("_age", age_hours(F.col("latest"), now))
    age, warn, error = F.col("_age"), F.col("warn"), F.col("error")
    severity = (
        F.when(age.isNull(), "error").when(age >= error, "error").when(age >= warn, "warn").otherwise("pass")
    )
    text = F.format_string("latest record %.1fh old (warn %sh / error %sh)", age, _plain(warn), _plain(error))
    return check_rows(
        aged,
        check_type=F.lit("freshness"),
        check_name=F.col("check_name"),
        target=F.col("target"),
        severity=severity,
        message=F.when(age.isNull(), "no records found").otherwise(text),
        observed_value=F.round(age, 2),
        threshold=F.when(severity == "error", error).otherwise(warn),
        details=F.when(age.isNull(), "{}").otherwise(X.as_json(latest=F.col("latest"))),
    )


def latest_times(target: str, table: DataFrame, data_column: str | None, limits: Mapping) -> DataFrame:
    """Load and data freshness inputs of one table from a single max aggregate."""
    wanted = [("load_freshness", "_loaded_at", limits["load"])]
    if data_column:
        wanted.append(("data_freshness", data_column, limits["data"]))
    wanted = [w for w in wanted if w[1] in table.columns]
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.max(column).cast("timestamp").alias("latest"),
            F.lit(float(lim["warn"])).alias("warn"),
            F.lit(float(lim["error"])).alias("error"),
        )
        for name, column, lim in wanted
    ]
    return table.agg(F.array(*rows).alias("r")).select(F.lit(target).alias("target"), F.inline("r"))


def missing_tables(spark: SparkSession, targets: list[str]) -> DataFrame:
    rows = literal_rows(spark, [(t,) for t in targets], "target string")
    return check_rows(
        rows,
        check_type=F.lit("freshness"),
        check_name=F.lit("load_freshness"),
        target=F.col("target"),
        severity=F.lit("error"),
        message=F.lit("table does not exist"),
    )


def check_freshness(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    now: datetime,
    limits: Mapping | None = None,
    schema: str = "raw",
) -> DataFrame:
    """Load freshness of every source and data freshness where configured; an absent table is an error."""
    limits = limits or S.FRESHNESS
    present = []
    for source, table in tables.items():
        if table is not None:
            data = limits.get(source)
            per_table = {"load": limits["load"], "data": data}
            present.append(latest_times(f"{schema}.{source}", table, data and data["column"], per_table))
    parts = []
    if present:
        parts.append(evaluate_freshness(reduce(DataFrame.unionByName, present), now))
    absent = [f"{schema}.{s}" for s, t in tables.items() if t is None]
    if absent:
        parts.append(missing_tables(spark, absent))
    return reduce(DataFrame.unionByName, parts)


# --- volume ------------------------------------------------------------------------------------


def evaluate_volume(df: DataFrame, cfg: Mapping | None = None, allow_zero: bool = False) -> DataFrame:
    """Rows of (target, current, n, mean, std) scored: both z-score and relative change must breach.

    Adds z, pct, severity, message, threshold.  A flat history (std 0) or an empty one (mean 0)
    makes any difference infinite.
    """
    cfg = cfg or S.VOLUME
    current = F.col("current").cast("double")
    mean, std = F.col("mean"), F.coalesce("std", F.lit(0.0))
    infinite = F.lit(float("inf"))
    z = F.when(std > 0, (current - mean) / std).otherwise(F.when(current == mean, 0.0).otherwise(infinite))
    pct = F.when(mean > 0, (current - mean) / mean).otherwise(F.when(current == 0, 0.0).otherwise(infinite))
    scored = df.withColumns({"z": z, "pct": pct})
    breach = lambda level: (F.abs("z") >= cfg[f"z_{level}"]) & (F.abs("pct") >= cfg[f"pct_{level}"])
    zero = (current == 0) & F.lit(not allow_zero)
    short = F.col("n") < cfg["min_history"]
    judged = F.when(breach("error"), "error").when(breach("warn"), "warn").otherwise("pass")
    severity = F.when(zero, cfg["zero_rows"]).when(short, "pass").otherwise(judged)
    thin = F.format_string(
        f"%d rows; insufficient history (%d/{cfg['min_history']}) for anomaly test", F.col("current"), F.col("n")
    )
    text = F.format_string(
        "%d rows vs trailing mean %.0f (z=%.2f, change=%+.0f%%)", F.col("current"), mean, F.col("z"), F.col("pct") * 100
    )
    return scored.withColumns(
        {
            "severity": severity,
            "message": F.when(zero, "batch contained zero rows").when(short, thin).otherwise(text),
            "threshold": F.when(~zero & ~short, F.when(severity == "error", cfg["z_error"]).otherwise(cfg["z_warn"])),
        }
    )


def volume_checks(scored: DataFrame, check_name: str = "row_count_anomaly") -> DataFrame:
    return check_rows(
        scored,
        check_type=F.lit("volume"),
        check_name=F.lit(check_name),
        target=F.col("target"),
        severity=F.col("severity"),
        message=F.col("message"),
        observed_value=F.col("current"),
        threshold=F.col("threshold"),
        details=X.as_json(
            current=F.col("current"),
            mean=F.round("mean", 2),
            std=F.round("std", 2),
            z_score=F.round("z", 3),
            pct_change=F.round("pct", 3),
        ),
    )


def load_history(audit: DataFrame, metric: str = "rows_loaded") -> DataFrame:
    """Successful loads per source in time order (one row per batch)."""
    done = audit.filter("status = 'success'")
    return done.select("source", "finished_at", F.col(metric).alias("value")).orderBy("source", "finished_at")


def trailing_stats(history: DataFrame, window: int, skip_last: bool = False) -> DataFrame:
    """Count, mean and sample deviation of each source's last ``window`` values, plus the very last."""
    order = Window.partitionBy("source").orderBy(F.col("finished_at").desc())
    skip = 1 if skip_last else 0
    # the rank limit reaches below the shuffle, so only the newest batches of a source move
    recent = history.withColumn("_age", F.row_number().over(order)).filter(F.col("_age") <= window + skip)
    used = F.when(F.col("_age") > skip, F.col("value"))
    return recent.groupBy("source").agg(
        F.count(used).alias("n"),
        F.avg(used).alias("mean"),
        F.stddev_samp(used).alias("std"),
        F.max(F.when(F.col("_age") == 1, F.col("value"))).alias("last_value"),
    )


def check_batch_volume(batches: DataFrame, audit: DataFrame, cfg: Mapping | None = None, schema: str = "raw") -> DataFrame:
    """Just-loaded batches (source, strategy, rows_loaded, table_rows) against earlier loads.

    Incremental sources are judged on batch size, full refreshes on table size.
    """
    cfg = cfg or S.VOLUME
    by_rows = trailing_stats(load_history(audit, "rows_loaded"), cfg["window"]).withColumn("_kind", F.lit(True))
    by_table = trailing_stats(load_history(audit, "table_rows_after"), cfg["window"]).withColumn("_kind", F.lit(False))
    incremental = F.col("strategy") == "incremental"
    wanted = batches.select(
        "source",
        F.concat(F.lit(f"{schema}."), F.col("source")).alias("target"),
        incremental.alias("_kind"),
        F.when(incremental, F.col("rows_loaded")).otherwise(F.col("table_rows")).alias("current"),
    )
    joined = wanted.join(by_rows.unionByName(by_table), ["source", "_kind"], "left").fillna({"n": 0})
    return volume_checks(evaluate_volume(joined, cfg))


def volume_history(batches: DataFrame, cfg: Mapping | None = None, order: str = "finished_at") -> DataFrame:
    """Score every batch of (source, current, ``order``) against its own trailing window."""
    cfg = cfg or S.VOLUME
    before = Window.partitionBy("source").orderBy(order).rowsBetween(-cfg["window"], -1)
    current = F.col("current").cast("double")
    stats = batches.withColumns(
        {
            "n": F.count("current").over(before),
            "mean": F.avg(current).over(before),
            "std": F.stddev_samp(current).over(before),
            "target": F.col("source"),
        }
    )
    return evaluate_volume(stats, cfg)


def check_table_volumes(
    sizes: DataFrame, audit: DataFrame, cfg: Mapping | None = None, schema: str = "raw"
) -> DataFrame:
    """Current table sizes (source, current) against the sizes after earlier loads but the last.

    A table smaller than after its last load is an error, even when a dimension was replaced on purpose.
    """
    cfg = cfg or S.VOLUME
    stats = trailing_stats(load_history(audit, "table_rows_after"), cfg["window"], skip_last=True)
    target = F.concat(F.lit(f"{schema}."), F.col("source"))
    joined = sizes.join(stats, "source", "left").fillna({"n": 0}).withColumn("target", target)
    scored = evaluate_volume(joined, cfg)
    shrank = F.col("current") < F.col("last_value")
    text = F.format_string("table shrank from %d to %d rows since last load", F.col("last_value"), F.col("current"))
    scored = scored.withColumns(
        {
            "severity": F.when(shrank, "error").otherwise(F.col("severity")),
            "message": F.when(shrank, text).otherwise(F.col("message")),
        }
    )
    return volume_checks(scored, "table_row_count")


# --- schema drift --------------------------------------------------------------------------------

_TEXT_KINDS = (("integer", 1), ("float", 2), ("boolean", 4), ("date", 8), ("timestamp", 16))


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _type_mask(name: str) -> str:
    """Aggregate whose bits are the logical types all text values of a column could be; null without values.

    The branches go from common to rare and stop at the first match; an integer is also a float.
    """
    name = _ident(name)
    v = f"regexp_replace({name}, r'^\\s+|\\s+$', '')"
    arms = ((X.INTEGER_TEXT, 3), (X.FLOAT_TEXT, 2), (X.DATE_TEXT, 8), (X.TIMESTAMP_TEXT, 16), (X.BOOLEAN_TEXT, 4))
    tests = " ".join(f"when {v} rlike r'{pattern}' then {bits}" for pattern, bits in arms)
    return f"bit_and(case when {name} is null or {v} = '' then null {tests} else 0 end)"


def _inferred(field: T.StructField) -> str:
    """SQL aggregate giving the logical type of a column from its values."""
    name, kind = _ident(field.name), field.dataType
    if isinstance(kind, T.StringType):
        mask = _type_mask(field.name)
        arms = " ".join(f"when ({mask}) & {bit} <> 0 then '{label}'" for label, bit in _TEXT_KINDS)
        return f"case when ({mask}) is null then 'unknown' {arms} else 'string' end"
    absent = f"count({name}) = 0"
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = f"bool_and(double({name}) = round(double({name})))"
        return f"case when {absent} then 'unknown' when {whole} then 'integer' else 'float' end"
    fixed = {T.BooleanType: "boolean", T.DateType: "date", T.TimestampType: "timestamp", T.TimestampNTZType: "timestamp"}
    label = fixed.get(type(kind), "integer" if isinstance(kind, T.IntegralType) else "string")
    return f"case when {absent} then 'unknown' else '{label}' end"


def infer_logical_types(df: DataFrame) -> DataFrame:
    """(column_name, logical_type) from every value of the table, in one aggregate."""
    rows = [f"named_struct('column_name', {_literal(f.name)}, 'logical_type', {_inferred(f)})" for f in df.schema.fields]
    return df.agg(F.expr(f"array({', '.join(rows)})").alias("r")).select(F.inline("r"))


def declared_logical_type(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.IntegralType):
        return "integer"
    if isinstance(kind, T.DecimalType):
        return "integer" if kind.scale == 0 else "float"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return "float"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return "date" if isinstance(kind, T.DateType) else "string"


def table_logical_types(df: DataFrame) -> DataFrame:
    """(column_name, logical_type) from the declared schema of a stored table."""
    rows = [(f.name, declared_logical_type(f.dataType)) for f in df.schema.fields]
    return literal_rows(df.sparkSession, rows, "column_name string, logical_type string")


def stored_column_types(df: DataFrame) -> DataFrame:
    """``table_logical_types`` with how many values of each column the table holds, in one pass."""
    counts = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(declared_logical_type(f.dataType)).alias("logical_type"),
            F.count(F.col(f"`{f.name}`")).alias("present"),
        )
        for f in df.schema.fields
    ]
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def contract_types(spark: SparkSession, contract: Mapping[str, tuple[str, bool]]) -> DataFrame:
    rows = [(name, kind) for name, (kind, _) in contract.items()]
    return literal_rows(spark, rows, "column_name string, expected string")


def compare(observed: DataFrame, contract: Mapping[str, tuple[str, bool]]) -> DataFrame:
    """Differences as (column_name, change, expected, observed).  Names starting with _ are ours."""
    seen = observed.filter(~F.col("column_name").startswith("_")).select(
        F.lower("column_name").alias("column_name"), F.col("logical_type").alias("observed")
    )
    wanted = contract_types(observed.sparkSession, {k.lower(): v for k, v in contract.items()})
    fits = reduce(
        lambda a, b: a | b,
        [(F.col("observed") == o) & F.col("expected").isin(list(ok)) for o, ok in S.LOADABLE_AS.items()],
    )
    change = (
        F.when(F.col("expected").isNull(), "added").when(F.col("observed").isNull(), "removed").when(~fits, "type_change")
    )
    joined = seen.join(wanted, "column_name", "full_outer").withColumn("change", change)
    return joined.filter("change is not null").select("column_name", "change", "expected", "observed")


def _quoted(names: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def drift_to_check(differences: DataFrame, target: str, policy: Mapping[str, str] | None = None) -> DataFrame:
    """One check row: worst severity over the kinds of change seen (one input row per column)."""
    policy = policy or S.DRIFT_POLICY
    of = lambda kind, value: F.sort_array(F.collect_list(F.when(F.col("change") == kind, value)))
    name = F.col("column_name")
    arrow = F.concat(name, F.lit(": "), F.col("expected"), F.lit("->"), F.col("observed"))
    pair = F.struct(name, F.array("expected", "observed").alias("types"))
    one = differences.agg(
        of("added", name).alias("added"),
        of("removed", name).alias("removed"),
        of("type_change", arrow).alias("moves"),
        of("type_change", pair).alias("pairs"),
        F.count(F.lit(1)).alias("n"),
    )
    added, removed, moves = F.col("added"), F.col("removed"), F.col("moves")
    levels = F.array_compact(
        F.array(
            F.when(F.size(added) > 0, policy["added"]),
            F.when(F.size(removed) > 0, policy["removed"]),
            F.when(F.size(moves) > 0, policy["type_change"]),
        )
    )
    ranked = F.array_max(F.transform(levels, lambda s: F.struct(severity_rank(s).alias("r"), s.alias("s"))))
    parts = F.array_compact(
        F.array(
            F.when(F.size(added) > 0, F.concat(F.lit("added columns "), _quoted(added))),
            F.when(F.size(removed) > 0, F.concat(F.lit("removed columns "), _quoted(removed))),
            F.when(F.size(moves) > 0, F.concat(F.lit("type changes "), F.array_join(moves, ", "))),
        )
    )
    return check_rows(
        one,
        check_type=F.lit("schema_drift"),
        check_name=F.lit("contract_match"),
        target=F.lit(target),
        severity=F.coalesce(ranked["s"], F.lit("pass")),
        message=F.when(F.size(parts) == 0, "schema matches contract").otherwise(F.array_join(parts, "; ")),
        observed_value=F.col("n"),
        threshold=F.lit(0.0),
        details=X.as_json(added=added, removed=removed, type_changes=F.map_from_entries("pairs")),
    )


def check_landed(source: str, landed: DataFrame, contract: Mapping | None = None, policy: Mapping | None = None) -> DataFrame:
    contract = contract or S.CONTRACTS[source]
    return drift_to_check(compare(infer_logical_types(landed), contract), f"source.{source}", policy)


def check_table(
    spark: SparkSession, source: str, table: DataFrame | None, contract: Mapping | None = None, schema: str = "raw"
) -> DataFrame:
    """Declared schema of a stored table; an absent table has lost every column."""
    contract = contract or S.CONTRACTS[source]
    if table is None:
        observed = spark.createDataFrame([], "column_name string, logical_type string")
    else:
        observed = table_logical_types(table)
    return drift_to_check(compare(observed, contract), f"{schema}.{source}")


class SchemaDriftError(RuntimeError):
    pass


def contract_gate(landed: Mapping[str, DataFrame], raise_on_error: bool = True) -> DataFrame:
    """Drift of every landed file before any is loaded; fails naming all bad targets."""
    checks = reduce(DataFrame.unionByName, [check_landed(s, df) for s, df in landed.items()])
    if raise_on_error:
        raise_for_drift(checks)
    return checks


def raise_for_drift(checks: DataFrame) -> None:
    bad = checks.filter("severity = 'error'").select("target", "message").collect()  # one row per source
    if bad:
        raise SchemaDriftError("; ".join(f"{r['target']}: {r['message']}" for r in bad))


# --- all together ----------------------------------------------------------------------------------


def table_sizes(tables: Mapping[str, DataFrame | None]) -> DataFrame:
    counts = [
        t.agg(F.count(F.lit(1)).alias("current")).select(F.lit(s).alias("source"), "current")
        for s, t in tables.items()
        if t is not None
    ]
    return reduce(DataFrame.unionByName, counts)


def run_all_checks(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], audit: DataFrame, now: datetime
) -> DataFrame:
    parts = [check_freshness(spark, tables, now)]
    if any(t is not None for t in tables.values()):
        parts.append(check_table_volumes(table_sizes(tables), audit))
    parts += [check_table(spark, source, table) for source, table in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def select_alerts(checks: DataFrame, min_severity: str = S.ALERT_MIN_SEVERITY) -> DataFrame:
    """Results at or above the threshold and not passing, worst first, with the text to send."""
    rank = severity_rank(F.col("severity"))
    chosen = checks.filter((rank >= S.SEVERITY_RANK[min_severity]) & (F.col("severity") != "pass"))
    text = F.format_string(
        "[%s] %s | %s: %s", F.upper("severity"), F.col("check_type"), F.col("target"), F.col("message")
    )
    return chosen.withColumn("text", text).orderBy(rank.desc(), "check_type", "target", "check_name")


def alert_headline(alerts: DataFrame) -> DataFrame:
    worst = F.when(F.bool_or(F.col("severity") == "error"), "ERROR").otherwise("WARN")
    n = F.count(F.lit(1))
    return alerts.agg(n.alias("alerts"), worst.alias("worst")).filter("alerts > 0").select(
        "alerts", "worst", F.format_string("[%s] %d check(s) need attention", "worst", "alerts").alias("headline")
    )


def mart_data_health(check_results: DataFrame, now: datetime) -> DataFrame:
    """Newest result per check with its 30-day pass rate.

    Both halves are aggregates on the check key with a map-side step; ``max_by`` keeps the newest row.
    """
    key = ["check_type", "check_name", "target"]
    since = F.col("checked_at") >= F.lit(X.utc(now) - timedelta(days=30))
    kind = lambda s: F.count_if(since & (F.col("severity") == s))
    newest = F.max_by(
        F.struct("checked_at", "severity", "message", "observed_value", "threshold"),
        F.struct("checked_at", "severity", "message"),
    )
    grouped = check_results.groupBy(*key).agg(
        newest.alias("_last"),
        F.count_if(since).alias("runs"),
        kind("pass").alias("passes"),
        kind("warn").alias("warnings"),
        kind("error").alias("errors"),
    )
    seen = F.col("runs") > 0
    return grouped.select(
        *key,
        F.col("_last.checked_at").alias("last_checked_at"),
        F.col("_last.severity").alias("last_severity"),
        F.col("_last.message").alias("last_message"),
        F.col("_last.observed_value").alias("observed_value"),
        F.col("_last.threshold").alias("threshold"),
        F.when(seen, F.col("runs")).alias("runs_30d"),
        F.when(seen, F.col("passes")).alias("passes_30d"),
        F.when(seen, F.col("warnings")).alias("warnings_30d"),
        F.when(seen, F.col("errors")).alias("errors_30d"),
        X.safe_divide(F.col("passes"), F.col("runs")).alias("pass_rate_30d"),
    )
