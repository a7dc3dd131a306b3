"""Queries for sources, sinks, loads, history and streaming (sections A, I, U).

Each one lands the given tables in the shared folder first, then runs the operator on what landed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers.catalog.registry import query
from acctiers.catalog.sql import PARTS, RUN_DATES
from acctiers.operators import history as H
from acctiers.plans.warehouse import Warehouse
from acctiers.session import scratch_path
from acctiers.sources import export, landing, loader
from acctiers.sources import testtables as T
from acctiers.sources.intervals import IntervalStore
from acctiers.sources.store import Store, after_watermark, with_audit
from acctiers.streaming import ingest as U
from acctiers.streaming.landing import ingest_files, stream_files

LOADED_AT = datetime(2001, 8, 2, 6)
MIDDLE = datetime(2000, 1, 1)


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def land(spark, df: DataFrame, source: str) -> str:
    """Write a table as a landed CSV folder with untidy headers."""
    path = scratch_path(spark, f"landing-{source}")
    named = _as_text(df).toDF(*[f" {c.upper()} " for c in df.columns])
    named.write.option("header", True).option("escape", '"').csv(path)
    return path


def _store(spark) -> Store:
    return Store(spark, scratch_path(spark, "store"))


PARTS["orders_as_text"] = """
select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id, cast(order_date as varchar) as order_date, status,
       channel, cast(discount_pct as double) as discount_pct, cast(payment_terms_days as varchar) as payment_terms_days,
       cast(paid_date as varchar) as paid_date, strftime(updated_at, '%Y-%m-%d %H:%M:%S') as updated_at from raw_orders"""


@query("A1_extract_csv", "select * from orders_as_text", "discount_pct")
def _(spark, sf):
    path = land(spark, T.raw_orders(spark, sf), "orders")
    return landing.extract_csv(spark, path)


@query(
    "A2_file_checksums",
    """select strftime(order_date, '%Y-%m') as month, sum(length(order_id || ',' || status) + 1)::bigint as length,
              md5(string_agg(order_id || ',' || status, chr(10) order by order_id) || chr(10)) as checksum
       from raw_orders group by 1""",
)
def _(spark, sf):
    """MD5 and length of one landed file per month, lines in the order of their ids, read in small byte ranges."""
    path = scratch_path(spark, "landing-months")
    month = F.date_format("order_date", "yyyy-MM").alias("month")
    orders = T.raw_orders(spark, sf).select(month, "order_id", F.concat_ws(",", F.col("order_id").cast("string"), "status").alias("line"))
    sorted_lines = orders.repartition("month").sortWithinPartitions("month", "order_id").select("month", "line")
    sorted_lines.write.partitionBy("month").text(path)
    found = landing.file_checksums(spark, path)
    return found.select(F.regexp_extract("path", r"month=([^/]+)", 1).alias("month"), "length", "checksum")


@query("A2_content_digest", "select count(*) as rows from lineitem")
def _(spark, sf):
    """The digest of a table equals that of the same rows in another order."""
    lines = T.table(spark, sf, "lineitem")
    digest = landing.content_digest(lines)
    shuffled = landing.content_digest(lines.repartition("l_partkey"))
    return digest.join(shuffled, ["rows", "digest", "row_hash_sum"]).select("rows")


_CONFORMED = """select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id, order_date, status, channel,
                       discount_pct, payment_terms_days, paid_date, updated_at from raw_orders"""


@query("A3_conform", _CONFORMED, "discount_pct")
def _(spark, sf):
    landed = landing.extract_csv(spark, land(spark, T.raw_orders(spark, sf), "orders"))
    return landing.conform("orders", landed.withColumn("not_contracted", F.lit("x")))[0]


@query("A4_current_watermark", "select max(updated_at) as watermark from raw_orders")
def _(spark, sf):
    store = _store(spark)
    store.write(T.raw_orders(spark, sf), "raw/orders")
    newest = store.max_value("raw/orders", "updated_at")
    return store.read("raw/orders", ["updated_at"]).filter(F.col("updated_at") == F.lit(newest)).select(
        F.col("updated_at").alias("watermark")
    ).distinct()


@query(
    "A5_incremental_filter",
    f"select order_item_id, updated_at from raw_order_items where updated_at > timestamp '{MIDDLE}'",
)
def _(spark, sf):
    return after_watermark(T.raw_order_items(spark, sf), "updated_at", MIDDLE).select("order_item_id", "updated_at")


@query(
    "A6_with_audit",
    "select order_id, 'b1' as _batch_id, 'orders.parquet' as _source_file from raw_orders",
)
def _(spark, sf):
    return with_audit(T.raw_orders(spark, sf), "b1", LOADED_AT).select("order_id", "_batch_id", "_source_file")


@query("A7_write_table", "select 'replace' as mode, count(*) as rows, count(*) as stored from lineitem union all select 'append', count(*), 2 * count(*) from lineitem")
def _(spark, sf):
    """Row counts reported by the write itself, and the table size after it."""
    store, lines = _store(spark), T.table(spark, sf, "lineitem")
    seen = []
    for mode in ("replace", "append"):
        rows = store.write(lines, "lines", mode)
        seen.append((mode, rows, store.read("lines").count()))
    return spark.createDataFrame(seen, "mode string, rows bigint, stored bigint")


@query(
    "A8_add_missing_columns",
    """select order_id, status, null as rep from raw_orders where order_id % 2 = 0
       union all select order_id, status, concat('R', customer_id) from raw_orders where order_id % 2 = 1""",
)
def _(spark, sf):
    store, orders = _store(spark), T.raw_orders(spark, sf)
    store.append_evolving(orders.filter("order_id % 2 = 0").select("order_id", "status"), "t")
    rep = F.concat(F.lit("R"), F.col("customer_id").cast("string")).alias("rep")
    store.append_evolving(orders.filter("order_id % 2 = 1").select("order_id", "status", rep), "t")
    return store.read("t", ["order_id", "status", "rep"])


def _loaded_twice(spark, sf) -> Store:
    """Orders landed up to a date and loaded, then the whole file loaded on top."""
    store = _store(spark)
    orders = T.raw_orders(spark, sf)
    first = land(spark, orders.filter(F.col("updated_at") <= F.lit(MIDDLE)), "orders")
    second = land(spark, orders, "orders")
    for batch, path in (("b1", first), ("b2", second)):
        loader.load_source(store, "orders", path, batch_id=batch, run_id="r", started=LOADED_AT)
    return store


@query(
    "A9_load_source",
    f"""select cast(order_id as varchar) as order_id, status, paid_date, updated_at,
               case when updated_at <= timestamp '{MIDDLE}' then 'b1' else 'b2' end as _batch_id from raw_orders""",
)
def _(spark, sf):
    return _loaded_twice(spark, sf).read("raw/orders", ["order_id", "status", "paid_date", "updated_at", "_batch_id"])


@query(
    "A10_load_all",
    " union all ".join(
        f"select '{s}' as source, count(*) as rows_extracted, count(*) as rows_loaded, count(*) as table_rows_after from raw_{s}"
        for s in ("customers", "products", "orders", "order_items")
    ),
)
def _(spark, sf):
    store, raw = _store(spark), T.raw_tables(spark, sf)
    # typed columns that read back as their contract type: whole employee counts, plain decimals
    paths = {s: land(spark, t, s) for s, t in raw.items()}
    loader.load_all(store, paths, run_id="r")
    return store.read(loader.AUDIT, ["source", "rows_extracted", "rows_loaded", "table_rows_after"])


@query(
    "A11_load_audit",
    f"""select 'b1' as batch_id, 'incremental' as load_strategy, count(*) as rows_extracted, count(*) as rows_loaded,
               count(*) as table_rows_after, null as watermark_before, strftime(max(updated_at), '%Y-%m-%d %H:%M:%S') as watermark_after, 'success' as status
        from raw_orders where updated_at <= timestamp '{MIDDLE}'
        union all
        select 'b2', 'incremental', count(*), count(*) filter (where updated_at > timestamp '{MIDDLE}'), count(*),
               strftime(max(updated_at) filter (where updated_at <= timestamp '{MIDDLE}'), '%Y-%m-%d %H:%M:%S'),
               strftime(max(updated_at), '%Y-%m-%d %H:%M:%S'), 'success' from raw_orders""",
)
def _(spark, sf):
    return _loaded_twice(spark, sf).read(
        loader.AUDIT,
        [
            "batch_id",
            "load_strategy",
            "rows_extracted",
            "rows_loaded",
            "table_rows_after",
            "watermark_before",
            "watermark_after",
            "status",
        ],
    )


@query("A12_pruned_read", "select order_id, customer_id, status from raw_orders")
def _(spark, sf):
    store = _store(spark)
    store.write(T.raw_orders(spark, sf), "raw/orders")
    return store.read("raw/orders", ["order_id", "customer_id", "status"])


@query(
    "A13_replace_partition",
    """select customer_id, cast(date_trunc('month', order_date) as date) as as_of_date, count(*) as orders,
              case when date_trunc('month', order_date) = date '2001-05-01' then cast(2 as bigint) else 1 end as version
       from raw_orders group by all""",
)
def _(spark, sf):
    """Months written once, then one month written again: only that partition is replaced."""
    store = _store(spark)
    month = F.trunc("order_date", "MM").alias("as_of_date")
    counts = T.raw_orders(spark, sf).groupBy("customer_id", month).agg(F.count(F.lit(1)).alias("orders"))
    store.replace_partition(counts.withColumn("version", F.lit(1)), "history", "as_of_date")
    again = counts.filter(F.col("as_of_date") == F.lit("2001-05-01").cast("date")).withColumn("version", F.lit(2))
    store.replace_partition(again, "history", "as_of_date")
    return store.read("history")


@query("A15_export_datasets", "select cast(order_id as varchar) as order_id, status, cast(line_count as varchar) as line_count from fct_orders")
def _(spark, sf):
    store, out = _store(spark), scratch_path(spark, "export")
    store.write(Warehouse.from_test_tables(spark, sf).fct_orders, "marts/fct_orders")
    written = export.export_datasets(store, out)
    return landing.extract_csv(spark, written["orders"]).select("order_id", "status", "line_count")


# --- I: history ---------------------------------------------------------------------------------

LATER = datetime(2001, 8, 15)


@query(
    "I1_scd2_apply",
    f"""select customer_id, region, updated_at, updated_at as valid_from,
               case when customer_id % 10 = 0 then timestamp '{LATER}' end as valid_to, customer_id % 10 <> 0 as is_current
        from stg_customers where customer_id % 7 <> 0 or customer_id % 10 = 0
        union all
        select customer_id, 'MOVED', timestamp '{LATER}', timestamp '{LATER}', null, true from stg_customers where customer_id % 10 = 0
        union all
        select customer_id, region, updated_at, updated_at, null, true from stg_customers where customer_id % 7 = 0 and customer_id % 10 <> 0""",
)
def _(spark, sf):
    """Every tenth customer moves; some customers are new in the second snapshot."""
    current = Warehouse.from_test_tables(spark, sf).stg_customers.select(*H.CUSTOMER_ATTRIBUTES)
    moved = F.col("customer_id") % 10 == 0
    first = current.filter((F.col("customer_id") % 7 != 0) | moved)
    second = current.withColumns(
        {
            "region": F.when(moved, "MOVED").otherwise(F.col("region")),
            "updated_at": F.when(moved, F.lit(LATER).cast("timestamp_ntz")).otherwise(F.col("updated_at")),
        }
    )
    history = H.scd2_apply(H.open_interval(first), second)
    return history.select("customer_id", "region", "updated_at", "valid_from", "valid_to", "is_current")


def _moves(spark, sf, day: int) -> DataFrame:
    """The customers as of a snapshot: those of the day's number modulo 10 and below have moved, on days of their own."""
    current = Warehouse.from_test_tables(spark, sf).stg_customers.select(*H.CUSTOMER_ATTRIBUTES)
    turn = F.col("customer_id") % 10
    moved = turn < day
    at = F.lit(LATER).cast("timestamp_ntz") + F.make_dt_interval(turn.cast("int"))
    return current.withColumns(
        {
            "region": F.when(moved, "MOVED").otherwise(F.col("region")),
            "updated_at": F.when(moved, at).otherwise(F.col("updated_at")),
        }
    ).filter((F.col("customer_id") % 7 != 0) | (F.lit(day) > 1))


@query(
    "I1_stored_history",
    f"""with moved as (
            select *, timestamp '{LATER}' + interval 1 day * (customer_id % 10)::int as moved_at, customer_id % 10 < 3 as gone from stg_customers
        ), seen as (  -- who moves on day 1 and is first seen on day 2 was never seen before the move
            select *, not (customer_id % 7 = 0 and customer_id % 10 < 2) as before from moved
        )
        select customer_id, region, updated_at, updated_at as valid_from, case when gone then moved_at end as valid_to, not gone as is_current
        from seen where before
        union all
        select customer_id, 'MOVED', moved_at, moved_at, null, true from seen where gone""",
)
def _(spark, sf):
    """Four snapshots, one of them twice: a run writes the tenth of the customers that moved."""
    history = IntervalStore(_store(spark), "history/customers")
    for day in (0, 1, 2, 2, 3):
        history.apply(_moves(spark, sf, day))
    return history.read().select("customer_id", "region", "updated_at", "valid_from", "valid_to", "is_current")


@query(
    "I2_scd2_from_log",
    """select order_item_id, updated_at, updated_at as valid_from,
              lead(updated_at) over (partition by order_item_id order by updated_at) as valid_to,
              lead(updated_at) over (partition by order_item_id order by updated_at) is null as is_current
       from (select distinct order_item_id, updated_at from raw_order_items)""",
)
def _(spark, sf):
    log = T.raw_order_items(spark, sf)
    history = H.scd2_from_log(log, "order_item_id", order_by=["product_id", "unit_price", "quantity"])
    return history.select("order_item_id", "updated_at", "valid_from", "valid_to", "is_current")


@query("I3_tier_history", " union all ".join(
    f"select customer_id, as_of_date, tier, tier_rank from scored_run{i}" for i in range(1, len(RUN_DATES) + 1)
))
def _(spark, sf):
    """Two runs over the same dates leave one row per customer and date."""
    from acctiers.catalog.tiering import Inputs

    store, tiers = _store(spark), Inputs(spark, sf).run(RUN_DATES).tiers
    kept = tiers.select("customer_id", "tier", "tier_rank", "as_of_date")
    for _again in range(2):
        store.replace_partition(kept, "tiering/customer_tier_history", "as_of_date")
    return store.read("tiering/customer_tier_history")


# --- U: streaming ------------------------------------------------------------------------------------


@query("U1_stream_ingest", _CONFORMED, "discount_pct")
def _(spark, sf):
    folder = land(spark, T.raw_orders(spark, sf), "orders")
    target, check = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    U.ingest("orders", U.stream_csv(spark, "orders", folder), target, check).awaitTermination()
    # started again with nothing new: no row is read twice
    U.ingest("orders", U.stream_csv(spark, "orders", folder), target, check).awaitTermination()
    return spark.read.parquet(target).drop("_batch_id", "_loaded_at", "_source_file")


@query("U1_stream_mixed_headers", _CONFORMED, "discount_pct")
def _(spark, sf):
    """Files of one folder name their columns in two orders, some with a column more; every row lands once."""
    rows, folder = _as_text(T.raw_orders(spark, sf)), scratch_path(spark, "landing-mixed")
    even = F.col("order_id").cast("bigint") % 2 == 0
    turned = rows.select(*[F.col(c).alias(c.upper()) for c in reversed(rows.columns)], F.lit("x").alias("note"))
    for part in (rows.where(even), turned.where(~even)):
        part.write.mode("append").option("header", True).option("escape", '"').csv(folder)
    store, check = _store(spark), scratch_path(spark, "stream-state")
    for _again in range(2):
        ingest_files(store, "orders", stream_files(spark, folder), check).awaitTermination()
    return store.read("streamed/orders").drop("_batch_id", "_loaded_at", "_source_file")


def _events(spark, sf) -> DataFrame:
    schema = T.table(spark, sf, "events").schema
    stream = U.stream_parquet(spark, sf, schema, "events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(spark, stream: DataFrame) -> DataFrame:
    target = scratch_path(spark, "stream")
    U.run_once(stream, target, scratch_path(spark, "stream-state"))
    return spark.read.parquet(target)


@query("U2_stream_without_repeats", "select event_id, user_id, event_type from events")
def _(spark, sf):
    """Every event arrives twice and leaves once."""
    twice = _events(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    return _run(spark, U.without_repeats(twice, ["event_id"], "ts")).select("event_id", "user_id", "event_type")


@query("U2_stream_append_new", "select event_id, user_id, event_type from events")
def _(spark, sf):
    """Every event arrives in two runs of the stream, however late, and is stored once."""
    target, check = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    twice = _events(spark, sf).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    for state in ("a", "b"):
        U.append_new(twice, ["event_id"], target, f"{check}-{state}").awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type")


@query(
    "U2_stream_newest_version",
    "select event_id % 1000 as key, max(event_id) as event_id, arg_max(event_type, event_id) as event_type from events group by 1",
)
def _(spark, sf):
    """Events as versions of a thousand keys, later ids newer: the first run sees the odd events, the second all of them."""
    target, check = scratch_path(spark, "newest"), scratch_path(spark, "newest-state")
    versions = _events(spark, sf).withColumn("key", F.col("event_id") % 1000)
    for state, seen in (("a", versions.where("event_id % 2 = 1")), ("b", versions)):
        U.keep_newest(seen, ["key"], ["event_id"], target, f"{check}-{state}").awaitTermination()
    return U.newest(spark, target).select("key", "event_id", "event_type")


@query(
    "U3_stream_daily_counts",
    "select date_trunc('day', ts) as batch_start, event_type as source, count(*) as rows_loaded from events group by all",
)
def _(spark, sf):
    target = scratch_path(spark, "stream")
    counts = U.daily_counts(_events(spark, sf), "ts", "event_type")
    U.keep_current(counts, target, scratch_path(spark, "stream-state")).awaitTermination()
    counted = spark.read.parquet(target)
    return counted.withColumn("batch_start", F.col("batch_start").cast("timestamp_ntz"))
