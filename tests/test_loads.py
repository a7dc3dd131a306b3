"""Loads, stores, history and streaming on small files."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from acctiers.operators import history as H
from acctiers.operators import monitor as M
from acctiers.operators.latest import latest_record
from acctiers.session import literal_rows
from acctiers.sources import landing, loader
from acctiers.sources.store import Store, with_audit, after_watermark
from acctiers.streaming import ingest as U

HEADER = " ORDER_ID ,Customer_ID,order_date,status,channel,discount_pct,payment_terms_days,paid_date,updated_at"


def write(folder, *lines, header=HEADER, name="orders.csv"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


def order(number, day, terms="30"):
    return f'O{number},C{number},{day},completed,"Field ""East"" Sales",0.1,{terms},,{day} 08:00:00'


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_csv_is_read_as_text(spark, tmp_path):
    df = landing.extract_csv(spark, write(tmp_path / "in", order(1, "2026-01-01")))
    row = df.first()
    assert df.columns[:2] == ["order_id", "customer_id"]
    assert row["channel"] == 'Field "East" Sales' and row["paid_date"] is None and row["discount_pct"] == "0.1"


def test_checksum_is_md5_of_the_bytes(spark, tmp_path):
    import hashlib

    folder = write(tmp_path / "in", order(1, "2026-01-01"))
    want = hashlib.md5((tmp_path / "in" / "orders.csv").read_bytes()).hexdigest()
    assert landing.file_checksums(spark, folder).first()["checksum"] == want


def test_conform_rules(spark):
    text = spark.createDataFrame([("1", "2.0", "x")], "order_id string, payment_terms_days string, extra string")
    typed, dropped = landing.conform("orders", text)
    row = typed.first()
    assert dropped == ["extra"] and row["payment_terms_days"] == 2 and row["paid_date"] is None
    bad = spark.createDataFrame([("1", "2 days")], "order_id string, payment_terms_days string")
    with pytest.raises(Exception, match="cannot read as integer"):
        landing.conform("orders", bad)[0].collect()
    flags = spark.createDataFrame([("YES",), ("0",), ("maybe",)], "f string")
    kept, _ = landing.conform("t", flags, {"t": {"f": ("boolean", True)}})
    assert [r["f"] for r in kept.collect()] == [True, False, None]


def test_reload_is_empty_and_flagged(store, tmp_path):
    path = write(tmp_path / "in", order(1, "2026-01-01"), order(2, "2026-01-02"))
    first = loader.load_source(store, "orders", path)
    second = loader.load_source(store, "orders", path)
    assert (first.rows_loaded, second.rows_loaded, second.rows_extracted, second.table_rows) == (2, 0, 2, 2)
    checks = store.read(loader.CHECKS).filter("check_type = 'volume'").orderBy("checked_at").collect()
    assert [c["severity"] for c in checks] == ["pass", "error"]
    audit = store.read(loader.AUDIT).orderBy("started_at").collect()
    assert [a["rows_loaded"] for a in audit] == [2, 0]
    assert audit[1]["watermark_before"] == "2026-01-02 08:00:00"


def test_full_refresh_replaces(store, tmp_path):
    path = write(tmp_path / "in", order(1, "2026-01-01"))
    loader.load_source(store, "orders", path)
    again = loader.load_source(store, "orders", path, full_refresh=True)
    assert (again.strategy, again.rows_loaded, again.table_rows) == ("full_refresh", 1, 1)


def test_drift_stops_the_load(store, tmp_path):
    path = write(tmp_path / "in", order(1, "2026-01-01", terms="30 days"))
    with pytest.raises(M.SchemaDriftError):
        loader.load_source(store, "orders", path)
    assert not store.exists("raw/orders") and not store.exists(loader.AUDIT)
    assert store.read(loader.CHECKS).first()["severity"] == "error"


def test_gate_stops_every_load(store, tmp_path):
    good = write(tmp_path / "in", order(1, "2026-01-01"))
    with pytest.raises(M.SchemaDriftError, match="source.products"):
        loader.load_all(store, {"orders": good, "products": good})
    assert not store.exists("raw/orders")


def test_watermark_is_strict_and_can_look_back(spark):
    rows = [(1, datetime(2026, 1, 1)), (2, datetime(2026, 1, 2)), (3, datetime(2026, 1, 3))]
    df = literal_rows(spark, rows, "id int, updated_at timestamp_ntz")
    ids = lambda d: sorted(r["id"] for r in d.collect())
    mark = datetime(2026, 1, 2)
    assert ids(after_watermark(df, "updated_at", mark)) == [3]
    assert ids(after_watermark(df, "updated_at", None)) == [1, 2, 3]
    assert ids(after_watermark(df, "updated_at", mark, "1 day")) == [2, 3]


def test_evolving_append(spark, store):
    store.append_evolving(spark.range(2).select(F.col("id").alias("a")), "t")
    store.append_evolving(spark.range(1).select(F.lit(5).alias("a"), F.lit("x").alias("b")), "t")
    store.append_evolving(spark.range(1).select(F.lit("y").alias("b")), "t")
    rows = {tuple(r) for r in store.read("t").collect()}
    assert rows == {(0, None), (1, None), (5, "x"), (None, "y")}


def test_partition_replace_is_idempotent(spark, store):
    days = spark.range(6).select("id", (F.col("id") % 3).cast("string").alias("day"))
    for _again in range(2):
        store.replace_partition(days, "h", "day")
    store.replace_partition(days.filter("day = '1'").limit(1), "h", "day")
    assert store.read("h").count() == 5


def test_replace_from_itself(spark, store):
    store.write(spark.range(4).toDF("a"), "t")
    store.replace_from_itself(store.read("t").filter("a > 1"), "t")
    assert sorted(r["a"] for r in store.read("t").collect()) == [2, 3]


def test_latest_record_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 1, "c"), (2, 3, "d")], "k int, at int, x string")
    assert sorted(tuple(r) for r in latest_record(df, "k", ["at", "x"]).collect()) == [(1, 5, "b"), (2, 3, "d")]


def versions(spark, rows):
    return literal_rows(spark, rows, "customer_id int, region string, updated_at timestamp_ntz")


def test_snapshot_history(spark):
    d1, d2, d3 = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)
    first = H.open_interval(versions(spark, [(1, "West", d1), (2, "East", d1), (3, "South", d1)]))
    second = H.scd2_apply(first, versions(spark, [(1, "North", d2), (2, "Moved", d1), (4, "New", d2)]))
    rows = {(r["customer_id"], r["region"]): (r["valid_to"], r["is_current"]) for r in second.collect()}
    assert rows == {
        (1, "West"): (d2, False),
        (1, "North"): (None, True),
        (2, "East"): (None, True),  # updated_at did not advance
        (3, "South"): (None, True),  # missing rows stay open
        (4, "New"): (None, True),
    }
    again = H.scd2_apply(second, versions(spark, [(1, "North", d2)]))
    assert sorted(again.collect()) == sorted(second.collect())
    third = H.scd2_apply(second, versions(spark, [(1, "Back", d3)]))
    assert third.filter("customer_id = 1").count() == 3


def test_history_from_log_crosses_chunks(spark):
    days = [datetime(2026, 1, 5), datetime(2026, 1, 9), datetime(2026, 4, 1), datetime(2026, 4, 2)]
    log = versions(spark, [(1, f"r{i}", d) for i, d in enumerate(days)] + [(1, "r0", days[0]), (2, "z", days[0])])
    got = H.scd2_from_log(log, "customer_id").filter("customer_id = 1").orderBy("valid_from").collect()
    assert [r["valid_to"] for r in got] == [*days[1:], None]
    assert [r["is_current"] for r in got] == [False, False, False, True]


def test_stream_loads_each_file_once_and_late_rows_too(spark, tmp_path):
    folder = tmp_path / "in"
    target, check = str(tmp_path / "out"), str(tmp_path / "check")
    plain = HEADER.replace(" ORDER_ID ", "order_id").replace("Customer_ID", "customer_id")

    def run():
        U.ingest("orders", U.stream_csv(spark, "orders", str(folder)), target, check).awaitTermination()
        return sorted(r["order_id"] for r in spark.read.parquet(target).collect())

    write(folder, order(1, "2026-02-01"), header=plain)
    assert run() == ["O1"]
    write(folder, order(2, "2026-01-01"), header=plain, name="late.csv")
    assert run() == ["O1", "O2"]
    assert run() == ["O1", "O2"]


def test_stream_refuses_reordered_headers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "p.csv").write_text("product_name,product_id,category,unit_cost,list_price,updated_at\nWidget,P1,c,1,2,2026-01-01\n")
    query = U.ingest("products", U.stream_csv(spark, "products", str(folder)), str(tmp_path / "out"), str(tmp_path / "check"))
    with pytest.raises(Exception, match="(?i)header"):
        query.awaitTermination()


def test_line_break_inside_quotes(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('customer_id,business_name\nC1,"Acme\nLtd"\nC2,Other\n')
    rows = landing.extract_csv(spark, str(path)).orderBy("customer_id").collect()
    assert [tuple(r) for r in rows] == [("C1", "Acme\nLtd"), ("C2", "Other")]
    with pytest.raises(Exception, match="does not fit the header"):
        landing.extract_csv(spark, str(path), multi_line=False).collect()


def test_records_that_do_not_fit_are_an_error(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="does not fit the header"):
        landing.extract_csv(spark, str(path)).collect()


def test_late_rows_are_kept_and_repeats_are_not(spark, tmp_path):
    folder, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    schema = "id bigint, ts timestamp"

    def run(*rows):
        data = spark.createDataFrame([(i, datetime.fromisoformat(t)) for i, t in rows], schema)
        data.coalesce(1).write.mode("append").parquet(str(folder))
        U.append_new(U.stream_parquet(spark, str(folder), data.schema), ["id"], target, check).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(target).collect())

    assert run((1, "2026-03-01"), (1, "2026-03-01"), (2, "2026-03-02")) == [1, 2]
    assert run((3, "2026-01-01"), (2, "2026-03-02")) == [1, 2, 3]


def feed(spark, folder, *rows):
    spark.createDataFrame(rows, "id bigint, v bigint, name string").coalesce(1).write.mode("append").parquet(str(folder))


def test_stream_keeps_the_newest_version(spark, tmp_path):
    """Late newer versions replace older ones, late older ones and repeats vanish, a replay changes nothing."""
    folder, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")

    def run(*rows, again=""):
        if rows:
            feed(spark, folder, *rows)
        stream = U.stream_parquet(spark, str(folder), spark.read.parquet(str(folder)).schema)
        U.keep_newest(stream, ["id"], ["v", "name"], target, check + again, buckets=4).awaitTermination()
        return sorted(tuple(r) for r in U.newest(spark, target).select("id", "v", "name").collect())

    assert run((1, 5, "a"), (1, 7, "b"), (2, 1, "c"), (2, 1, "c")) == [(1, 7, "b"), (2, 1, "c")]
    assert run((1, 6, "late"), (2, 3, "newer"), (3, 1, "x")) == [(1, 7, "b"), (2, 3, "newer"), (3, 1, "x")]
    want = run(*[(i, 1, "n") for i in range(4, 40)])
    assert len(want) == 39 and run() == want
    assert run(again="-replayed") == want  # every file once more, under another checkpoint


def test_stream_batch_reads_the_buckets_of_its_keys(spark, tmp_path, monkeypatch):
    folder, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    feed(spark, folder, *[(i, 1, "n") for i in range(500)])
    schema = spark.read.parquet(str(folder)).schema
    start = lambda: U.keep_newest(U.stream_parquet(spark, str(folder), schema), ["id"], ["v"], target, check, buckets=16).awaitTermination()
    start()
    read, seen = U.newest, []
    monkeypatch.setattr(U, "newest", lambda *a: (df := read(*a), seen.extend(df.inputFiles() if df is not None else []))[0])
    feed(spark, folder, (7, 2, "m"), (7, 3, "m"))
    start()
    bucket = spark.createDataFrame([(7,)], "id bigint").select(U.key_bucket(["id"], 16)).first()[0]
    assert seen and all(f"_bucket={bucket}/" in f for f in seen)
    monkeypatch.undo()
    assert U.newest(spark, target).count() == 500 and U.newest(spark, target).where("id = 7").first()["v"] == 3
    held = U._versions(spark, target)
    assert len(held) == 16 and max(map(len, held.values())) <= 2


def test_a_failed_batch_leaves_the_store_as_it_was(spark, tmp_path):
    """A version folder without its commit mark is not read, and the batch writes it again."""
    folder, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    feed(spark, folder, (1, 1, "a"))
    schema = spark.read.parquet(str(folder)).schema
    start = lambda: U.keep_newest(U.stream_parquet(spark, str(folder), schema), ["id"], ["v"], target, check, buckets=2).awaitTermination()
    start()
    half = tmp_path / "out" / "version=000000000002.check-1" / "_bucket=0"
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"half a file")
    assert U.newest(spark, target).count() == 1
    feed(spark, folder, (1, 2, "b"), (2, 1, "c"))
    start()
    assert sorted((r["id"], r["v"]) for r in U.newest(spark, target).collect()) == [(1, 2), (2, 1)]


def test_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    from types import SimpleNamespace

    from acctiers.session import shared_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(fake)


def test_stored_checks_and_snapshot(spark, tmp_path):
    """A run of the checks stores the health mart; snapshots keep what a customer was."""
    from acctiers.plans import runs
    from acctiers.sources import testtables as T
    from acctiers.sources.export import export_datasets

    store, sf = Store(spark, str(tmp_path / "store")), "/root/testdata/sf0.001"
    raw = {"customers": T.raw_customers, "products": T.raw_products, "orders": T.raw_orders, "order_items": T.raw_order_items}
    for name, table in raw.items():
        store.write(table(spark, sf).withColumn("_loaded_at", F.lit(datetime(2001, 7, 31))), f"raw/{name}", "replace")
    health = runs.store_checks(store, datetime(2001, 8, 1))
    assert health.count() == store.read("monitoring/check_results").select("check_type", "check_name", "target").distinct().count() > 0
    runs.store_checks(store, datetime(2001, 8, 2))
    assert store.read("marts/mart_data_health").agg(F.max("runs_30d")).first()[0] == 2
    assert "data_health" in export_datasets(store, str(tmp_path / "export"))

    n = runs.snapshot_customers(store)
    assert runs.snapshot_customers(store) == n
    moved = store.read("raw/customers").withColumns({"region": F.lit("MOVED"), "updated_at": F.lit(datetime(2002, 1, 1)).cast("timestamp_ntz")})
    store.replace_from_itself(moved, "raw/customers")
    assert runs.snapshot_customers(store) == 2 * n
    assert runs.customer_history(store).read().filter("is_current and region = 'MOVED'").count() == n


def test_stored_features_read_only_their_months(spark, tmp_path):
    from acctiers.plans import features as FT
    from acctiers.plans import runs
    from acctiers.sources import testtables as T

    store, sf = Store(spark, str(tmp_path / "store")), "/root/testdata/sf0.001"
    raw = {"customers": T.raw_customers, "products": T.raw_products, "orders": T.raw_orders, "order_items": T.raw_order_items}
    for name, table in raw.items():
        store.write(table(spark, sf), f"raw/{name}", "replace")
    runs.build_marts(store)
    inputs = runs.load_inputs(store)
    for frame in (FT.build_features(*inputs, "2001-08-01"), FT.build_features_multi(*inputs, ["2001-06-01", "2001-08-01"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("PartitionFilters: [isnotnull(order_month") >= 2
    files = list((tmp_path / "store" / "marts" / "fct_orders").glob("order_month=*/*.parquet"))
    months = list((tmp_path / "store" / "marts" / "fct_orders").glob("order_month=*"))
    assert len(files) <= 2 * len(months)
