"""Streamed landing: files of one micro-batch whose headers differ behave as the batch load does."""

import pytest
from pyspark.sql import functions as F

from acctiers.sources.loader import load_source
from acctiers.sources.store import Store
from acctiers.streaming.landing import by_header, ingest_files, stream_files

NAMES = ["product_id", "product_name", "category", "unit_cost", "list_price", "updated_at"]
CONTENT = ["product_id", "product_name", "unit_cost", "updated_at", "_source_file"]


def product(i, **more):
    row = {"product_id": f"P{i}", "product_name": f"Widget, {i}", "category": "c", "unit_cost": "1.5", "list_price": "2", "updated_at": f"2026-01-{i:02d} 00:00:00"}
    return row | more


def land(folder, name, rows, columns):
    folder.mkdir(exist_ok=True)
    lines = [",".join(columns)] + [",".join(f'"{r[c.strip().lower()]}"' for c in columns) for r in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def run(spark, store, folder, tmp_path, state="state"):
    ingest_files(store, "products", stream_files(spark, str(folder)), str(tmp_path / state), "r1").awaitTermination()


def content(df):
    return sorted(tuple(r) for r in df.select(*CONTENT).collect())


def test_orders_of_columns_and_more_of_them(spark, tmp_path):
    """Reordered, added and untidy columns in one micro-batch: the rows of loading each file on its own."""
    folder, store, alone = tmp_path / "in", Store(spark, str(tmp_path / "a")), []
    land(folder, "one.csv", [product(1), product(2, product_name="two\nlines")], NAMES)
    land(folder, "two words+.csv", [product(3)], NAMES[::-1])
    land(folder, "three.csv", [product(4, note="n"), product(5, note="")], [" NOTE ", *[n.upper() for n in NAMES]])
    (folder / "empty.csv").write_text("")
    run(spark, store, folder, tmp_path)
    for name in ("one.csv", "two words+.csv", "three.csv"):
        other = Store(spark, str(tmp_path / name))
        load_source(other, "products", str(folder / name))
        alone += content(other.read("raw/products"))
    assert content(store.read("streamed/products")) == sorted(alone)
    audit = store.read("monitoring/load_audit").collect()
    assert [(r["rows_loaded"], r["table_rows_after"], r["columns_dropped"], r["status"]) for r in audit] == [(5, 5, "note", "success")]
    assert audit[0]["source_file"] == "one.csv,three.csv,two words+.csv" and len(audit[0]["file_checksum"]) == 32
    kinds = {r["check_type"] for r in store.read("monitoring/check_results").select("check_type").collect()}
    assert len(kinds) == 2  # drift and volume

    run(spark, store, folder, tmp_path)  # nothing new
    land(folder, "late.csv", [product(1, product_id="P0", updated_at="2020-01-01 00:00:00")], NAMES)
    run(spark, store, folder, tmp_path)
    assert store.read("streamed/products").count() == 6  # older than all others, loaded all the same
    assert store.read("monitoring/load_audit").agg(F.sum("rows_loaded")).first()[0] == 6


def test_a_lost_column_stops_the_batch(spark, tmp_path):
    folder, store = tmp_path / "in", Store(spark, str(tmp_path / "s"))
    land(folder, "good.csv", [product(1)], NAMES)
    land(folder, "bad.csv", [product(2)], [n for n in NAMES if n != "unit_cost"])
    with pytest.raises(Exception, match="unit_cost"):
        run(spark, store, folder, tmp_path)
    assert not store.exists("streamed/products") and not store.exists("monitoring/load_audit")
    assert store.read("monitoring/check_results").filter("severity = 'error'").count() == 1
    land(folder, "bad.csv", [product(2)], NAMES)  # mended in place: the same batch goes through
    run(spark, store, folder, tmp_path)
    assert store.read("streamed/products").count() == 2


def test_a_replayed_batch_leaves_one_copy(spark, tmp_path):
    """The state's commit is lost after the batch was written."""
    folder, store = tmp_path / "in", Store(spark, str(tmp_path / "s"))
    land(folder, "one.csv", [product(1)], NAMES)
    run(spark, store, folder, tmp_path)
    for commit in (tmp_path / "state" / "commits").iterdir():
        commit.unlink()
    run(spark, store, folder, tmp_path)
    assert store.read("streamed/products").count() == 1
    assert store.read("monitoring/load_audit").count() == 1


def test_headers_group_files(spark, tmp_path):
    land(tmp_path / "in", "a.csv", [product(1)], NAMES)
    land(tmp_path / "in", "b.csv", [product(2)], NAMES[::-1])
    land(tmp_path / "in", "c.csv", [product(3)], NAMES)
    groups = by_header(spark, [(tmp_path / "in" / n).as_uri() for n in ("c.csv", "b.csv", "a.csv")])
    assert [[p.rsplit("/", 1)[1] for p in paths] for paths in groups.values()] == [["a.csv", "c.csv"], ["b.csv"]]
