"""Stored histories: equal to applying snapshots in memory, and written in proportion to what changed."""

import random
from datetime import datetime, timedelta

import pytest

from acctiers.operators import history as H
from acctiers.sources.intervals import Applied, IntervalStore
from acctiers.sources.store import Store

START = datetime(2026, 1, 1)
DDL = "id bigint, name string, updated_at timestamp_ntz"


def snapshot(spark, rows):
    return spark.createDataFrame(rows, DDL)


def plain(df):
    return sorted((tuple(r) for r in df.select("id", "name", "updated_at", "valid_from", "valid_to", "is_current").collect()), key=str)


def opened(spark, tmp_path, **more):
    return IntervalStore(Store(spark, str(tmp_path / "store")), "history/h", "id", **more)


@pytest.mark.parametrize("fold_at", [0.0, 0.3, 9.0])
def test_equals_snapshots_applied_in_memory(spark, tmp_path, fold_at):
    """Whatever is folded: rows that advance, stay, go back, are missing, new, or have a null key."""
    chance, history, expected = random.Random(5), opened(spark, tmp_path, fold_at=fold_at), None
    state = {i: (f"n{i}", START) for i in range(40)}
    for day in range(1, 5):
        for i in chance.sample(range(60), 12):
            state[i] = (f"n{i}-{day}", START + timedelta(days=chance.choice([day, day, -day])))
        rows = [(i, *state[i]) for i in state if chance.random() < 0.9]
        incoming = snapshot(spark, rows)
        expected = H.open_interval(incoming) if expected is None else H.scd2_apply(expected, incoming, "id")
        expected = expected.checkpoint()
        history.apply(incoming)
        assert plain(history.read()) == plain(expected)
        assert history.rows() == expected.count()
        assert plain(history.current()) == plain(expected.filter("is_current"))


def test_a_run_writes_what_changed(spark, tmp_path):
    history, later = opened(spark, tmp_path), START + timedelta(days=1)
    rows = [(i, "a", START) for i in range(1000)]
    assert history.apply(snapshot(spark, rows)) == Applied(1000, 0, False)
    folder = tmp_path / "store" / "history" / "h"
    before = {p: p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}
    assert history.apply(snapshot(spark, rows)) == Applied(0, 0, False)  # again: nothing, and no folder
    assert [p.name for p in folder.iterdir()] == ["run=000000001"]
    moved = [(i, "b", later) for i in range(10)] + rows[10:] + [(1000, "new", later)]
    assert history.apply(snapshot(spark, moved)) == Applied(11, 10, False)
    assert spark.read.parquet(str(folder / "run=000000002")).count() == 21
    assert before == {p: p.stat().st_mtime_ns for p in before}  # earlier files stay as they are
    assert history.rows() == 1011


def test_a_failed_run_leaves_one_copy(spark, tmp_path):
    history, later = opened(spark, tmp_path), START + timedelta(days=1)
    history.apply(snapshot(spark, [(i, "a", START) for i in range(10)]))
    moved = snapshot(spark, [(0, "b", later)] + [(i, "a", START) for i in range(1, 10)])
    history.apply(moved)
    (tmp_path / "store" / "history" / "h" / "run=000000002" / "_SUCCESS").unlink()  # as if it had stopped before its commit
    assert history.rows() == 10
    history.apply(moved)
    assert history.rows() == 11 and history.current().filter("name = 'b'").count() == 1


def test_empty_null_and_missing(spark, tmp_path):
    history = opened(spark, tmp_path)
    assert history.read() is None and history.current() is None and history.rows() == 0
    assert history.apply(snapshot(spark, [])) == Applied(0, 0, False)
    assert history.read() is None
    odd = [(None, "no key", START), (1, None, None)]
    assert history.apply(snapshot(spark, odd)).opened == 2
    assert history.apply(snapshot(spark, odd)) == Applied(0, 0, False)
    assert history.apply(snapshot(spark, [])) == Applied(0, 0, False)
    assert history.rows() == 2
