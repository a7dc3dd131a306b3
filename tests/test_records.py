"""CSV records cut from byte ranges, checksums of files of any size."""

import csv
import hashlib
import io
import random

import pytest

from acctiers.sources import landing
from acctiers.sources.records import INSIDE, OUTSIDE, line_end

SMALL_RANGES = {"spark.sql.files.maxPartitionBytes": "997", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture(params=["one", "many"])
def ranges(spark, request):
    """Files read whole, or in ranges of 997 bytes."""
    old = {k: spark.conf.get(k) for k in SMALL_RANGES}
    for k, v in SMALL_RANGES.items() if request.param == "many" else ():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def field(rnd):
    kind = rnd.random()
    if kind < 0.3:
        return rnd.choice(["x", "", "a b", "5 in", "é", "it's"])
    if kind < 0.4:
        return rnd.choice(['5" pipe', 'a"b"c', 'x""'])  # quotes in an unquoted field
    return '"' + "".join(rnd.choice(["a", ",", "\n", "\r\n", '""', "é", " ", "b"]) for _ in range(rnd.randrange(12))) + '"'


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
def test_quotes_commas_and_line_breaks(spark, tmp_path, ranges, eol):
    """Equal to Python's csv module and to the multi-line reader, which writes line breaks of its own kind."""
    rnd = random.Random(3)
    lines = ["Id , P,q", *(f"r{i},{field(rnd)},{field(rnd)}" for i in range(1500)), 'long,"' + "z\n" * 2000 + '",end', "plain,,1"]
    text = eol.join(lines) + eol
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_bytes(text.encode())
    got = sorted((tuple(r) for r in landing.extract_csv(spark, str(tmp_path)).collect()), key=str)
    rows = list(csv.reader(io.StringIO(text, newline="")))[1:]
    assert got == sorted((tuple(c or None for c in r) for r in rows * 2), key=str)
    options = {"header": True, "escape": '"', "multiLine": True}
    theirs = spark.read.options(**options).csv(str(tmp_path)).collect()
    same = lambda rows: sorted((tuple(c and c.replace("\r\n", "\n") for c in r) for r in rows), key=str)
    assert same(got) == same(tuple(c or None for c in r) for r in theirs)


def test_many_tasks_read_one_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n" + "".join(f'{i},"two\nlines"\n' for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        from acctiers.sources.records import file_lines

        assert file_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 5
        assert landing.extract_csv(spark, str(tmp_path)).where("b = 'two\nlines'").count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_that_ends_inside_quotes_is_an_error(spark, tmp_path, ranges):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3,\"open\n" + "more\n" * 900)
    with pytest.raises(Exception, match="not closed"):
        landing.extract_csv(spark, str(tmp_path)).collect()


def test_header_only_and_blank_lines(spark, tmp_path, ranges):
    (tmp_path / "a.csv").write_text("a,b\n")
    (tmp_path / "b.csv").write_text("a,b\n\n1,2\n\r\n\n3,\n")
    assert sorted(tuple(r) for r in landing.extract_csv(spark, str(tmp_path)).collect()) == [("1", "2"), ("3", None)]


@pytest.mark.parametrize(
    "line,outside,inside",
    [
        ("a,b", OUTSIDE, INSIDE),
        ('a,"b', INSIDE, OUTSIDE),
        ('a,"b"', OUTSIDE, OUTSIDE),
        ('a,"b",""', OUTSIDE, OUTSIDE),
        ('x",y', OUTSIDE, OUTSIDE),
        ('5" pipe,z', OUTSIDE, OUTSIDE),
        ('""', OUTSIDE, INSIDE),
        ('","', OUTSIDE, INSIDE),
        ('say ""hi', OUTSIDE, INSIDE),
    ],
)
def test_lines_as_functions_of_states(line, outside, inside):
    assert (line_end(OUTSIDE, line), line_end(INSIDE, line)) == (outside, inside)


@pytest.mark.parametrize("text", [b"a,b\n1,2\n", b"a,b\n1,2", b"\n\n\n", b"\xff\xfe,raw\r\n1\n" * 400, b"x" * 5000])
def test_checksum_of_any_bytes(spark, tmp_path, ranges, text):
    (tmp_path / "a.csv").write_bytes(text)
    (tmp_path / "b.csv").write_bytes(text * 2)
    rows = {r["path"].rpartition("/")[2]: (r["length"], r["checksum"]) for r in landing.file_checksums(spark, str(tmp_path)).collect()}
    assert rows == {n: (len(t), hashlib.md5(t).hexdigest()) for n, t in (("a.csv", text), ("b.csv", text * 2))}


def test_load_reads_the_stored_table_for_its_watermark_alone(spark, tmp_path, monkeypatch):
    from acctiers.sources import loader
    from acctiers.sources.store import Store

    store = Store(spark, str(tmp_path / "store"))
    header = "order_id,customer_id,order_date,status,channel,discount_pct,payment_terms_days,paid_date,updated_at"
    (tmp_path / "in").mkdir()
    calls = []
    read = Store.read
    monkeypatch.setattr(Store, "read", lambda self, name, columns=None: (calls.append((name, columns)), read(self, name, columns))[1])
    for batch, days in enumerate(((1, 2), (1, 2, 3))):
        (tmp_path / "in" / "orders.csv").write_text("\n".join([header, *(f"O{d},C1,2026-01-0{d},done,web,0.1,30,,2026-01-0{d} 08:00:00" for d in days)]) + "\n")
        calls.clear()
        done = loader.load_source(store, "orders", str(tmp_path / "in"))
        assert [c for n, c in calls if n == "raw/orders" and c] == ([["updated_at"]] if batch else [])
        audit = spark.read.parquet(store.path(loader.AUDIT)).orderBy("finished_at").collect()[-1]
        assert (done.rows_loaded, done.table_rows, audit["watermark_after"]) == ((2, 2, "2026-01-02 08:00:00"), (1, 3, "2026-01-03 08:00:00"))[batch]
