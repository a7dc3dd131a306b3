"""CSV records of files of any size, read by many tasks, with line breaks inside quotes.

A file is read as lines by byte range.  A line starts either at a record's start or inside a quoted field, so a
line, and a range of lines, is a function of two states to two states.

1. Each range composes the functions of its lines that hold a quote (others keep the state).
2. A scan over the ranges of a file gives the state at the start of each range: one small row per range.
3. Each range cuts its own records.  A record over several ranges comes out in pieces, which are put together by file.

Inside quotes a doubled quote stands for one; a quote inside an unquoted field is an ordinary character.  Line breaks
inside quotes stay as they are.  A quote that its file never closes is an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OUTSIDE, INSIDE = 0, 1
WHOLE, HEAD, TAIL, THROUGH = 0, 1, 2, 3  # a record, or its last, first or middle piece

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_PLAIN = r'[^",][^,]*+'
_FIELDS = rf"(?:(?:{_QUOTED}|{_PLAIN})?+,)*+"
_OPEN = r'"[^"]*+(?:""[^"]*+)*+'
_LEFT_OPEN = re.compile(rf"{_FIELDS}{_OPEN}\Z")
_NEVER_CLOSED = re.compile(r'[^"]*+(?:""[^"]*+)*+\Z')
_OPEN_AGAIN = re.compile(rf'[^"]*+(?:""[^"]*+)*+"[^,]*+,{_FIELDS}{_OPEN}\Z')


def line_end(state: int, line: str) -> int:
    """State after a line that starts in ``state``."""
    if '"' not in line:
        return state
    if state == OUTSIDE:
        return INSIDE if _LEFT_OPEN.match(line) else OUTSIDE
    return INSIDE if _NEVER_CLOSED.match(line) or _OPEN_AGAIN.match(line) else OUTSIDE


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(line, file, block): lines in file order inside each byte range ``block``."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    return text.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, from0, from1): where a range leads from each state."""
    at, ends = None, (OUTSIDE, INSIDE)

    def out():
        return pa.RecordBatch.from_pylist([{"file": at[0], "block": at[1], "from0": ends[0], "from1": ends[1]}], schema=_RANGES)

    for batch in batches:
        for line, *place in zip(*(batch[c].to_pylist() for c in ("line", "file", "block")), strict=True):
            if place != at:
                if at:
                    yield out()
                at, ends = place, (OUTSIDE, INSIDE)
            ends = line_end(ends[0], line), line_end(ends[1], line)
    if at:
        yield out()


_RANGES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("from0", pa.int32()), ("from1", pa.int32())])
_PIECES = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])


def range_starts(lines: DataFrame) -> DataFrame:
    """(file, block) of the ranges that start inside quotes; one row per range at most."""
    ranges = lines.where(F.contains("line", F.lit('"'))).mapInArrow(_ranges, "file string, block bigint, from0 int, from1 int")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    steps = F.collect_list(F.struct("from0", "from1")).over(before)
    state = F.aggregate(steps, F.lit(OUTSIDE), lambda s, f: F.when(s == OUTSIDE, f["from0"]).otherwise(f["from1"]))
    ends = ranges.withColumn("state", state)
    last = F.when(F.col("state") == OUTSIDE, F.col("from0")).otherwise(F.col("from1"))
    return ends.select("file", "block", "state", last.alias("after"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records of each range, from lines with the state at the range's start."""
    at, state, pieces, opened, first = None, OUTSIDE, [], False, False
    rows: list[tuple] = []

    def close():
        if pieces:  # the range ends inside quotes
            rows.append((*at, TAIL if opened else THROUGH, first and opened, "\n".join(pieces)))

    for batch in batches:
        files, blocks, starts = (batch[c] for c in ("file", "block", "inside"))
        same = batch.num_rows and [files[0].as_py(), blocks[0].as_py()] == at and files[-1].as_py() == at[0] and blocks[-1].as_py() == at[1]
        if same and state == OUTSIDE and not first and not pc.any(pc.match_substring(batch["line"], '"')).as_py():
            n = batch.num_rows  # every line is a record
            yield pa.RecordBatch.from_arrays([files, blocks, pa.array([WHOLE] * n, pa.int32()), pa.array([False] * n), batch["line"].cast(pa.string())], schema=_PIECES)
            continue
        for line, file, block, inside in zip(*(c.to_pylist() for c in (batch["line"], files, blocks, starts)), strict=True):
            if [file, block] != at:
                close()
                at, state, pieces, first = [file, block], INSIDE if inside else OUTSIDE, [], block == 0
                opened = state == OUTSIDE
            if not pieces and state == OUTSIDE:
                opened = True
            state = line_end(state, line)
            pieces.append(line)
            if state == OUTSIDE:
                rows.append((*at, WHOLE if opened else HEAD, first, "\n".join(pieces)))
                pieces, first = [], False
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECES.types, strict=True)], schema=_PIECES)
            rows = []
    close()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECES.types, strict=True)], schema=_PIECES)


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, first, record): every CSV record of the files, ``first`` for the first one of each file."""
    lines = file_lines(spark, path)
    # ranges with quotes know their state; one without takes it from the last one before it
    known = range_starts(lines).select("file", F.struct("block", "state", "after").alias("range")).groupBy("file").agg(F.array_sort(F.collect_list("range")).alias("ranges"))
    known = known.select(F.col("file").alias("name"), "ranges")  # one row per file, a few numbers per range
    spots = lines.select("line", "file", "block").join(F.broadcast(known), F.col("file") == F.col("name"), "left")
    passed = F.filter("ranges", lambda r: r["block"] <= F.col("block"))
    last = F.try_element_at(passed, F.lit(-1))
    inside = F.when(last["block"] == F.col("block"), last["state"]).otherwise(last["after"]) == INSIDE
    pieces = spots.select("line", "file", "block", F.coalesce(inside, F.lit(False)).alias("inside")).mapInArrow(
        _cut, "file string, block bigint, kind int, first boolean, record string"
    )
    order = Window.partitionBy("file").orderBy("block", "kind")
    parts = pieces.where(F.col("kind") != WHOLE).withColumn("number", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = parts.groupBy("file", "number").agg(
        F.bool_or("first").alias("first"),
        F.bool_or(F.col("kind") == HEAD).alias("closed"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "record"))), lambda p: p["record"]), "\n").alias("record"),
    )
    broken = F.raise_error(F.concat(F.lit("a quoted field is not closed in "), F.col("file")))
    joined = joined.withColumn("record", F.when(F.col("closed"), F.col("record")).otherwise(broken))
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "first", "record")
    return whole.unionByName(joined.select("file", "first", "record")).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
