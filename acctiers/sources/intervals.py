"""A stored history of validity intervals, of which a run writes only what changed.

A history is a folder per committed run: <name>/run=<n>/part=<base|opened|closed>.  ``base`` holds every open row as
of its run, ``opened`` the rows a run opened, ``closed`` the intervals it ended, which never change again.  Open rows are
the last base and what later runs opened, newest version per key.  The opened rows are folded into a new base once
they reach ``fold_at`` of the last one, so what all runs write stays within 2 + 1 / ``fold_at`` of what changed.

Read a history through this class: the folders also hold rows that later runs replaced.  What the last base but one
made obsolete is removed after a fold, so a reader that has listed the folders can finish.

A run counts once its folder is committed.  A failed run leaves none, and the next one writes the same number again;
a snapshot applied twice changes nothing and leaves no folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctiers.operators.history import changed_rows, open_interval
from acctiers.operators.latest import latest_record
from acctiers.sources.store import Store

BASE, OPENED, CLOSED = "base", "opened", "closed"
FOLD_AT = 0.5  # opened rows, as a share of the last base, from which the base is written anew


@dataclass(frozen=True)
class Applied:
    """What a run wrote: rows opened, rows closed, and whether the open rows were folded into a new base."""

    opened: int
    closed: int
    folded: bool


class IntervalStore:
    """The history ``name`` of a store, one row per key and version; a null key is a key of its own."""

    def __init__(self, store: Store, name: str, key: str = "customer_id", updated_at: str = "updated_at", fold_at: float = FOLD_AT):
        self.store, self.name, self.key, self.updated_at, self.fold_at = store, name, key, updated_at, fold_at

    def _run(self, number: int) -> str:
        return f"{self.name}/run={number:09d}"

    def _runs(self) -> dict[int, set[str]]:
        """Parts of each committed run, oldest first; names alone are read."""
        runs = {}
        for folder in self.store.listed(self.name):
            names = set(self.store.listed(f"{self.name}/{folder}")) if folder.startswith("run=") else ()
            if "_SUCCESS" in names:
                runs[int(folder[4:])] = {n[5:] for n in names if n.startswith("part=")}
        return dict(sorted(runs.items()))

    def _parts(self, wanted: list[tuple[int, str]]) -> DataFrame | None:
        paths = [self.store.path(f"{self._run(n)}/part={part}") for n, part in wanted]
        return self.store.spark.read.schema(self.store.schema(self.name)).parquet(*paths) if paths else None

    def _open_parts(self, runs: dict[int, set[str]]) -> tuple[list, list]:
        last = max((n for n, parts in runs.items() if BASE in parts), default=0)
        later = [(n, OPENED) for n, parts in runs.items() if n > last and OPENED in parts]
        return [(last, BASE)] if last else [], later

    def current(self) -> DataFrame | None:
        """Open rows; None before the first run.  No shuffle right after a fold."""
        base, later = self._open_parts(self._runs())
        rows = self._parts(base + later)
        return latest_record(rows, self.key, [self.updated_at]) if later else rows

    def read(self) -> DataFrame | None:
        """All rows, open and closed; None before the first run."""
        closed = self._parts([(n, CLOSED) for n, parts in self._runs().items() if CLOSED in parts])
        rows = self.current()
        return rows if closed is None else rows.unionByName(closed)

    def rows(self) -> int:
        """Rows of the history, open and closed, from the footers: each row a run closes has an opened one beside it."""
        runs = self._runs()
        base, later = self._open_parts(runs)
        since = {n for n in runs if n > base[0][0]} if base else set()
        closed = {n: self._count([(n, CLOSED)]) for n, parts in runs.items() if CLOSED in parts}
        open_rows = self._count(base) + self._count(later) - sum(n for run, n in closed.items() if run in since)
        return open_rows + sum(closed.values())

    def _write(self, rows: DataFrame, number: int) -> None:
        """One job for all parts of a run; its folder is committed as a whole."""
        few = rows.hint("rebalance", F.col("part"))
        few.write.mode("overwrite").partitionBy("part").parquet(self.store.path(self._run(number)))

    def _count(self, wanted: list[tuple[int, str]]) -> int:
        rows = self._parts(wanted)
        return rows.count() if rows is not None else 0  # from the footers

    def apply(self, snapshot: DataFrame) -> Applied:
        """Open what is new in a snapshot of one row per key, and end the intervals of what it replaces.

        A row changes only when its ``updated_at`` moved forward; keys that the snapshot lacks stay as they are.
        """
        runs = self._runs()
        number = max(runs, default=0) + 1
        fresh = open_interval(snapshot, self.updated_at)
        if not runs:
            self.store.note_schema(self.name, _nullable(fresh.schema))
            self._write(fresh.withColumn("part", F.lit(BASE)), number)
            if not self._runs()[number]:  # no row, no part
                self._drop(number)
                return Applied(0, 0, False)
            return Applied(self._count([(number, BASE)]), 0, False)
        changes = changed_rows(self.current(), fresh.select(*self.store.schema(self.name).names), self.key, self.updated_at)
        part = F.when(F.col("is_current"), F.lit(OPENED)).otherwise(F.lit(CLOSED))
        self._write(changes.withColumn("part", part), number)
        runs = self._runs()
        opened, closed = (self._count([(number, p)] if p in runs[number] else []) for p in (OPENED, CLOSED))
        if not opened:
            self._drop(number)
            return Applied(0, 0, False)
        base, later = self._open_parts(runs)
        fold = self._count(later) >= self.fold_at * self._count(base)
        if fold:
            self._write(self.current().withColumn("part", F.lit(BASE)), number + 1)
            self._tidy()
        return Applied(opened, closed, fold)

    def _tidy(self) -> None:
        runs = self._runs()
        bases = [n for n, parts in runs.items() if BASE in parts]
        for n, parts in runs.items():
            if len(bases) > 1 and n < bases[-2]:
                for part in parts & {BASE, OPENED}:
                    self.store.remove(f"{self._run(n)}/part={part}")

    def _drop(self, number: int) -> None:
        """Remove the folder of a run that changed nothing."""
        self.store.remove(self._run(number))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])
