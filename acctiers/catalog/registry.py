"""Registry of named queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctiers.catalog.sql import with_parts
from acctiers.session import apply_runtime

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None
    rounds: dict[str, int]


REGISTRY: dict[str, Entry] = {}


def _places(text: str) -> dict[str, int]:
    """"a b:4 c" -> {"a": 6, "b": 4, "c": 6}"""
    out = {}
    for word in text.split():
        name, _, places = word.partition(":")
        out[name] = int(places or 6)
    return out


def comparable(df: DataFrame, rounds: dict[str, int]) -> DataFrame:
    """Plain types and agreed decimals, so two engines can be compared value by value."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in rounds:
            c = F.round(c.cast("double"), rounds[f.name]) + F.lit(0.0)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, rounds: str = "") -> Callable[[Query], Query]:
    """Register a query.  ``rounds`` lists its floating columns with their decimals (6 unless given)."""
    places = _places(rounds)

    def register(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        final = None
        if sql is not None:
            replaced = ", ".join(f"round(cast({c} as double), {p}) + 0.0 as {c}" for c, p in places.items())
            body = f"select * {f'replace ({replaced})' if replaced else ''} from ({sql})"
            final = with_parts(body)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(apply_runtime(spark), sf_dir), places)

        REGISTRY[name] = Entry(run, final, places)
        return fn

    return register
