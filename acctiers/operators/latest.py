"""Newest version of each key in an append-only table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_record(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in ``order_by`` order (names sort descending).

    The ``= 1`` filter lets Catalyst put a group limit below the shuffle, so a key that holds a
    large part of the table sends one row per map task instead of all of its versions.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c).desc() if isinstance(c, str) else c for c in order_by]
    ranked = df.withColumn("_version", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_version") == 1).drop("_version")
