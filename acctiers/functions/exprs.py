"""Scalar expressions shared by the models.  All stay inside whole-stage codegen except ``normal_cdf``."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctiers.settings import RECOGNIZED_STATUSES

MONEY = T.DecimalType(28, 6)


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Float division that is null where the denominator is zero or null."""
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double"))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def is_recognized(status: Column, statuses: Sequence[str] = RECOGNIZED_STATUSES) -> Column:
    return status.isin(list(statuses))


def size_band(employees: Column) -> Column:
    return (
        F.when(employees.isNull(), "Unknown")
        .when(employees < 50, "Small (<50)")
        .when(employees < 250, "Mid-market (50-249)")
        .otherwise("Enterprise (250+)")
    )


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def add_days(day: Column, days: Column | int) -> Column:
    return F.date_add(day, days if isinstance(days, int) else days.cast("int"))


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def log_positive(value: Column) -> Column:
    return F.log1p(F.greatest(value, F.lit(0.0)))


def clip(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)


def tidy(value: Column) -> Column:
    """Strip every kind of white space at both ends, not only spaces."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def utc(moment: datetime) -> datetime:
    """A naive time counts as UTC."""
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


def as_json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def linear_interpolation(low: Column, high: Column, fraction: Column) -> Column:
    return low + (high - low) * fraction


@F.pandas_udf(T.DoubleType())
def normal_cdf(z: pd.Series) -> pd.Series:
    # Spark has no erf; erfc keeps the far lower tail accurate
    return z.map(lambda v: 0.5 * math.erfc(-v / math.sqrt(2.0)), na_action="ignore")


# --- fixed values: text patterns used to infer a logical type -----------------------------
INTEGER_TEXT = r"^[+-]?\d+$"
FLOAT_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DATE_TEXT = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP_TEXT = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([+-]\d{2}:?\d{2}|Z)?$"
BOOLEAN_TEXT = r"^(?i)(true|false|t|f|yes|no)$"
CUSTOMER_ID_TEXT = r"^C\d{5}$"
