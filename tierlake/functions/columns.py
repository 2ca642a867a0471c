"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """Column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def missing(df: DataFrame, name: str) -> Column:
    """True for null and, in floating columns, for NaN."""
    c = named(name)
    return c.isNull() | F.isnan(c) if is_floating(df.schema[name].dataType) else c.isNull()


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null, so that built-in aggregates skip it."""
    c = named(name)
    return F.when(~F.isnan(c), c) if is_floating(df.schema[name].dataType) else c


def require(df: DataFrame, *names: str) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
