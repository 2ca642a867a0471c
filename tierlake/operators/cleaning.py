"""Silver cleaning: transform, fill, cast, keep the last row per key (in that order)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from decimal import Decimal
from typing import get_type_hints

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.columns import named, require

# Accepted type names and the Spark type each one stands for.
TYPE_NAMES = {
    "int": "bigint",
    "int64": "bigint",
    "int32": "int",
    "float": "double",
    "float64": "double",
    "float32": "float",
    "str": "string",
    "string": "string",
    "object": "string",
    "bool": "boolean",
    "boolean": "boolean",
    "datetime64[ns]": "timestamp",
}


@dataclass(frozen=True)
class ColumnTransform:
    """Marks a function that takes and returns a Column."""

    fn: Callable[[Column], Column]


def by_column(fn: Callable[[Column], Column]) -> ColumnTransform:
    return ColumnTransform(fn)


#: Python types that a value of each annotated or column type may have.
_RETURNS = {str: "string", int: "bigint", float: "double", bool: "boolean", bytes: "binary"}


def python_transform(fn: Callable, return_type: str | T.DataType) -> ColumnTransform:
    """A Python function of one value, run on Arrow batches; it sees nulls as None."""
    return ColumnTransform(F.udf(fn, return_type, useArrow=True))


def _fits(value: object, dtype: T.DataType) -> bool:
    if value is None:
        return True
    if isinstance(dtype, T.StringType):
        return isinstance(value, str)
    if isinstance(dtype, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(dtype, T.IntegralType):
        return isinstance(value, int) and not isinstance(value, bool)
    if isinstance(dtype, T.FractionalType):
        return isinstance(value, (int, float, Decimal)) and not isinstance(value, bool)
    return True


def _of_type(fn: Callable, dtype: T.DataType) -> Callable:
    """``fn``, refusing results that the column cannot hold as they are."""
    def checked(value):
        result = fn(value)
        if not _fits(result, dtype):
            raise TypeError(f"{result!r} is no {dtype.simpleString()}: name the type with python_transform(fn, type)")
        return float(result) if isinstance(dtype, (T.FloatType, T.DoubleType)) and isinstance(result, int) else result

    return checked


def _as_column(fn: Callable | ColumnTransform, df: DataFrame, name: str) -> Column:
    """Column functions are marked, or are Spark's own; every other function is Python's.

    The type of a Python function's result is its return annotation, else that of the column.
    """
    if isinstance(fn, ColumnTransform):
        return fn.fn(named(name))
    if (getattr(fn, "__module__", None) or "").startswith("pyspark.sql"):
        return fn(named(name))
    try:
        wanted = get_type_hints(fn).get("return")
    except (TypeError, NameError):
        wanted = None
    if wanted in _RETURNS:
        return python_transform(fn, _RETURNS[wanted]).fn(named(name))
    dtype = df.schema[name].dataType
    return python_transform(_of_type(fn, dtype), dtype).fn(named(name))


def apply_transforms(df: DataFrame, transforms: Mapping[str, Callable | ColumnTransform] | None) -> DataFrame:
    """Replace columns by a function of themselves; absent columns are ignored.

    Plain functions get one Python value each, as they would outside Spark. Wrap functions of
    Columns in ``by_column``; those of ``pyspark.sql.functions`` may be given as they are.
    """
    known = {c: f for c, f in (transforms or {}).items() if c in df.columns}
    return df.withColumns({c: _as_column(f, df, c) for c, f in known.items()}) if known else df


def fill_nulls(df: DataFrame, skip: Iterable[str] = ("_source_file",)) -> DataFrame:
    """Strings become ``""``, numbers ``0``, booleans ``false``; NaN counts as null.

    Dates, timestamps and nested columns keep their nulls: no neutral value exists for them.
    """
    skipped, fills = set(skip), {}
    for field in df.schema.fields:
        c = named(field.name)
        if field.name in skipped:
            continue
        if isinstance(field.dataType, T.StringType):
            fills[field.name] = F.coalesce(c, F.lit(""))
        elif isinstance(field.dataType, T.BooleanType):
            fills[field.name] = F.coalesce(c, F.lit(False))
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            zero = F.lit(0).cast(field.dataType)
            fills[field.name] = F.coalesce(F.nanvl(c, zero), zero)
        elif isinstance(field.dataType, T.NumericType):
            fills[field.name] = F.coalesce(c, F.lit(0).cast(field.dataType))
    return df.withColumns(fills) if fills else df


def enforce_types(df: DataFrame, schema: Mapping[str, str] | None) -> DataFrame:
    """Cast columns to the named types; absent columns are skipped, a bad value raises (ANSI)."""
    casts = {
        c: named(c).cast(TYPE_NAMES.get(t, t)) for c, t in (schema or {}).items() if c in df.columns
    }
    return df.withColumns(casts) if casts else df


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``.

    ``max_by`` aggregates on the map side first, so of a key holding a third of all rows each
    map task sends one row. ``dropDuplicates`` would keep an arbitrary row instead.
    """
    require(df, *keys, *order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    last = F.max_by(F.struct(*map(named, rest)), F.struct(*map(named, order))).alias("_last")
    grouped = df.groupBy(*map(named, keys)).agg(last)
    return grouped.select(
        *[named(c) if c in keys else F.col("_last")[c].alias(c) for c in df.columns]
    )


def clean(
    df: DataFrame,
    schema: Mapping[str, str] | None = None,
    dedup_columns: list[str] | None = None,
    transforms: Mapping[str, Callable] | None = None,
    order: Iterable[str] = (),
) -> DataFrame:
    """The whole cleaning contract; ``order`` names the columns that say which row is last."""
    order = list(order)
    filled = fill_nulls(apply_transforms(df, transforms), skip=["_source_file", *order])
    typed = enforce_types(filled, schema)
    return keep_last(typed, dedup_columns, order) if dedup_columns else typed
