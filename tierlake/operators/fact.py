"""Facts: foreign-key lookups and grouped aggregates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.columns import missing, named, present, require
from tierlake.operators.joins import lookup_join
from tierlake.operators.quantiles import exact_median

AGGREGATES = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "avg": F.avg,
    "mean": F.avg,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "nunique": F.count_distinct,
    "std": F.stddev_samp,
    "var": F.var_samp,
}
ORDERED = {"first": F.min_by, "last": F.max_by}


def lookup_key(
    fact: DataFrame, dim: DataFrame, lookup: str, foreign_key: str, surrogate_key: str | None = None
) -> DataFrame:
    """Add ``foreign_key``: the dimension's key for the fact's ``lookup`` value, else null.

    The row count never changes: of several dimension rows with one value the greatest key,
    that of the last row, wins. The key must be the dimension's first column.
    """
    key = surrogate_key or dim.columns[0]
    require(fact, lookup)
    require(dim, lookup, key)
    if key == lookup or not isinstance(dim.schema[key].dataType, T.IntegralType):
        raise ValueError("the dimension needs an integer surrogate key in its first column")
    table = (
        dim.where(named(lookup).isNotNull())
        .groupBy(named(lookup).alias("_lookup")).agg(F.max(named(key)).alias("_found"))
    )
    joined = lookup_join(fact.withColumn("_lookup", named(lookup)), table, ["_lookup"], "left")
    return joined.withColumn(foreign_key, F.col("_found")).drop("_lookup", "_found")


def _aggregate(df: DataFrame, measure: str, how: str, order_by: str | None) -> Column:
    value = present(df, measure)
    if how in AGGREGATES:
        return AGGREGATES[how](value).alias(measure)
    if how in ORDERED and order_by:
        at = F.when(value.isNotNull(), F.struct(named(order_by)))
        return ORDERED[how](value, at).alias(measure)
    if how in ORDERED:
        raise ValueError(f"aggregate {how!r} needs order_by")
    raise ValueError(f"unknown aggregate: {how}")


def aggregate(
    df: DataFrame,
    group_by: list[str],
    aggregations: Mapping[str, str],
    order_by: str | None = None,
) -> DataFrame:
    """Aggregate measures by ``group_by``; each keeps its name.

    Rows with a null group key are dropped, nulls and NaN are ignored, the sum of nothing is
    0, measures the table lacks are dropped. ``first`` and ``last`` follow ``order_by``.
    """
    require(df, *group_by)
    wanted = {m: how for m, how in aggregations.items() if m in df.columns}
    if not wanted:
        return df
    kept = df
    for key in group_by:
        kept = kept.where(~missing(df, key))
    plain = {m: how for m, how in wanted.items() if how != "median"}
    keys = [named(k) for k in group_by]
    grouped = kept.groupBy(*keys)
    result = (
        grouped.agg(*[_aggregate(df, m, how, order_by) for m, how in plain.items()])
        if plain else kept.select(*keys).distinct()
    )
    for measure, how in wanted.items():
        if how == "median":  # one row per group on both sides
            result = result.join(exact_median(kept, group_by, measure, measure), group_by, "left")
    return result.select(*keys, *map(named, wanted))


def fact(
    df: DataFrame,
    lookups: Mapping[str, tuple[DataFrame, str, str]] | None = None,
    aggregations: Mapping[str, str] | None = None,
    group_by: list[str] | None = None,
    order_by: str | None = None,
) -> DataFrame:
    """Key lookups, then the aggregate when both aggregations and group keys are given.

    ``lookups`` maps a dimension name to (dimension, lookup column, foreign key column);
    ``order_by`` is the column that ``first`` and ``last`` follow.
    """
    for dim, lookup, foreign_key in (lookups or {}).values():
        df = lookup_key(df, dim, lookup, foreign_key)
    return aggregate(df, group_by, aggregations, order_by) if aggregations and group_by else df
