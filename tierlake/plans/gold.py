"""Silver to gold: dimension and fact tables from the newest snapshots."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tierlake.operators.dimension import dimension
from tierlake.operators.fact import fact
from tierlake.sources.snapshots import read_latest, write_snapshot


def _write(df: DataFrame, root: str, table: str, table_type: str, at: datetime | None, row_group_rows: int) -> dict:
    written = write_snapshot(df, root, "gold", table, {"table_type": table_type}, at, row_group_rows)
    return {"location": written["location"], "row_count": written["row_count"], "table_type": table_type}


def create_dimension_table(
    spark: SparkSession,
    root: str,
    dim_name: str,
    source_table: str,
    columns: list[str],
    surrogate_key: str | None = None,
    first_seen_by: str | None = None,
    at: datetime | None = None,
    row_group_rows: int = 0,
) -> dict:
    """Distinct tuples of a silver table, numbered 1..N when a surrogate key is named."""
    silver = read_latest(spark, root, "silver", source_table)
    return _write(dimension(silver, columns, surrogate_key, first_seen_by), root, dim_name, "dimension", at, row_group_rows)


def create_fact_table(
    spark: SparkSession,
    root: str,
    fact_name: str,
    source_table: str,
    measures: list[str] | None = None,
    dimension_keys: Mapping[str, tuple[str, str]] | None = None,
    aggregations: Mapping[str, str] | None = None,
    group_by: list[str] | None = None,
    order_by: str | None = None,
    at: datetime | None = None,
    row_group_rows: int = 0,
) -> dict:
    """Silver rows with foreign keys, grouped when aggregations and group keys are given.

    ``dimension_keys`` maps a gold dimension to (lookup column, foreign key column). ``measures``
    is a list to validate only: columns named there must be aggregated when it is given.
    ``order_by`` is the column that ``first`` and ``last`` follow. Row groups are sized by bytes
    unless ``row_group_rows`` is given.
    """
    if measures and aggregations:
        unlisted = sorted(set(aggregations) - set(measures))
        if unlisted:
            raise ValueError(f"aggregated columns not listed as measures: {', '.join(unlisted)}")
    silver = read_latest(spark, root, "silver", source_table)
    lookups = {
        dim: (read_latest(spark, root, "gold", dim), lookup, foreign_key)
        for dim, (lookup, foreign_key) in (dimension_keys or {}).items()
    }
    return _write(fact(silver, lookups, aggregations, group_by, order_by), root, fact_name, "fact", at, row_group_rows)
