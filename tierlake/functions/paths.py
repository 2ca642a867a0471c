"""Date and source partitions: building object keys, parsing them, pruning by them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTITIONS = ("source", "year", "month", "day")


def partition_values(ts: Column | None = None) -> dict[str, Column]:
    """Year, two-digit month and two-digit day of ``ts`` (now by default), as path text."""
    at = F.current_timestamp() if ts is None else ts
    return {
        "year": F.lpad(F.year(at).cast("string"), 4, "0"),
        "month": F.lpad(F.month(at).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(at).cast("string"), 2, "0"),
    }


def object_key(
    layer: str | Column,
    table: str | Column,
    filename: Column,
    ts: Column | None = None,
    source: Column | None = None,
) -> Column:
    """``layer/table/[source=S/]year=Y/month=M/day=D/filename``; no or empty source, no part."""
    day = partition_values(ts)
    dated = [F.concat(F.lit(f"{name}="), value) for name, value in day.items()]
    parts = [F.lit(layer) if isinstance(layer, str) else layer,
             F.lit(table) if isinstance(table, str) else table]
    if source is not None:  # concat_ws skips the null of a missing source
        parts.append(F.when(source != "", F.concat(F.lit("source="), source)))
    return F.concat_ws("/", *parts, *dated, filename)


def parse_key(key: Column) -> dict[str, Column]:
    """Layer, table, integer date parts, all ``k=v`` folders as a map, and the file name."""
    parts = F.split(key, "/")
    folders = F.filter(F.slice(parts, 3, F.greatest(F.size(parts) - 3, F.lit(0))), lambda p: p.contains("="))
    pairs = F.map_from_entries(F.transform(folders, lambda p: F.struct(
        F.substring_index(p, "=", 1).alias("key"), F.regexp_replace(p, "^[^=]*=", "").alias("value"))))
    return {
        "layer": F.get(parts, 0),
        "table": F.get(parts, 1),
        "source": pairs["source"],
        "year": pairs["year"].cast("int"),
        "month": pairs["month"].cast("int"),
        "day": pairs["day"].cast("int"),
        "partitions": pairs,
        "filename": F.element_at(parts, -1),
    }


def as_date(value: date | datetime | None) -> date | None:
    return value.date() if isinstance(value, datetime) else value


def partition_filter(
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    source: str | None = None,
) -> Column:
    """Exact inclusive day range and source, on partition columns only, so that Spark prunes.

    The bare year bounds are implied by the dates; they let a metastore prune as well.
    """
    day = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int"))
    keep = F.lit(True)
    if source:
        keep = keep & (F.col("source") == source)
    if start is not None:
        keep = keep & (F.col("year") >= as_date(start).year) & (day >= F.lit(as_date(start)))
    if end is not None:
        keep = keep & (F.col("year") <= as_date(end).year) & (day <= F.lit(as_date(end)))
    return keep
