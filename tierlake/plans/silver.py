"""Bronze to silver as one job per table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tierlake.operators.cleaning import clean
from tierlake.sources.landing import FILE_ORDER, read_bronze
from tierlake.sources.records import parse_records
from tierlake.sources.snapshots import write_snapshot


def process_table(
    spark: SparkSession,
    root: str,
    table: str,
    schema: Mapping[str, str] | None = None,
    dedup_columns: list[str] | None = None,
    transformations: Mapping[str, Callable] | None = None,
    start_date: date | datetime | None = None,
    end_date: date | datetime | None = None,
    source: str | None = None,
    read_schema: T.StructType | None = None,
    at: datetime | None = None,
) -> dict:
    """Clean the landed records of a table into a new silver snapshot.

    ``schema`` names the types to enforce after filling; ``read_schema`` skips inference. The
    row counts come from Parquet footers, not from counters a retried task could bump twice.
    """
    records = read_bronze(spark, root, table, start_date, end_date, source)
    taken = records.count()
    if taken == 0:
        return {"status": "no_data", "records_in": 0, "records_out": 0}
    parsed = parse_records(records, read_schema)
    cleaned = clean(parsed, schema, dedup_columns, transformations, FILE_ORDER).drop(*FILE_ORDER)
    written = write_snapshot(cleaned, root, "silver", table, {"records_in": str(taken), "schema_version": "1.0"}, at)
    kept = written["row_count"]
    return {
        "location": written["location"],
        "records_in": taken,
        "records_out": kept,
        "duplicates_removed": taken - kept,
        "processing_timestamp": written["timestamp"],
    }
