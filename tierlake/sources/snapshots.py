"""Silver and gold tables: one immutable Parquet folder per run, readers take the newest."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.functions.columns import named
from tierlake.sources.folders import exists, subfolders

SNAPSHOT = "snapshot_ts="


def snapshot_id(at: datetime | None = None) -> str:
    """UTC instant whose text order is its time order."""
    return (at or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S_%fZ")


def write_snapshot(
    df: DataFrame,
    root: str,
    layer: str,
    table: str,
    tags: dict[str, str] | None = None,
    at: datetime | None = None,
    row_group_rows: int | None = None,
    max_rows_per_file: int = 0,
) -> dict:
    """Write a new snapshot and its tags; what is being read is never overwritten.

    The tags are written last and mark the snapshot complete: a run that dies half way leaves
    a folder no reader takes. The row count is read from the Parquet footers, so retried
    tasks cannot count twice.
    """
    spark = df.sparkSession
    moment = at or datetime.now(timezone.utc)
    folder = f"{root}/{layer}/{table}/{SNAPSHOT}{snapshot_id(moment)}"
    writer = df.write.mode("errorifexists").option("compression", "snappy")
    if row_group_rows:
        writer = writer.option("parquet.block.row.count.limit", row_group_rows)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(folder)
    rows = spark.read.parquet(folder).count()
    marks = {**(tags or {}), "row_count": str(rows), "created_at": moment.isoformat()}
    spark.range(1).select(F.lit(json.dumps(marks)).alias("value")).coalesce(1).write.text(f"{folder}/_tags")
    return {"location": folder, "row_count": rows, "timestamp": moment, "tags": marks}


def latest_snapshot(spark: SparkSession, root: str, layer: str, table: str) -> str:
    """Folder of the newest complete snapshot."""
    base = f"{root}/{layer}/{table}"
    for name in reversed(subfolders(spark, base)):
        if name.startswith(SNAPSHOT) and exists(spark, f"{base}/{name}/_tags"):
            return f"{base}/{name}"
    raise ValueError(f"No {layer} data found for {table}")


def read_latest(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """Rows of the newest snapshot; older snapshot folders are not even listed."""
    return spark.read.parquet(latest_snapshot(spark, root, layer, table))


def snapshot_tags(spark: SparkSession, folder: str) -> dict[str, str]:
    return json.loads(spark.read.text(f"{folder}/_tags").first()["value"])


def latest_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows with the greatest value of ``column``; the scalar subquery is pushed to the scan."""
    newest = df.select(F.max(named(column))).scalar()
    return df.where(named(column) == newest)
