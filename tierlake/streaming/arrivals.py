"""Incremental bronze to silver: each arrival is cleaned once and merged when read."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierlake.operators.cleaning import clean, keep_last
from tierlake.sources.folders import exists, subfolders
from tierlake.sources.landing import BRONZE_SCHEMA, FILE_ORDER, bronze_path
from tierlake.sources.records import parse_records
from tierlake.sources.snapshots import write_snapshot

# folder names without "=", so that Spark sees no partition column in them
BATCH = "batch-"
COMPACTED = "compacted-"


def arrivals_path(root: str, table: str) -> str:
    return f"{root}/silver_arrivals/{table}"


def start(
    spark: SparkSession,
    root: str,
    table: str,
    read_schema: T.StructType,
    checkpoint: str,
    schema: Mapping[str, str] | None = None,
    dedup_columns: list[str] | None = None,
    transformations: Mapping[str, Callable] | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Clean the records that arrived in bronze since the last run, then stop.

    A micro-batch writes its own rows into its own folder, so its cost follows the arrival and
    not the table, and a replayed batch overwrites what it wrote before. The columns that say
    which row is last stay in these rows; ``current`` merges the batches.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_records(batch, read_schema)
        cleaned = clean(parsed, schema, dedup_columns, transformations, FILE_ORDER)
        cleaned.write.mode("overwrite").parquet(f"{arrivals_path(root, table)}/{BATCH}{batch_id:012d}")

    stream = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        stream.parquet(bronze_path(root, table))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _live_folders(spark: SparkSession, root: str, table: str) -> list[str]:
    """The newest complete compacted folder and the complete batches after it.

    Names are compared first, so only live folders are asked whether they are complete.
    """
    base = arrivals_path(root, table)
    names = subfolders(spark, base)

    def complete(name: str) -> bool:
        return exists(spark, f"{base}/{name}/_SUCCESS")

    compacted = next(filter(complete, reversed([n for n in names if n.startswith(COMPACTED)])), None)
    last = compacted.removeprefix(COMPACTED) if compacted else ""
    later = [n for n in names if n.startswith(BATCH) and n.removeprefix(BATCH) > last]
    return [compacted] * bool(compacted) + [n for n in later if complete(n)]


def merged(spark: SparkSession, root: str, table: str, dedup_columns: list[str] | None) -> DataFrame:
    """All arrivals, the last row per key kept, order columns included."""
    folders = _live_folders(spark, root, table)
    if not folders:
        raise ValueError(f"No silver data found for {table}")
    rows = spark.read.parquet(*[f"{arrivals_path(root, table)}/{f}" for f in folders])
    return keep_last(rows, dedup_columns, list(FILE_ORDER)) if dedup_columns else rows


def compact(spark: SparkSession, root: str, table: str, dedup_columns: list[str] | None) -> str:
    """Merge all arrivals so far into one folder; readers then skip the batches inside it.

    Run it now and then between streams: it bounds what ``current`` has to merge. The result
    of ``current`` does not change.
    """
    last = _live_folders(spark, root, table)[-1:]
    rows = merged(spark, root, table, dedup_columns)
    through = last[0].removeprefix(BATCH).removeprefix(COMPACTED)
    if last[0].startswith(COMPACTED):
        return last[0]
    rows.write.mode("overwrite").parquet(f"{arrivals_path(root, table)}/{COMPACTED}{through}")
    return f"{COMPACTED}{through}"


def current(spark: SparkSession, root: str, table: str, dedup_columns: list[str] | None = None) -> DataFrame:
    """The table as a batch run over all arrivals would write it."""
    return merged(spark, root, table, dedup_columns).drop(*FILE_ORDER)


def publish_snapshot(
    spark: SparkSession, root: str, table: str, dedup_columns: list[str] | None = None, at: datetime | None = None
) -> dict:
    """Write ``current`` as a silver snapshot, so that gold and SQL readers see the arrivals."""
    return write_snapshot(current(spark, root, table, dedup_columns), root, "silver", table, {"schema_version": "1.0"}, at)
