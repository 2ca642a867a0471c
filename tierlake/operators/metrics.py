"""Operational metrics over layer tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions.columns import named

# The checks that make up the quality matrix.
MATRIX_CHECKS = ("null_rate", "uniqueness", "value_range", "schema_match", "freshness", "referential_integrity")
SERVICES = ("storage", "requests", "transfer", "etl", "queries", "compute")


def table_health(df: DataFrame, table: str, layer: str, updated: str, size_mb: Column | None = None) -> DataFrame:
    """Row count and newest ``updated`` of one table; the size comes from ``stored_mb``."""
    return df.agg(
        F.lit(table).alias("table"), F.lit(layer).alias("layer"), F.count(F.lit(1)).alias("record_count"),
        (F.lit(None).cast("double") if size_mb is None else size_mb).alias("size_mb"),
        F.max(named(updated)).cast("timestamp_ntz").alias("last_updated"))


def stored_mb(spark, path: str) -> float:
    """Megabytes of the Parquet files under ``path``, from file metadata only."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)) / (1 << 20)).first()[0]


def layer_health(tables: Iterable[DataFrame]) -> DataFrame:
    """Union of ``table_health`` rows."""
    frames = list(tables)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def quality_matrix(scores: DataFrame, checks: Iterable[str] = MATRIX_CHECKS) -> DataFrame:
    """Rows ``table, check, score`` as one row per table and one column per check."""
    return scores.groupBy("table").pivot("check", list(checks)).agg(F.max("score"))


def daily_throughput(df: DataFrame, ts: str, size: Column | None = None) -> DataFrame:
    """Records per day, with the summed ``size`` when given."""
    grouped = df.groupBy(F.to_date(named(ts)).alias("date"))
    records = F.count(F.lit(1)).alias("records_ingested")
    return grouped.agg(records) if size is None else grouped.agg(records, F.sum(size).alias("size"))


def summary(health: DataFrame, results: DataFrame, costs: DataFrame) -> DataFrame:
    """One row: gold rows, share of passed checks, tables tracked, monthly cost.

    ``costs`` holds ``monthly_cost``. Each input is reduced to one row before they meet.
    """
    totals = health.agg(
        F.coalesce(F.sum(F.when(F.col("layer") == "gold", F.col("record_count"))), F.lit(0)).alias("gold_records"),
        F.count_distinct("table").alias("tables_tracked"))
    rate = results.agg(F.avg(F.col("passed").cast("int")).alias("pass_rate"))
    cost = costs.agg(F.sum("monthly_cost").alias("monthly_cost"))
    return totals.select("*", rate.scalar().alias("pass_rate"), cost.scalar().alias("monthly_cost"))


def cost_share(breakdown: DataFrame, services: Iterable[str] = SERVICES) -> DataFrame:
    """Cost per service over all workloads, and its share of the total."""
    names = list(services)
    totals = breakdown.agg(*[F.sum(named(n)).alias(n) for n in names])
    pairs = F.array(*[F.struct(F.lit(n).alias("service"), named(n).alias("monthly_cost")) for n in names])
    listed = totals.select(F.explode(pairs).alias("p")).select("p.*")
    whole = F.sum("monthly_cost").over(Window.partitionBy(F.lit(1)))  # one row per service
    return listed.withColumn("share", F.when(whole > 0, F.col("monthly_cost") / whole).otherwise(F.lit(0.0)))
