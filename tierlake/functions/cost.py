"""Monthly cost of workloads, one row per workload."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# List prices in US dollars.
PRICES = {
    "storage_gb": 0.023,
    "put_per_1k": 0.005,
    "get_per_1k": 0.0004,
    "transfer_gb": 0.09,
    "dpu_hour": 0.44,
    "scanned_tb": 5.00,
    "invocations_per_million": 0.20,
    "gb_second": 0.0000166667,
}
# Inputs by section, with what an absent one stands for when its section is present.
SECTIONS = {
    "data_volume": {"bronze_gb": 0.0, "silver_gb": 0.0, "gold_gb": 0.0},
    "query_pattern": {"queries_per_month": 0.0, "avg_data_scanned_gb": 0.0},
    "etl_pattern": {"runs_per_month": 0.0, "avg_duration_minutes": 0.0, "dpu_count": 2.0},
    "lambda_pattern": {"invocations_per_month": 0.0, "avg_duration_ms": 100.0, "memory_mb": 128.0},
    "s3_requests": {"put": 0.0, "get": 0.0},
    "other": {"data_transfer_out_gb": 0.0},
}
# What one added query scans (GB) and one added run takes (DPU hours).
ADDED_QUERY_GB = 0.1
ADDED_RUN_DPU_HOURS = 0.5
PARTS = ("storage", "requests", "transfer", "etl", "queries", "compute")


def with_defaults(workloads: DataFrame) -> DataFrame:
    """All input columns as doubles. A section with no value at all costs nothing."""
    columns = {}
    for inputs in SECTIONS.values():
        known = [F.col(c) for c in inputs if c in workloads.columns]
        given = F.coalesce(*[c.cast("double") for c in known]).isNotNull() if known else F.lit(False)
        for name, default in inputs.items():
            value = F.col(name).cast("double") if name in workloads.columns else F.lit(None).cast("double")
            columns[name] = F.when(given, F.coalesce(value, F.lit(default))).otherwise(F.lit(0.0))
    return workloads.withColumns(columns)


def usage(workloads: DataFrame) -> DataFrame:
    """Add total_gb, scanned_tb, dpu_hours and gb_seconds."""
    return workloads.withColumns({
        "total_gb": F.col("bronze_gb") + F.col("silver_gb") + F.col("gold_gb"),
        "scanned_tb": F.col("queries_per_month") * F.col("avg_data_scanned_gb") / 1024,
        "dpu_hours": F.col("runs_per_month") * F.col("avg_duration_minutes") / 60 * F.col("dpu_count"),
        "gb_seconds": F.col("invocations_per_month") * F.col("avg_duration_ms") / 1000 * (F.col("memory_mb") / 1024),
    })


def _total(df: DataFrame) -> DataFrame:
    total = F.lit(0.0)
    for part in PARTS:
        total = total + F.col(part)
    return df.withColumn("total", total)


def breakdown(workloads: DataFrame, prices: Mapping[str, float] | None = None) -> DataFrame:
    """Add the cost of each part and their total, unrounded."""
    p = {**PRICES, **(prices or {})}
    used = usage(with_defaults(workloads))
    return _total(used.withColumns({
        "storage": F.col("total_gb") * p["storage_gb"],
        "requests": F.col("put") / 1000 * p["put_per_1k"] + F.col("get") / 1000 * p["get_per_1k"],
        "transfer": F.col("data_transfer_out_gb") * p["transfer_gb"],
        "etl": F.col("dpu_hours") * p["dpu_hour"],
        "queries": F.col("scanned_tb") * p["scanned_tb"],
        "compute": F.col("invocations_per_month") / 1e6 * p["invocations_per_million"]
        + F.col("gb_seconds") * p["gb_second"],
    }))


def report(costs: DataFrame) -> DataFrame:
    """Costs rounded to cents, with the storage service subtotal; rounding comes last."""
    stored = F.col("storage") + F.col("requests") + F.col("transfer")
    return costs.withColumn("storage_subtotal", F.round(stored, 2)).withColumns(
        {name: F.round(name, 2) for name in (*PARTS, "total")})


def what_if(
    costs: DataFrame,
    added_gb: Column | float,
    added_queries: Column | float = 0,
    added_runs: Column | float = 0,
    prices: Mapping[str, float] | None = None,
) -> DataFrame:
    """Cost of adding a source to each workload, and the increase in percent (0 over a zero base)."""
    p = {**PRICES, **(prices or {})}

    def lit(value: Column | float) -> Column:
        return value if isinstance(value, Column) else F.lit(float(value))

    storage = lit(added_gb) * p["storage_gb"]
    queries = lit(added_queries) * ADDED_QUERY_GB / 1024 * p["scanned_tb"]
    etl = lit(added_runs) * ADDED_RUN_DPU_HOURS * p["dpu_hour"]
    added, base = storage + queries + etl, F.col("total")
    return costs.withColumns({
        "current_cost": F.round(base, 2),
        "added_storage": F.round(storage, 2),
        "added_queries": F.round(queries, 2),
        "added_etl": F.round(etl, 2),
        "additional_cost": F.round(added, 2),
        "new_total": F.round(base + added, 2),
        "percent_increase": F.when(base > 0, F.round(added / base * 100, 1)).otherwise(F.lit(0.0)),
    })


def workload_from_config(spark: SparkSession, config: Mapping) -> DataFrame:
    """One workload row from a nested configuration; absent sections stay null."""
    values = {}
    for section, inputs in SECTIONS.items():
        given = config if section == "other" else (config.get(section) or {})
        present = any(name in given for name in inputs) or (section != "other" and section in config)
        for name, default in inputs.items():
            values[name] = float(given.get(name, default)) if present else None
    columns = [F.lit(v).cast("double").alias(k) for k, v in values.items()]
    return spark.range(1).select(*columns)
