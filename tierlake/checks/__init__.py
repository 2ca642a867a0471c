"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def all_checks() -> dict[str, Check]:
    from tierlake.checks import (
        catalog, cost, gold, hard_cases, landing, metrics, quality, silver, sql_surface, streaming,
    )

    found: dict[str, Check] = {}
    for module in (landing, silver, gold, quality, metrics, sql_surface, catalog, cost, streaming, hard_cases):
        found.update(module.CHECKS)
    return found
