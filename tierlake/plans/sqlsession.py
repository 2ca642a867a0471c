"""SQL over the newest snapshots of all layers."""

from __future__ import annotations

import logging
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tierlake.sources import results
from tierlake.sources.folders import subfolders
from tierlake.sources.landing import read_bronze
from tierlake.sources.snapshots import read_latest

logger = logging.getLogger(__name__)
LAYERS = ("bronze", "silver", "gold")
DEFAULT_LIMIT = 100


class SqlSession:
    """Registers layer tables as views and runs Spark SQL on them; views read nothing by themselves."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root
        self._views: set[str] = set()

    def register_table(self, layer: str, table: str, alias: str | None = None) -> str:
        """View ``layer_table`` (or ``alias``) over the newest snapshot, or over a bronze table."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        if layer == "bronze":
            if table not in subfolders(self.spark, f"{self.root}/bronze"):
                raise ValueError(f"No bronze data found for {table}")
            rows = read_bronze(self.spark, self.root, table)
        else:
            rows = read_latest(self.spark, self.root, layer, table)
        view = re.sub(r"[.-]", "_", alias or f"{layer}_{table}")
        rows.createOrReplaceTempView(view)
        self._views.add(view)
        return view

    def register_all_tables(self) -> list[str]:
        """Register every table of every layer; one that cannot be read is skipped."""
        done = []
        for layer in LAYERS:
            for table in subfolders(self.spark, f"{self.root}/{layer}"):
                try:
                    done.append(self.register_table(layer, table))
                except Exception as error:
                    logger.warning("could not register %s.%s: %s", layer, table, error)
        return done

    def query(self, text: str, limit: int = 0) -> DataFrame:
        """Lazy result; ``limit`` bounds it without touching the text (0 is no bound)."""
        frame = self.spark.sql(text)
        return frame.limit(limit) if limit > 0 else frame

    def preview(self, text: str, limit: int = DEFAULT_LIMIT) -> DataFrame:
        """First rows only; an ``ORDER BY`` with this limit runs as one top-k."""
        return self.query(text, limit)

    def query_rows(self, text: str, limit: int = 0) -> list[dict]:
        """Collected rows: whole by default, so bound big results or write them to files."""
        return results.rows(self.query(text), limit)

    def query_df(self, text: str, limit: int = 0) -> pd.DataFrame:
        return results.to_pandas(self.query(text), limit)

    def query_arrow(self, text: str, limit: int = 0) -> pa.Table:
        return results.to_arrow(self.query(text), limit)

    def explain(self, text: str) -> str:
        """The physical plan."""
        return self.spark.sql(f"EXPLAIN FORMATTED {text}").first()[0]

    def list_tables(self) -> list[str]:
        return sorted(self._views)

    def close(self) -> None:
        """Drop the registered views; the Spark session stays the caller's."""
        for view in self._views:
            self.spark.catalog.dropTempView(view)
        self._views.clear()
