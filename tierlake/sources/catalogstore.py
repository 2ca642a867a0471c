"""The catalog as append-only Parquet logs next to the layers."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.operators import catalog as C
from tierlake.sources.folders import exists
from tierlake.sources.snapshots import latest_snapshot


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()
LOGS = {
    "tables": _struct(name=_S, layer=_S, location=_S, partition_keys=T.ArrayType(_S), description=_S, seq=_L),
    "columns": _struct(table_name=_S, layer=_S, column_name=_S, data_type=_S, description=_S,
                       is_nullable=_B, is_partition_key=_B, seq=_L),
    "column_stats": _struct(table_name=_S, layer=_S, column_name=_S, row_count=_L, null_count=_L,
                            distinct_count=_L, min_value=_S, max_value=_S, seq=_L),
    "schema_versions": _struct(table_name=_S, layer=_S, version=_S, schema=T.MapType(_S, _S), seq=_L),
    "lineage": _struct(source_table=_S, source_layer=_S, target_table=_S, target_layer=_S, transformation=_S, seq=_L),
}


class Catalog:
    """Tables, columns, statistics, schema versions and lineage; ``seq`` is nanoseconds of the entry."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root
        self._last = 0

    def log(self, name: str) -> DataFrame:
        path = f"{self.root}/_catalog/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], LOGS[name])
        return self.spark.read.schema(LOGS[name]).parquet(path)

    def _seq(self) -> int:
        self._last = max(self._last + 1, time.time_ns())
        return self._last

    def append(self, name: str, rows: DataFrame | list[dict]) -> None:
        """Add entries; a list gets the next ``seq`` values."""
        if isinstance(rows, list):
            schema = LOGS[name]
            complete = [{**r, "seq": self._seq()} for r in rows]
            rows = self.spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in complete], schema).coalesce(1)
        rows.select(*LOGS[name].names).write.mode("append").parquet(f"{self.root}/_catalog/{name}")

    def tables(self) -> DataFrame:
        return C.current_tables(self.log("tables"))

    def columns(self) -> DataFrame:
        return C.current_columns(self.log("columns"))

    def _require_table(self, table: str, layer: str) -> None:
        known = self.log("tables").where((F.col("name") == table) & (F.col("layer") == layer))
        if known.isEmpty():
            raise ValueError(f"Table {layer}.{table} not found")

    def register_table(self, name: str, layer: str, location: str,
                       partition_keys: list[str] | None = None, description: str = "") -> None:
        self.append("tables", [dict(name=name, layer=layer, location=location, partition_keys=partition_keys,
                                    description=description)])

    def register_column(self, table: str, layer: str, column: str, data_type: str, description: str = "",
                        is_nullable: bool = True, is_partition_key: bool = False) -> None:
        self._require_table(table, layer)
        self.append("columns", [dict(table_name=table, layer=layer, column_name=column, data_type=data_type,
                                     description=description, is_nullable=is_nullable,
                                     is_partition_key=is_partition_key)])

    def update_column_stats(self, table: str, layer: str, df: DataFrame, columns: list[str] | None = None) -> None:
        """Compute and store the statistics of registered columns of ``df``."""
        wanted = columns or df.columns
        mine = self.log("columns").where((F.col("table_name") == table) & (F.col("layer") == layer))
        known = {r[0] for r in mine.select("column_name").distinct().collect()}
        absent = [c for c in wanted if c not in known]
        if absent:
            raise ValueError(f"Column {', '.join(absent)} not found in {layer}.{table}")
        stats = C.column_statistics(df, wanted).withColumns({
            "table_name": F.lit(table), "layer": F.lit(layer), "seq": F.lit(self._seq())})
        self.append("column_stats", stats.coalesce(1))  # one row per column

    def column_stats(self) -> DataFrame:
        """The latest statistics of each column."""
        rest = [f for f in LOGS["column_stats"].names if f not in (*C.COLUMN_KEY, "seq")]
        newest = self.log("column_stats").groupBy(*C.COLUMN_KEY).agg(F.max_by(F.struct(*rest), "seq").alias("_now"))
        return newest.select(*C.COLUMN_KEY, "_now.*")

    def add_schema_version(self, table: str, layer: str, version: str, schema: dict[str, str]) -> None:
        self._require_table(table, layer)
        self.append("schema_versions", [dict(table_name=table, layer=layer, version=version, schema=schema)])

    def schema_versions(self, table: str, layer: str) -> DataFrame:
        return C.versions_of(self.log("schema_versions"), table, layer)

    def register_schema(self, table: str, layer: str, schema: dict[str, str], version: str | None = None) -> str:
        """Add a version (``{count + 1}.0`` by default) and register its columns."""
        if version is None:
            version = f"{self.schema_versions(table, layer).count() + 1}.0"
        self.add_schema_version(table, layer, version, schema)
        self.append("columns", [
            dict(table_name=table, layer=layer, column_name=c, data_type=t, description="", is_nullable=True,
                 is_partition_key=False) for c, t in schema.items()])
        return version

    def compare_schemas(self, table: str, layer: str, version_a: str, version_b: str) -> dict[str, Any]:
        log = self.log("schema_versions").where((F.col("table_name") == table) & (F.col("layer") == layer))
        known = {r[0] for r in log.select("version").distinct().collect()}
        for version in (version_a, version_b):
            if version not in known:
                raise ValueError(f"Version {version} not found")
        changes = C.compare_versions(log, version_a, version_b).collect()
        named = {k: sorted(r["column_name"] for r in changes if r["change"] == k) for k in ("added", "removed")}
        retyped = {r["column_name"]: {"from": r["from_type"], "to": r["to_type"]}
                   for r in changes if r["change"] == "type_changed"}
        return {**named, "type_changed": retyped, "is_compatible": not named["removed"] and not retyped}

    def latest_schema(self, table: str, layer: str) -> dict[str, str] | None:
        mine = (F.col("table_name") == table) & (F.col("layer") == layer)
        row = C.latest_schemas(self.log("schema_versions").where(mine)).first()
        return row["schema"] if row else None

    def add_lineage(self, source_table: str, source_layer: str, target_table: str, target_layer: str,
                    transformation: str = "") -> None:
        edge = [dict(source_table=source_table, source_layer=source_layer, target_table=target_table,
                     target_layer=target_layer, transformation=transformation, seq=0)]
        schema = LOGS["lineage"]
        frame = self.spark.createDataFrame([tuple(e[f] for f in schema.names) for e in edge], schema)
        if C.known_edges(frame, self.log("tables")).isEmpty():
            raise ValueError("Source or target table not found in catalog")
        self.append("lineage", edge)

    def lineage(self, table: str, layer: str) -> dict[str, list[dict]]:
        found = C.neighbours(self.log("lineage"), table, layer).collect()
        return {d: [{"name": r["name"], "layer": r["layer"]} for r in found if r["direction"] == d]
                for d in ("upstream", "downstream")}

    def search(self, term: str) -> DataFrame:
        return C.search(self.tables(), self.columns(), term)

    def publish(self, layer: str, table: str, sources: list[tuple[str, str]] = (), description: str = "",
                transformation: str = "") -> str:
        """Register the newest snapshot: table, schema version, column statistics, lineage.

        A schema equal to the latest one is not added again. ``sources`` are (table, layer).
        """
        location = latest_snapshot(self.spark, self.root, layer, table)
        df = self.spark.read.parquet(location)
        self.register_table(table, layer, location, description=description)
        schema = dict(df.dtypes)
        if self.latest_schema(table, layer) != schema:
            self.register_schema(table, layer, schema)
        self.update_column_stats(table, layer, df)
        for source_table, source_layer in sources:
            self.add_lineage(source_table, source_layer, table, layer, transformation)
        return location
