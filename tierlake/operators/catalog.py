"""Catalog logs (append only, ordered by ``seq``) and what they say now."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.columns import is_floating, present
from tierlake.operators.joins import lookup_join
from tierlake.session import materialize

DIGEST_BYTES = 32
NESTED = (T.ArrayType, T.StructType, T.MapType)
#: JSON that tells apart whatever differs: nulls are kept, times have all their digits.
WHOLE_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
              "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
TABLE_KEY = ("name", "layer")
COLUMN_KEY = ("table_name", "layer", "column_name")
VERSION_KEY = ("table_name", "layer")


def _latest(*names: str) -> Column:
    return F.max_by(F.struct(*names), F.col("seq")).alias("_now")


def current_tables(log: DataFrame) -> DataFrame:
    """Per name and layer the last registration, with the seq of the first and the last."""
    return log.groupBy(*TABLE_KEY).agg(
        _latest("location", "partition_keys", "description"),
        F.min("seq").alias("created_seq"), F.max("seq").alias("updated_seq"),
    ).select(*TABLE_KEY, "_now.*", "created_seq", "updated_seq")


def current_columns(log: DataFrame) -> DataFrame:
    """Per column the last type and description, but the flags of its first registration."""
    flags = ("is_nullable", "is_partition_key")
    return log.groupBy(*COLUMN_KEY).agg(
        _latest("data_type", "description"), F.min_by(F.struct(*flags), F.col("seq")).alias("_first"),
    ).select(*COLUMN_KEY, "_now.*", "_first.*")


def _digest(df: DataFrame, name: str) -> Column:
    """Binary that is equal exactly for equal values of a column; null where the value is missing.

    Below ``DIGEST_BYTES`` bytes it is the value written out, else its SHA-256, so the two never meet.
    """
    dtype, value = df.schema[name].dataType, present(df, name)
    if is_floating(dtype):
        value = value + F.lit(0.0)  # of the two zeros one
    elif isinstance(dtype, T.TimestampType):
        value = F.unix_micros(value)  # a time shown in a zone can stand for two
    elif isinstance(dtype, NESTED):
        value = F.to_json(value, WHOLE_JSON)
    if not isinstance(dtype, T.BinaryType):
        value = value.cast("string").cast("binary")
    return F.when(F.octet_length(value) < DIGEST_BYTES, value).otherwise(F.unhex(F.sha2(value, 256)))


def _bounds(df: DataFrame, name: str) -> tuple[Column, Column]:
    """Least and greatest value of a column as text; maps, which have no order, by their JSON."""
    dtype, value = df.schema[name].dataType, present(df, name)
    if isinstance(dtype, T.MapType):
        value = F.to_json(value)
    shown = F.to_json if isinstance(dtype, (T.ArrayType, T.StructType)) else lambda c: c.cast("string")
    return shown(F.min(value)), shown(F.max(value))


def _counted(df: DataFrame, wanted: list[str], seen: Observation) -> DataFrame:
    """(at, row_count, null_count, distinct_count) by the column's place; ``seen`` observes the bounds."""
    bounds = [bound for name in wanted for bound in _bounds(df, name)]
    pairs = df.observe(seen, *(b.alias(f"b{i}") for i, b in enumerate(bounds))).select(
        F.posexplode(F.array(*(_digest(df, name) for name in wanted))).alias("at", "digest"))
    return pairs.groupBy("at", "digest").agg(F.count(F.lit(1)).alias("n")).groupBy("at").agg(
        F.sum("n").alias("row_count"), F.coalesce(F.sum(F.when(F.col("digest").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("digest").alias("distinct_count"))


def column_statistics(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, nulls (NaN included), distinct values, least and greatest value of each column.

    One scan and two shuffles, however many columns there are: each row becomes (column number, digest of
    the value) pairs that are counted on the map side, then the distinct ones are counted per column. The
    bounds are observed beside that scan. So this runs a job; what reaches the driver is two values a column.
    An empty table has a row for each column, with zero counts.
    """
    wanted = list(dict.fromkeys(columns or df.columns))
    seen = Observation()
    totals = materialize(_counted(df, wanted, seen))
    found = seen.get if totals.head(1) else {}  # a plan without rows may observe nothing
    shown = df.sparkSession.createDataFrame(
        [(at, name, found.get(f"b{2 * at}"), found.get(f"b{2 * at + 1}")) for at, name in enumerate(wanted)],
        "at int, column_name string, min_value string, max_value string")
    count = {c: F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("row_count", "null_count", "distinct_count")}
    return shown.join(F.broadcast(totals), "at", "left").select("column_name", *count.values(), "min_value", "max_value")


def versions_of(log: DataFrame, table_name: str, layer: str) -> DataFrame:
    """Schema versions of a table in the order they were added."""
    mine = (F.col("table_name") == table_name) & (F.col("layer") == layer)
    return log.where(mine).select("version", "schema", "seq").orderBy("seq")


def latest_schemas(log: DataFrame) -> DataFrame:
    """The newest version and schema of every table."""
    return log.groupBy(*VERSION_KEY).agg(_latest("version", "schema")).select(*VERSION_KEY, "_now.*")


def _columns_of(log: DataFrame, version: str, type_name: str) -> DataFrame:
    newest = log.where(F.col("version") == version).groupBy(*VERSION_KEY).agg(F.max_by("schema", "seq").alias("schema"))
    return newest.select(*VERSION_KEY, F.explode("schema").alias("column_name", type_name))


def compare_versions(log: DataFrame, version_a: str, version_b: str) -> DataFrame:
    """Changed columns from version a to b, of every table that has both.

    ``change`` is added, removed or type_changed. Of a repeated version the last counts.
    """
    flags = log.groupBy(*VERSION_KEY).agg(
        F.bool_or(F.col("version") == version_a).alias("_a"), F.bool_or(F.col("version") == version_b).alias("_b"))
    both = flags.where("_a and _b").select(*VERSION_KEY)
    before, after = _columns_of(log, version_a, "from_type"), _columns_of(log, version_b, "to_type")
    change = (
        F.when(F.col("from_type").isNull(), "added")
        .when(F.col("to_type").isNull(), "removed")
        .when(F.col("from_type") != F.col("to_type"), "type_changed")
    )
    joined = before.join(after, [*VERSION_KEY, "column_name"], "full").withColumn("change", change)
    return joined.where(F.col("change").isNotNull()).join(both, [*VERSION_KEY], "left_semi").select(
        *VERSION_KEY, "column_name", "change", "from_type", "to_type")


def compatibility(changes: DataFrame) -> DataFrame:
    """Per changed table its counts; compatible when nothing was removed or retyped."""
    count = {k: F.count_if(F.col("change") == k) for k in ("added", "removed", "type_changed")}
    return changes.groupBy(*VERSION_KEY).agg(
        *[c.alias(k) for k, c in count.items()],
        ((count["removed"] == 0) & (count["type_changed"] == 0)).alias("is_compatible"))


def _contains(c: Column, term: str) -> Column:
    """LIKE %term%, ASCII letters in either case; ``%`` and ``_`` in the term are wildcards.

    As a regular expression: its case folding is ASCII only, and no lowered copy of a long
    description is made.
    """
    wildcards = {"%": ".*", "_": "."}
    return c.rlike("(?is)" + "".join(wildcards.get(ch) or re.escape(ch) for ch in term.strip("%")))


def search(tables: DataFrame, columns: DataFrame, term: str) -> DataFrame:
    """Current tables and columns whose name or description contains the term."""
    hit_tables = tables.where(_contains(F.col("name"), term) | _contains(F.col("description"), term)).select(
        "name", F.col("name").alias("table_name"), "layer", "description", F.lit("table").alias("match_type"))
    hit_columns = columns.where(_contains(F.col("column_name"), term) | _contains(F.col("description"), term)).select(
        F.col("column_name").alias("name"), "table_name", "layer", "description", F.lit("column").alias("match_type"))
    return hit_tables.unionByName(hit_columns)


def neighbours(edges: DataFrame, name: str, layer: str) -> DataFrame:
    """One hop of lineage: ``direction`` is upstream or downstream; repeated edges stay."""
    def side(mine: str, other: str, direction: str) -> DataFrame:
        hit = (F.col(f"{mine}_table") == name) & (F.col(f"{mine}_layer") == layer)
        return edges.where(hit).select(
            F.lit(direction).alias("direction"), F.col(f"{other}_table").alias("name"),
            F.col(f"{other}_layer").alias("layer"))

    return side("target", "source", "upstream").unionByName(side("source", "target", "downstream"))


def known_edges(edges: DataFrame, tables: DataFrame) -> DataFrame:
    """Edges with both ends registered."""
    ends = tables.select("name", "layer").distinct()
    for end in ("source", "target"):
        key = [f"{end}_table", f"{end}_layer"]
        edges = lookup_join(edges, ends.toDF(*key), key, "left_semi")
    return edges
