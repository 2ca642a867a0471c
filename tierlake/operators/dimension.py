"""Dimensions: distinct tuples with a dense surrogate key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions.columns import named
from tierlake.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def distinct_tuples(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of the wanted columns; columns the table lacks are skipped."""
    return df.select(*[named(c) for c in columns if c in df.columns]).distinct()


def dense_key(df: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """Number the rows 1..N in ``order_by`` order (all columns by default), key first.

    A window without partitions would send all rows to one task. Here the rows are range
    partitioned and sorted, written to the checkpoint folder, and numbered by partition start
    plus position: the second pass reads the very same partitions and shuffles nothing. Only
    one count per partition is exchanged and broadcast.
    """
    order = order_by or df.columns
    ranged = df.repartitionByRange(*map(named, order)).sortWithinPartitions(*map(named, order))
    placed = materialize(ranged).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumns({
        "_part": F.shiftright("_at", _ROW_BITS),
        "_pos": F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    })
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    # one row per partition, so the broadcast is bounded by the partition count
    return placed.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_pos") + 1).cast("long").alias(key), *map(named, df.columns)
    )


def dimension(
    df: DataFrame,
    columns: list[str],
    surrogate_key: str | None = None,
    first_seen_by: str | None = None,
) -> DataFrame:
    """Distinct tuples of ``columns``, numbered when a surrogate key is wanted.

    Keys ascend with the tuple, or with its first occurrence by the column ``first_seen_by``.
    """
    tuples = distinct_tuples(df, columns)
    if not surrogate_key:
        return tuples
    if not first_seen_by:
        return dense_key(tuples, surrogate_key)
    names = tuples.columns
    seen = df.groupBy(*map(named, names)).agg(F.min(named(first_seen_by)).alias("_seen"))
    return dense_key(seen, surrogate_key, ["_seen", *names]).select(surrogate_key, *map(named, names))
