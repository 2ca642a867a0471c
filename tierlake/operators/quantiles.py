"""Exact grouped median without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions.columns import named, present
from tierlake.session import materialize


def exact_median(df: DataFrame, keys: list[str], measure: str, out: str) -> DataFrame:
    """Median of ``measure`` per ``keys``, nulls and NaN ignored.

    The built-in ``median`` keeps every distinct value of a group in one buffer. Here equal
    values are counted first, the counts are range partitioned by (keys, value) so that a big
    group spans many partitions (in their own type, so large whole numbers stay apart), and a
    value's rank is the sum of the earlier pieces of its
    group plus the running count inside its own piece.
    """
    counts = (
        df.select(*map(named, keys), present(df, measure).alias("_v"))
        .where(F.col("_v").isNotNull())
        .groupBy(*map(named, keys), "_v").agg(F.count(F.lit(1)).alias("_n"))
    )
    ranged = counts.repartitionByRange(*map(named, keys), "_v")
    pieces = materialize(ranged).withColumn("_piece", F.spark_partition_id())
    group = [named(k) for k in keys]
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    # one row per group and piece
    offsets = (
        pieces.groupBy(*group, "_piece").agg(F.sum("_n").alias("_size"))
        .select(*group, "_piece",
                F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
                F.sum("_size").over(whole).alias("_total"))
    )
    inside = (
        Window.partitionBy(*group, "_piece").orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = (
        pieces.withColumn("_run", F.sum("_n").over(inside))
        .join(offsets, [*keys, "_piece"])
        .withColumn("_rank", F.col("_before") + F.col("_run"))
    )
    total = F.col("_total")
    lower = F.min(F.when(F.col("_rank") >= F.floor((total + 1) / 2), F.col("_v")))
    upper = F.min(F.when(F.col("_rank") >= F.floor(total / 2) + 1, F.col("_v")))
    found = ranked.groupBy(*group).agg(lower.alias("_low"), upper.alias("_high"))
    low, high = F.col("_low").cast("double"), F.col("_high").cast("double")
    middle = F.when(F.col("_low") == F.col("_high"), low).otherwise((low + high) / 2)
    return found.select(*group, middle.alias(out))
