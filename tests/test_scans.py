"""Segmented scans against plain windows, with pieces of a few rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierlake.operators.scans import (
    asof_join, first_value, in_pieces, last_known, range_sum, running_max, running_min, running_sum,
)


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(4)
    keys = ["hot"] * 200 + ["warm"] * 30 + list("abcdefgh") * 3 + [None] * 20
    made = [(i, k, pick.randrange(40), pick.choice([None, *range(9)])) for i, k in enumerate(keys)]
    pick.shuffle(made)
    return spark.createDataFrame(made, "id long, k string, t int, v int").repartition(5)


def same(found, wanted):
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)


def by_time():
    return [F.col("t").asc_nulls_first(), F.col("id").asc()]


@pytest.mark.parametrize("piece_rows", [7, 10_000])
def test_running_values(rows, piece_rows):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    found = in_pieces(rows, ["k"], by_time(), piece_rows).numbered("n").running(
        total=running_sum(F.col("v")), least=running_min(F.col("v")), most=running_max(F.col("v")),
        first=first_value(F.col("v")), last=last_known(F.col("v"))).totals("all").result()
    whole = Window.partitionBy("k")
    same(found, rows.select(
        "id", "k", "t", "v", F.count(F.lit(1)).over(w).alias("n"), F.sum("v").over(w).alias("total"), F.min("v").over(w).alias("least"),
        F.max("v").over(w).alias("most"), F.first("v").over(w).alias("first"), F.last("v", ignorenulls=True).over(w).alias("last"),
        F.count(F.lit(1)).over(whole).alias("all")))


@pytest.mark.parametrize("piece_rows, tiles", [(5, 3), (60, 50), (10_000, 4)])
def test_ranks_and_tiles(rows, piece_rows, tiles):
    by_t, w = Window.partitionBy("k").orderBy("t"), Window.partitionBy("k").orderBy("t", "id")
    found = in_pieces(rows, ["k"], by_time(), piece_rows).ranked(F.col("t"), "r", "d").tiled(tiles, "tile").result()
    same(found, rows.select("*", F.rank().over(by_t).cast("long").alias("r"), F.dense_rank().over(by_t).cast("long").alias("d"),
                            F.ntile(tiles).over(w).cast("long").alias("tile")))


@pytest.mark.parametrize("piece_rows", [2, 9])
def test_neighbours_and_frames_of_rows(rows, piece_rows):
    w = Window.partitionBy("k").orderBy("t", "id")
    columns = {"back": lambda w: F.lag("v", 4).over(w), "on": lambda w: F.lead("v", 3).over(w),
               "sum": lambda w: F.sum("v").over(w.rowsBetween(-4, 3)), "next": lambda w: F.max("v").over(w.rowsBetween(1, 2))}
    found = in_pieces(rows, ["k"], by_time(), piece_rows).near(4, 3, **columns).result()
    same(found, rows.select("*", *(c(w).alias(n) for n, c in columns.items())))


@pytest.mark.parametrize("piece_rows", [6, 10_000])
def test_frames_of_order_values(rows, piece_rows):
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-5, 0)
    some = rows.where("k IS NOT NULL")
    same(range_sum(some, "k", "t", F.col("v").cast("long"), F.col("t") - 6, "s", piece_rows),
         some.select("*", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s")))


def test_asof_of_one_hot_key_and_hour_is_many_tasks(spark):
    left = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(5).alias("t"), "id")
    right = spark.range(4000).select(F.lit("hot").alias("k"), (F.col("id") % 6).cast("int").alias("t"), F.col("id").alias("v"))
    found = asof_join(left, right, "k", "t", {"v": "last"}, tie="v", piece_rows=500)
    assert {r["last"] for r in found.collect()} == {3995} and found.count() == 4000
    merged = in_pieces(right, ["k"], [F.col("t").asc(), F.col("v").asc()], 500).rows
    sizes = [r["n"] for r in merged.groupBy("_piece").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) >= 6 and max(sizes) <= 1500


def test_empty_table(rows):
    none = rows.limit(0)
    pieces = in_pieces(none, ["k"], by_time()).numbered().ranked(F.col("t")).near(1, 1, x=lambda w: F.lag("v").over(w))
    assert pieces.result().collect() == [] and asof_join(none, none, "k", "t", {"v": "w"}).collect() == []


def test_windows_of_many_pieces_are_many_tasks(spark):
    df = spark.range(8000).select((F.col("id") % 50).alias("k"), "id")
    order = [F.col("id").asc()]
    for found in (in_pieces(df, ["k"], order, 500).running(s=running_sum(F.col("id"))), in_pieces(df, ["k"], order, 500).totals(),
                  in_pieces(df, ["k"], order, 500).near(1, 0, b=lambda w: F.lag("id").over(w))):
        tasks = [r["n"] for r in found.rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(tasks) == 8000 and max(tasks) <= 1500
