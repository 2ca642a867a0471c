import random

import pytest
from pyspark.sql import functions as F

from tierlake.operators import joins
from tierlake.operators.joins import pair_join, range_join, theta_join, theta_totals

OPS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def _brute(left, right, signs):
    return sorted((a[0], b[0]) for a in left for b in right
                  if all(x is not None and y is not None and OPS[s](x, y) for x, y, s in zip(a[1:], b[1:], signs)))


@pytest.mark.parametrize("signs, pieces, broadcast", [
    (("<", ">="), 4, "10m"), ((">", "<="), 8, "-1"), (("<=", "<"), 1, "-1"), ((">=", ">"), 32, "10m")])
def test_all_pairs_of_two_inequalities_with_hot_values_and_nulls(spark, signs, pieces, broadcast):
    rng = random.Random(pieces)

    def rows(n):
        return [(i, rng.choice([5, 5, 5, rng.randrange(40), None]), rng.choice([1.5, -0.0, 0.0, rng.random() * 9, None]))
                for i in range(n)]

    left, right = rows(90), rows(70)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        joined = theta_join(
            spark.createDataFrame(left, "a int, x int, u double"), spark.createDataFrame(right, "b int, y int, v double"),
            [("x", signs[0], "y"), ("u", signs[1], "v")], pieces, target_rows=50)
        assert joined.columns == ["a", "x", "u", "b", "y", "v"]
        assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["a"], r["b"]) for r in joined.collect()) == _brute(left, right, signs)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dates_times_and_empty_sides(spark):
    days = spark.range(40).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    times = days.select(F.col("d").cast("timestamp").alias("t"))
    for left, name in ((days, "d"), (times, "t")):
        right = left.withColumnRenamed(name, "o")
        assert theta_join(left, right, [(name, "<", "o")], 3).count() == 40 * 39 // 2
        assert theta_join(left, right.where("1 = 0"), [(name, "<", "o")]).count() == 0
        assert theta_join(left.where("1 = 0"), right.where("1 = 0"), [(name, "<", "o")]).count() == 0


def test_what_cannot_be_joined_is_said(spark):
    a, b = spark.range(2).toDF("a"), spark.range(2).toDF("b")
    for left, right, conditions in ((a, a, [("a", "<", "a")]), (a, b, []), (a, b.selectExpr("int(b) AS b"), [("a", "<", "b")]),
                                    (a.selectExpr("'x' AS a"), b.selectExpr("'y' AS b"), [("a", "<", "b")])):
        with pytest.raises(ValueError):
            theta_join(left, right, conditions)


@pytest.mark.parametrize("signs, piece_rows", [(("<", ">="), 9), ((">", "<="), 10_000), (("<=", "<"), 40), ((">=", ">"), 7)])
def test_totals_equal_those_of_all_pairs(spark, signs, piece_rows):
    rng = random.Random(piece_rows)

    def rows(n):
        return [(i % 50, rng.choice([5, 5, rng.randrange(40), None]), rng.choice([1.5, -0.0, 0.0, float("nan"), rng.random() * 9, None]))
                for i in range(n)]

    left, right = rows(90), rows(70)
    found = theta_totals(
        spark.createDataFrame(left, "a int, x int, u double"), spark.createDataFrame(right, "b int, y int, v double"),
        [("x", signs[0], "y"), ("u", signs[1], "v")],
        {"n": ("count", F.lit(1)), "s": ("sum", F.col("a")), "low": ("min", F.col("a")), "high": ("max", F.col("a"))}, piece_rows)
    assert found.columns == ["b", "y", "v", "n", "s", "low", "high"]

    def fulfils(a, b):  # NaN is the greatest number
        sides = [(x, y) if x == x and y == y else (x != x, y != y) for x, y in zip(a[1:], b[1:])]
        return None not in (*a[1:], *b[1:]) and all(OPS[s](x, y) for (x, y), s in zip(sides, signs))

    wanted = []
    for b in right:
        own = [a[0] for a in left if fulfils(a, b)]
        wanted += [(*b, len(own), sum(own), min(own), max(own))] if own else []
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, wanted)) and len(wanted) > 10


@pytest.mark.parametrize("conditions", [1, 3])
def test_totals_of_one_and_three_conditions(spark, conditions):
    rng = random.Random(conditions)
    left, right = ([(i, *(rng.randrange(12) for _ in range(3))) for i in range(n)] for n in (60, 40))
    signs = [("x1", "<", "y1"), ("x2", ">=", "y2"), ("x3", "<=", "y3")][:conditions]
    found = theta_totals(
        spark.createDataFrame(left, "a int, x1 int, x2 int, x3 int"), spark.createDataFrame(right, "b int, y1 int, y2 int, y3 int"),
        signs, {"n": ("count", F.lit(1))}, 25)
    pairs = _brute([a[:conditions + 1] for a in left], [b[:conditions + 1] for b in right], [s for _, s, _ in signs])
    wanted = {b: sum(p[1] == b for p in pairs) for b in {p[1] for p in pairs}}
    assert {r["b"]: r["n"] for r in found.collect()} == wanted
    assert theta_totals(spark.createDataFrame([], "x1 int"), found.select("y1"), signs[:1], {"n": ("count", F.lit(1))}).collect() == []


def test_totals_make_no_pairs(spark):
    """Two sides of 100,000 rows have five thousand million pairs."""
    left, right = spark.range(100_000).toDF("a"), spark.range(100_000).toDF("b")
    found = theta_totals(left.withColumn("c", -F.col("a")), right.withColumn("d", -F.col("b")),
                         [("a", "<", "b"), ("c", ">", "d")], {"n": ("count", F.lit(1))})
    assert found.where("n <> b").count() == 0 and found.count() == 99_999


@pytest.mark.parametrize("tile_pairs, task_pairs", [(7, 50), (200, 1), (1 << 22, 1 << 24)])
def test_pairs_of_hot_keys_are_whole(spark, monkeypatch, tile_pairs, task_pairs):
    monkeypatch.setattr(joins, "FEW_MATCHES", 2)
    rng = random.Random(tile_pairs)

    def rows(n):
        return [(rng.choice(["hot", "hot", "b", "c", None]), rng.choice([1, 1, 2]), i // 2) for i in range(n)]

    left, right = rows(80), rows(50)
    joined = pair_join(spark.createDataFrame(left, "k string, j int, a int"), spark.createDataFrame(right, "k string, j int, b int"),
                       ["k", "j"], tile_pairs, task_pairs)
    assert joined.columns == ["k", "j", "a", "b"]
    wanted = sorted((*x, y[2]) for x in left for y in right if x[:2] == y[:2] and x[0])
    assert sorted(map(tuple, joined.collect())) == wanted


def test_points_and_long_ranges_of_one_cell_are_many_tasks(spark):
    points = spark.range(5000).select((F.col("id") / 5000).alias("p"))
    ranges = spark.range(8000).select(F.col("id").alias("r"), F.lit(0.0).alias("low"), F.lit(1e6).alias("high"))
    found = range_join(points, ranges, "p", "low", "high", 2.0)
    tasks = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(tasks) == 40_000_000 and max(tasks) <= 25_000_000
