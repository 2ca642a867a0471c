import glob
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from plans import final_plan, plan_text
from tierlake.operators.dimension import dense_key, dimension
from tierlake.operators.fact import aggregate, lookup_key
from tierlake.operators.scans import asof_join
from tierlake.operators.joins import broadcast_limit, fits_broadcast, range_join, salted_join
from tierlake.operators.quantiles import exact_median
from tierlake.plans.gold import create_dimension_table, create_fact_table
from tierlake.sources.snapshots import read_latest, write_snapshot


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(1, "C1", "P1", 100.0, 1), (2, "C2", "P2", 200.0, 2), (3, "C1", "P1", 150.0, 1), (4, "C3", "P3", 300.0, 3)],
        "order_id long, customer_id string, product_id string, amount double, quantity long")


def test_dimension_and_fact_tables(spark, tmp_path, sales):
    root = str(tmp_path)
    write_snapshot(sales, root, "silver", "orders")
    made = create_dimension_table(spark, root, "dim_customer", "orders", ["customer_id", "absent"], "customer_sk")
    assert made["row_count"] == 3 and made["table_type"] == "dimension"
    dim = read_latest(spark, root, "gold", "dim_customer")
    assert dim.columns == ["customer_sk", "customer_id"]
    assert sorted(r["customer_sk"] for r in dim.collect()) == [1, 2, 3]
    plain = create_fact_table(spark, root, "fact_all", "orders", ["amount"])
    assert plain["row_count"] == 4 and plain["table_type"] == "fact"
    create_fact_table(
        spark, root, "fact_sales", "orders", ["amount"], {"dim_customer": ("customer_id", "customer_fk")},
        {"amount": "sum"}, ["customer_id", "customer_fk"])
    totals = {r["customer_id"]: r["amount"] for r in read_latest(spark, root, "gold", "fact_sales").collect()}
    assert totals == {"C1": 250.0, "C2": 200.0, "C3": 300.0}


def test_gold_files_have_bounded_row_groups(spark, tmp_path):
    write_snapshot(spark.range(0, 120_000, 1, 1), str(tmp_path), "silver", "t")
    made = create_fact_table(spark, str(tmp_path), "f", "t", [], row_group_rows=50_000)
    sizes = []
    for path in glob.glob(f"{made['location']}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        sizes += [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
        assert meta.row_group(0).column(0).compression == "SNAPPY"
    assert sum(sizes) == 120_000 and max(sizes) <= 50_000


def test_missing_silver_table(spark, tmp_path):
    with pytest.raises(ValueError, match="No silver data"):
        create_dimension_table(spark, str(tmp_path), "d", "absent", ["a"])


def test_keys_follow_first_occurrence_when_asked(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("c", 0)], "v string, at long")
    assert [(r["sk"], r["v"]) for r in dimension(df, ["v"], "sk", "at").orderBy("sk").collect()] == [(1, "c"), (2, "b"), (3, "a")]
    assert [(r["sk"], r["v"]) for r in dimension(df, ["v"], "sk").orderBy("sk").collect()] == [(1, "a"), (2, "b"), (3, "c")]


def test_dense_key_over_many_partitions_moves_rows_once(spark):
    df = spark.range(0, 50_000, 1, 16).select(((F.col("id") * 7919) % 50_000).alias("v"))
    keyed = dense_key(df, "sk")
    assert keyed.where("sk != v + 1").count() == 0
    text = plan_text(keyed)
    assert "BroadcastHashJoin" in text and "Window [row_number" not in text
    assert text.count("Exchange hashpartitioning") == 1  # one count per partition


def test_lookup_last_wins_and_unmatched_is_null(spark):
    fact = spark.createDataFrame([("C1",), ("C9",), (None,)], "c string")
    dim = spark.createDataFrame([(1, "C1"), (2, "C1"), (3, "C2"), (4, None)], "sk long, c string")
    found = [(r["c"], r["fk"]) for r in lookup_key(fact, dim, "c", "fk").collect()]
    assert sorted(found, key=repr) == [("C1", 2), ("C9", None), (None, None)]
    replaced = lookup_key(fact, dim, "c", "c")
    assert replaced.columns == ["c"] and sorted(r["c"] or 0 for r in replaced.collect()) == [0, 0, 2]
    with pytest.raises(ValueError):
        lookup_key(fact, dim.select("c"), "c", "fk")
    with pytest.raises(ValueError):
        lookup_key(fact, dim, "absent", "fk")


def test_small_dimension_is_broadcast_and_a_big_one_salted(spark):
    fact = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("c"))
    dim = spark.range(40).select((F.col("id") + 1).alias("sk"), F.col("id").alias("c"))
    small = lookup_key(fact, dim, "c", "fk")
    assert "BroadcastHashJoin" in plan_text(small)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert broadcast_limit(spark) == 100 and not fits_broadcast(dim)
        big = lookup_key(fact, dim, "c", "fk")
        text = final_plan(big)
        assert "SortMergeJoin" in text and "_salt" in text
        assert big.exceptAll(small).count() == 0 and small.exceptAll(big).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_salted_join_with_few_hot_keys(spark):
    left = spark.range(0, 3000, 1, 7).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise((F.col("id") % 90).cast("string")).alias("k"))
    right = spark.range(95).select(F.when(F.col("id") == 94, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not fits_broadcast(right)
        for how in ("left", "inner"):
            ours = salted_join(left, right, ["k"], how, 200).select("id", "k", "v")
            plain = left.join(right, ["k"], how).select("id", "k", "v")
            assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_salted_semi_and_anti_joins(spark):
    left = spark.range(100).repartition(5).select((F.col("id") % 10).alias("k"))
    right = spark.range(4).select(F.col("id").alias("k"))
    assert salted_join(left, right, ["k"], "left_semi", 3).count() == 40
    assert salted_join(left, right, ["k"], "left_anti", 3).count() == 60


def test_aggregate_rules(spark):
    df = spark.createDataFrame(
        [("a", 1.0, None), ("a", float("nan"), None), (None, 5.0, 1), ("b", 2.0, 3), ("b", 4.0, 3)],
        "k string, v double, n long")
    result = {r["k"]: r.asDict() for r in aggregate(df, ["k"], {"v": "mean", "n": "sum", "absent": "max"}).collect()}
    assert result == {"a": {"k": "a", "v": 1.0, "n": 0}, "b": {"k": "b", "v": 3.0, "n": 6}}
    assert {r["k"]: r["v"] for r in aggregate(df, ["k"], {"v": "avg"}).collect()} == {"a": 1.0, "b": 3.0}
    assert aggregate(df, ["k"], {"absent": "sum"}).count() == 5
    with pytest.raises(ValueError, match="order_by"):
        aggregate(df, ["k"], {"v": "first"})
    with pytest.raises(ValueError, match="unknown aggregate"):
        aggregate(df, ["k"], {"v": "mode"})


def test_rows_without_a_match_leave_a_fact_grouped_by_the_key(spark):
    from tierlake.operators.fact import fact

    df = spark.createDataFrame([("C1", 1), ("C9", 2)], "c string, v long")
    dim = spark.createDataFrame([(1, "C1")], "sk long, c string")
    assert [r.asDict() for r in fact(df, {"d": (dim, "c", "fk")}, {"v": "sum"}, ["fk"]).collect()] == [{"fk": 1, "v": 1}]


def test_exact_median_with_a_hot_group(spark):
    df = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("k"),
        ((F.col("id") * 37) % 1001).cast("double").alias("v"))
    ours = {r["k"]: r["m"] for r in exact_median(df, ["k"], "v", "m").collect()}
    theirs = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()}
    assert ours == theirs
    assert exact_median(df, [], "v", "m").first()["m"] == df.agg(F.median("v")).first()[0]


def test_asof_join_matches_brute_force(spark):
    left = spark.createDataFrame(
        [(1, "a", "2024-01-01 00:30:00"), (2, "a", "2024-01-01 05:00:00"), (3, "b", "2024-01-01 05:00:00"),
         (4, "a", "2024-01-01 00:00:00"), (5, None, "2024-01-01 00:00:00"), (6, "a", None)],
        "id long, k string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    right = spark.createDataFrame(
        [("a", "2024-01-01 00:10:00", 10), ("a", "2024-01-01 01:00:00", 20), ("b", "2024-01-01 06:00:00", 30),
         ("a", "2024-01-01 05:00:00", 40), ("a", "2024-01-01 05:00:00", 50), (None, "2023-01-01 00:00:00", 60)],
        "k string, ts string, v long").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    found = {r["id"]: r["last_v"] for r in asof_join(left, right, "k", "ts", {"v": "last_v"}, tie="v").collect()}
    assert found == {1: 10, 2: 50, 3: None, 4: None, 5: None, 6: None}
    coarse = {r["id"]: r["last_v"] for r in asof_join(left, right, "k", "ts", {"v": "last_v"}, "v", piece_rows=2).collect()}
    assert coarse == found


def test_range_join_matches_nested_loop(spark):
    points = spark.range(200).select((F.col("id") * 1.7 - 40).alias("p"))
    ranges = spark.createDataFrame([(1, -10.0, 5.0), (2, 4.0, 60.0), (3, 60.0, 60.0), (4, 100.0, 101.0)], "r long, lo double, hi double")
    ours = range_join(points, ranges, "p", "lo", "hi", 10.0).select("p", "r")
    brute = points.join(ranges, (F.col("p") >= F.col("lo")) & (F.col("p") < F.col("hi"))).select("p", "r")
    assert ours.exceptAll(brute).count() == 0 and brute.exceptAll(ours).count() == 0


def test_empty_tables(spark):
    from tierlake.operators.cleaning import keep_last
    from tierlake.operators.fact import fact

    empty = spark.createDataFrame([], "c string, v double, at long")
    dim = dimension(empty, ["c"], "sk")
    assert dim.columns == ["sk", "c"] and dim.count() == 0
    assert keep_last(empty, ["c"], ["at"]).count() == 0
    assert aggregate(empty, ["c"], {"v": "median"}).count() == 0
    some = spark.createDataFrame([("a", 1.0, 1)], "c string, v double, at long")
    assert [r.asDict() for r in fact(some, {"d": (dim, "c", "fk")}).collect()] == [{"c": "a", "v": 1.0, "at": 1, "fk": None}]
    assert salted_join(some, dim, ["c"], "left", 3).count() == 1


def test_hot_key_is_split_over_tasks(spark):
    """A key with a third of the rows, clustered in the input, ends up in several join tasks."""
    left = spark.range(0, 30_000, 1, 12).select("id", F.when(F.col("id") < 10_000, -1).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 30_000, 1, 3).select(F.when(F.col("id") == 5, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(left, right, ["k"], "inner", 1250)
        tasks = joined.where("k = -1").groupBy(F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in tasks) == 10_000 and len(tasks) > 1


def test_hot_keys_get_salts_by_their_rows(spark):
    from tierlake.operators.joins import hot_keys

    rows = spark.range(1000).select(F.when(F.col("id") < 400, 1).when(F.col("id") < 450, 2).otherwise(F.col("id")).alias("k"))
    assert {r["k"]: r["_salts"] for r in hot_keys(rows, ["k"], 45).collect()} == {1: 9, 2: 2}


@pytest.mark.parametrize("tie, low, high", [("double", 0.1, 0.9), ("string", "a", "b")])
def test_asof_tie_keeps_its_type(spark, tie, low, high):
    left = spark.createDataFrame(
        [(1, "a", datetime(2024, 1, 1, 5)), (2, None, datetime(2024, 1, 1, 5)), (3, "a", None)], "id int, k string, t timestamp")
    for pair in ([(low, "early"), (high, "late")], [(high, "late"), (low, "early")]):
        right = spark.createDataFrame([("a", datetime(2024, 1, 1, 1), o, v) for o, v in pair],
                                      f"k string, t timestamp, o {tie}, v string")
        found = asof_join(left, right, "k", "t", {"v": "v"}, tie="o").collect()
        assert {r["id"]: r["v"] for r in found} == {1: "late", 2: None, 3: None}


def test_long_ranges_touch_few_cells(spark):
    points = spark.range(0, 2000, 1).select(F.col("id").alias("p"))
    ranges = spark.createDataFrame([(0, 0.0, 1e12), (1, 5.0, 6.0), (2, 100.0, 1700.5), (3, 9.0, 9.0)], "r int, low double, high double")
    found = range_join(points, ranges, "p", "low", "high", 1.0).groupBy("r").count().collect()
    assert {r["r"]: r["count"] for r in found} == {0: 2000, 1: 1, 2: 1601}


def test_fact_with_an_ordered_aggregate(spark):
    from tierlake.operators.fact import fact

    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 3), ("b", 5, 1)], "k string, v int, at int")
    found = fact(df, None, {"v": "last"}, ["k"], order_by="at").collect()
    assert {r["k"]: r["v"] for r in found} == {"a": 1, "b": 5}


def test_median_of_whole_numbers_beyond_doubles(spark):
    big = 2 ** 53
    df = spark.createDataFrame([("a", big + 1), ("a", big), ("a", big + 2), ("b", 1), ("b", 2)], "k string, v long")
    assert {r["k"]: r["m"] for r in exact_median(df, ["k"], "v", "m").collect()} == {"a": float(big + 1), "b": 1.5}


def test_clusters_need_a_shared_folder():
    from types import SimpleNamespace

    from tierlake.session import is_local, shared_folder

    session = SimpleNamespace(
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
        conf=SimpleNamespace(get=lambda name, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)
    assert is_local("local[8]") and is_local("local") and not is_local("local-cluster[3,2,1024]")
