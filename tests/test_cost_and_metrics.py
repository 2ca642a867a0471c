import pytest
from pyspark.sql import functions as F

from tierlake.functions import cost as K
from tierlake.operators import metrics as M
from tierlake.sources.snapshots import write_snapshot

FULL = {
    "data_volume": {"bronze_gb": 100, "silver_gb": 50, "gold_gb": 10},
    "query_pattern": {"queries_per_month": 1000, "avg_data_scanned_gb": 0.5},
    "etl_pattern": {"runs_per_month": 30, "avg_duration_minutes": 15, "dpu_count": 2},
    "lambda_pattern": {"invocations_per_month": 100000, "avg_duration_ms": 200, "memory_mb": 256},
    "s3_requests": {"put": 50000, "get": 200000},
    "data_transfer_out_gb": 10,
}


def costs(spark, config):
    return K.breakdown(K.workload_from_config(spark, config)).first()


@pytest.mark.parametrize("config, part, value", [
    ({"data_volume": {"bronze_gb": 100}}, "storage", 2.30),
    ({"query_pattern": {"queries_per_month": 1024, "avg_data_scanned_gb": 1.0}}, "queries", 5.00),
    ({"etl_pattern": {"runs_per_month": 10, "avg_duration_minutes": 60, "dpu_count": 2}}, "etl", 8.80),
    ({"etl_pattern": {"runs_per_month": 10, "avg_duration_minutes": 60}}, "etl", 8.80),
    ({"s3_requests": {"put": 10000, "get": 100000}}, "requests", 0.09),
    ({"data_transfer_out_gb": 100}, "transfer", 9.00),
    ({"lambda_pattern": {"invocations_per_month": 1000000}}, "compute", 0.2 + 100000 * 0.125 * 0.0000166667),
    ({}, "total", 0.0),
])
def test_single_parts(spark, config, part, value):
    assert costs(spark, config)[part] == pytest.approx(value, abs=1e-9)


def test_example_total_and_report(spark):
    breakdown = K.breakdown(K.workload_from_config(spark, FULL))
    assert breakdown.first()["total"] == pytest.approx(14.05474, abs=1e-4)
    row = K.report(breakdown).first()
    assert [row[p] for p in K.PARTS] == [3.68, 0.33, 0.9, 6.6, 2.44, 0.1]
    assert (row["storage_subtotal"], row["total"]) == (4.91, 14.05)


def test_usage(spark):
    row = K.usage(K.with_defaults(K.workload_from_config(spark, FULL))).first()
    assert (row["total_gb"], row["scanned_tb"], row["dpu_hours"], row["gb_seconds"]) == (160, 500 / 1024, 15, 5000)


def test_own_prices(spark):
    df = K.workload_from_config(spark, {"data_volume": {"gold_gb": 10}})
    assert K.breakdown(df, {"storage_gb": 1.0}).first()["total"] == 10.0


def test_what_if(spark):
    base = K.breakdown(K.workload_from_config(spark, FULL))
    row = K.what_if(base, 50, 100, 10).first()
    assert (row["added_storage"], row["added_queries"], row["added_etl"]) == (1.15, 0.05, 2.2)
    assert (row["additional_cost"], row["new_total"], row["percent_increase"]) == (3.4, 17.45, 24.2)
    nothing = K.what_if(K.breakdown(K.workload_from_config(spark, {})), 10).first()
    assert nothing["percent_increase"] == 0 and nothing["new_total"] == 0.23


def test_absent_columns_and_sections(spark):
    df = spark.createDataFrame([(10.0, None), (None, 5.0)], "bronze_gb double, runs_per_month double")
    rows = K.with_defaults(df).collect()
    assert [r["dpu_count"] for r in rows] == [0.0, 2.0]
    assert [r["memory_mb"] for r in rows] == [0.0, 0.0]


def test_layer_health_and_size(spark, tmp_path):
    df = spark.range(1000).withColumn("at", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
    made = write_snapshot(df, str(tmp_path), "gold", "t")
    size = M.stored_mb(spark, made["location"])
    row = M.layer_health([M.table_health(df, "t", "gold", "at", F.lit(size))]).first()
    assert (row["record_count"], row["layer"]) == (1000, "gold") and 0 < row["size_mb"] < 1


def test_quality_matrix_and_summary(spark):
    scores = spark.createDataFrame([("a", "null_rate", 0.9), ("a", "freshness", 0.5), ("b", "null_rate", 1.0)], "table string, check string, score double")
    rows = {r["table"]: r.asDict() for r in M.quality_matrix(scores).collect()}
    assert rows["a"]["freshness"] == 0.5 and rows["b"]["freshness"] is None and "uniqueness" in rows["b"]
    health = spark.createDataFrame([("a", "gold", 5), ("a", "silver", 9), ("b", "gold", 2)], "table string, layer string, record_count long")
    results = spark.createDataFrame([(True,), (False,)], "passed boolean")
    money = spark.createDataFrame([(1.5,), (2.0,)], "monthly_cost double")
    assert M.summary(health, results, money).first().asDict() == {
        "gold_records": 7, "tables_tracked": 2, "pass_rate": 0.5, "monthly_cost": 3.5}


def test_cost_share(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "storage double, etl double")
    shares = {r["service"]: (r["monthly_cost"], r["share"]) for r in M.cost_share(df, ["storage", "etl"]).collect()}
    assert shares == {"storage": (2.0, 0.5), "etl": (2.0, 0.5)}
