"""Operational metrics."""

from pyspark.sql import functions as F

from tierlake.checks import Check, table
from tierlake.checks.cost import workloads
from tierlake.functions.cost import breakdown
from tierlake.operators import metrics as M
from tierlake.operators.quality import QualityChecker


def _health(spark, folder):
    return M.layer_health([
        M.table_health(table(spark, folder, "events"), "events", "bronze", "ts"),
        M.table_health(table(spark, folder, "orders"), "orders", "silver", "o_orderdate"),
        M.table_health(table(spark, folder, "lineitem"), "lineitem", "gold", "l_shipdate"),
    ])


def health(spark, folder):
    return _health(spark, folder).drop("size_mb")


def _scores(spark, folder):
    """Score per event type (taken as the table) and check."""
    events = table(spark, folder, "events")
    per_table = events.groupBy(F.col("event_type").alias("table")).agg(
        F.round(F.count_if(F.col("value") < 10) / F.count(F.lit(1)), 4).alias("null_rate"),
        F.round(F.count_distinct("user_id") / F.count(F.lit(1)), 4).alias("uniqueness"),
        F.round(F.count_if(F.col("value") > 20) / F.count(F.lit(1)), 4).alias("value_range"))
    return per_table.unpivot(["table"], ["null_rate", "uniqueness", "value_range"], "check", "score")


def matrix(spark, folder):
    return M.quality_matrix(_scores(spark, folder))


def throughput(spark, folder):
    daily = M.daily_throughput(table(spark, folder, "events"), "ts", F.octet_length("props"))
    return daily.withColumn("date", F.col("date").cast("string"))


def dashboard(spark, folder):
    checks = (QualityChecker().check_row_count(1).check_null_rate("value").check_uniqueness(["event_id"])
              .check_uniqueness(["user_id"]).check_value_range("value", 0))
    results = checks.results(table(spark, folder, "events"))
    costs = breakdown(workloads(spark, folder)).select(F.col("total").alias("monthly_cost"))
    return M.summary(_health(spark, folder), results, costs).withColumn("monthly_cost", F.round("monthly_cost", 2))


def shares(spark, folder):
    shared = M.cost_share(breakdown(workloads(spark, folder)))
    return shared.withColumns({"monthly_cost": F.round("monthly_cost", 2), "share": F.round("share", 4)})


def _sql():
    from tierlake.checks.cost import BREAKDOWN_SQL

    return BREAKDOWN_SQL


CHECKS = {
    "d1_layer_health": Check(health, """
        SELECT 'events' AS "table", 'bronze' AS layer, count(*) AS record_count, max(ts) AS last_updated FROM events
        UNION ALL SELECT 'orders', 'silver', count(*), max(o_orderdate) FROM orders
        UNION ALL SELECT 'lineitem', 'gold', count(*), max(l_shipdate) FROM lineitem"""),
    "d2_quality_matrix": Check(matrix, """
        SELECT event_type AS "table", round(count(*) FILTER (WHERE value < 10) / count(*), 4) AS null_rate,
               round(count(DISTINCT user_id) / count(*), 4) AS uniqueness,
               round(count(*) FILTER (WHERE value > 20) / count(*), 4) AS value_range, CAST(NULL AS DOUBLE) AS schema_match,
               CAST(NULL AS DOUBLE) AS freshness, CAST(NULL AS DOUBLE) AS referential_integrity
        FROM events GROUP BY event_type"""),
    "d3_daily_throughput": Check(throughput, """
        SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS records_ingested, CAST(sum(strlen(props)) AS BIGINT) AS size
        FROM events GROUP BY 1"""),
    "d4_summary": Check(dashboard, f"""
        SELECT (SELECT count(*) FROM lineitem) AS gold_records, CAST(3 AS BIGINT) AS tables_tracked,
               (4 + CAST((SELECT count(DISTINCT user_id) = count(*) FROM events) AS INTEGER)) / 5 AS pass_rate,
               (SELECT round(sum(total), 2) FROM ({_sql()})) AS monthly_cost"""),
    "d5_cost_share": Check(shares, f"""
        WITH t AS (SELECT * FROM (SELECT sum(storage) AS storage, sum(requests) AS requests, sum(transfer) AS transfer,
                          sum(etl) AS etl, sum(queries) AS queries, sum(compute) AS compute FROM ({_sql()}))
                   UNPIVOT (monthly_cost FOR service IN (storage, requests, transfer, etl, queries, compute)))
        SELECT service, round(monthly_cost, 2) AS monthly_cost,
               round(monthly_cost / (SELECT sum(monthly_cost) FROM t), 4) AS share FROM t"""),
}
