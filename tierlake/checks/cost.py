"""Cost of monthly workloads summed from the orders."""

from pyspark.sql import functions as F

from tierlake.checks import Check, table
from tierlake.functions import cost as K

_USAGE = ("total_gb", "scanned_tb", "dpu_hours", "gb_seconds")


def workloads(spark, folder):
    """One workload per month and priority; some sections and inputs are absent."""
    orders = table(spark, folder, "orders").withColumns({
        "month": F.date_format("o_orderdate", "yyyy-MM"), "cents": F.round(F.col("o_totalprice") * 100).cast("long")})
    sums = orders.groupBy("month", "o_orderpriority").agg(F.sum("cents").alias("c"), F.count(F.lit(1)).alias("n"))
    urgent, low = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "5-LOW"
    return sums.select(
        "month", F.col("o_orderpriority").alias("workload"),
        (F.col("c") / 1e6).alias("bronze_gb"), F.when(~low, F.col("c") / 4e6).alias("silver_gb"),
        F.lit(None).cast("double").alias("gold_gb"),
        F.when(~urgent, F.col("n")).alias("queries_per_month"), F.when(~urgent, F.lit(0.5)).alias("avg_data_scanned_gb"),
        F.when(~low, F.col("n")).alias("runs_per_month"), F.when(~low, F.lit(15.0)).alias("avg_duration_minutes"),
        (F.col("n") * 1000).alias("invocations_per_month"), F.when(urgent, F.lit(200.0)).alias("avg_duration_ms"),
        (F.col("n") * 50).alias("put"), (F.col("n") * 200).alias("get"), (F.col("n") / 7).alias("data_transfer_out_gb"))


_WORKLOADS_SQL = """
    SELECT month, o_orderpriority AS workload, c / 1e6 AS bronze_gb,
           CASE WHEN o_orderpriority <> '5-LOW' THEN c / 4e6 END AS silver_gb,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN n END AS queries_per_month,
           CASE WHEN o_orderpriority <> '5-LOW' THEN n END AS runs_per_month,
           n * 1000 AS invocations_per_month, CASE WHEN o_orderpriority = '1-URGENT' THEN 200.0 ELSE 100.0 END AS ms,
           n * 50 AS put, n * 200 AS get, n / 7 AS data_transfer_out_gb
    FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority,
                 CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS c, count(*) AS n
          FROM orders GROUP BY ALL)"""
_USAGE_SQL = f"""
    SELECT month, workload, CAST(bronze_gb + coalesce(silver_gb, 0) AS DOUBLE) AS total_gb,
           CAST(coalesce(queries_per_month, 0) AS DOUBLE) * CAST(0.5 AS DOUBLE) / 1024 AS scanned_tb,
           CAST(coalesce(runs_per_month, 0) AS DOUBLE) * 15 / 60 * 2 AS dpu_hours,
           CAST(invocations_per_month AS DOUBLE) * CAST(ms AS DOUBLE) / 1000 * CAST(0.125 AS DOUBLE) AS gb_seconds,
           CAST(put AS DOUBLE) AS put, CAST(get AS DOUBLE) AS get, CAST(data_transfer_out_gb AS DOUBLE) AS data_transfer_out_gb,
           CAST(invocations_per_month AS DOUBLE) AS calls
    FROM ({_WORKLOADS_SQL})"""
_PARTS_SQL = f"""
    SELECT month, workload, total_gb * CAST(0.023 AS DOUBLE) AS storage,
           put / 1000 * CAST(0.005 AS DOUBLE) + get / 1000 * CAST(0.0004 AS DOUBLE) AS requests,
           data_transfer_out_gb * CAST(0.09 AS DOUBLE) AS transfer, dpu_hours * CAST(0.44 AS DOUBLE) AS etl,
           scanned_tb * 5 AS queries, calls / 1e6 * CAST(0.2 AS DOUBLE) + gb_seconds * CAST(0.0000166667 AS DOUBLE) AS compute
    FROM ({_USAGE_SQL})"""
BREAKDOWN_SQL = f"SELECT *, storage + requests + transfer + etl + queries + compute AS total FROM ({_PARTS_SQL})"


def _rounded(df, names, digits):
    return df.select("month", "workload", *[F.round(n, digits).alias(n) for n in names])


def _rounded_sql(sql, names, digits):
    columns = ", ".join(f"round({n}, {digits}) AS {n}" for n in names)
    return f"SELECT month, workload, {columns} FROM ({sql})"


def used(spark, folder):
    return _rounded(K.usage(K.with_defaults(workloads(spark, folder))), _USAGE, 8)


def parts(spark, folder):
    return _rounded(K.breakdown(workloads(spark, folder)), (*K.PARTS, "total"), 6)


def rounded(spark, folder):
    columns = ("month", "workload", *K.PARTS, "storage_subtotal", "total")
    return K.report(K.breakdown(workloads(spark, folder))).select(*columns)


def defaults(spark, folder):
    names = ("silver_gb", "gold_gb", "queries_per_month", "avg_data_scanned_gb", "runs_per_month", "dpu_count",
             "avg_duration_ms", "memory_mb")
    return K.with_defaults(workloads(spark, folder)).select("month", "workload", *names)


def added(spark, folder):
    costs = K.breakdown(workloads(spark, folder))
    grown = K.what_if(costs, F.col("total_gb") / 10, F.col("queries_per_month") * 20, 7)
    return grown.select("month", "workload", "current_cost", "added_storage", "added_queries", "added_etl",
                        "additional_cost", "new_total", "percent_increase")


CHECKS = {
    "e1_usage": Check(used, _rounded_sql(_USAGE_SQL, _USAGE, 8)),
    "e2_breakdown": Check(parts, _rounded_sql(BREAKDOWN_SQL, (*K.PARTS, "total"), 6)),
    "e3_report": Check(rounded, f"""
        SELECT month, workload, round(storage, 2) AS storage, round(requests, 2) AS requests, round(transfer, 2) AS transfer,
               round(etl, 2) AS etl, round(queries, 2) AS queries, round(compute, 2) AS compute,
               round(storage + requests + transfer, 2) AS storage_subtotal, round(total, 2) AS total
        FROM ({BREAKDOWN_SQL})"""),
    "e4_defaults": Check(defaults, f"""
        SELECT month, workload, CAST(coalesce(silver_gb, 0) AS DOUBLE) AS silver_gb, CAST(0 AS DOUBLE) AS gold_gb,
               CAST(coalesce(queries_per_month, 0) AS DOUBLE) AS queries_per_month,
               CAST(CASE WHEN workload <> '1-URGENT' THEN 0.5 ELSE 0 END AS DOUBLE) AS avg_data_scanned_gb,
               CAST(coalesce(runs_per_month, 0) AS DOUBLE) AS runs_per_month,
               CAST(CASE WHEN workload <> '5-LOW' THEN 2 ELSE 0 END AS DOUBLE) AS dpu_count,
               CAST(ms AS DOUBLE) AS avg_duration_ms, CAST(128 AS DOUBLE) AS memory_mb
        FROM ({_WORKLOADS_SQL})"""),
    "e5_what_if": Check(added, f"""
        SELECT month, workload, round(total, 2) AS current_cost, round(s, 2) AS added_storage, round(q, 2) AS added_queries,
               round(e, 2) AS added_etl, round(s + q + e, 2) AS additional_cost, round(total + (s + q + e), 2) AS new_total,
               CASE WHEN total > 0 THEN round((s + q + e) / total * 100, 1) ELSE 0 END AS percent_increase
        FROM (SELECT b.*, u.total_gb / 10 * CAST(0.023 AS DOUBLE) AS s,
                     u.scanned_tb * 2 * 1024 * 20 * CAST(0.1 AS DOUBLE) / 1024 * 5 AS q,
                     CAST(7 * 0.5 * 0.44 AS DOUBLE) AS e
              FROM ({BREAKDOWN_SQL}) b JOIN ({_USAGE_SQL}) u USING (month, workload))"""),
}
