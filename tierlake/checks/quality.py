"""Quality checks."""

from pyspark.sql import functions as F

from tierlake.checks import Check, table
from tierlake.operators.quality import (
    QualityChecker, layer_checks, orphan_rate, report_totals,
)

_SHOWN = ("check_name", "passed", "value", "low", "high")


def _gaps(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", "user_id", "ts", F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("event_type") == "click", F.lit(float("nan")))
        .when(F.col("event_type") != "view", F.col("value")).alias("value"))


_GAPS = """(SELECT event_id, user_id, ts, nullif(event_type, 'error') AS event_type,
                   CASE WHEN event_type NOT IN ('click', 'view') THEN value END AS value FROM events)"""


def null_rates(spark, folder):
    checker = QualityChecker().check_null_rate("event_type", 0.2).check_null_rate("value", 0.5).check_null_rate("ts", 0.0)
    return checker.results(_gaps(spark, folder)).select("check_name", "passed", "value")


def uniqueness(spark, folder):
    checker = (QualityChecker().check_uniqueness(["event_id"]).check_uniqueness(["user_id", "event_type"], 0.05)
               .check_uniqueness(["event_type", "value"], 0.4))
    return checker.results(_gaps(spark, folder)).select("check_name", "passed", "value")


def ranges(spark, folder):
    checker = (QualityChecker().check_value_range("value", 0, 100).check_value_range("user_id", min_val=0)
               .check_value_range("event_id", max_val=10).check_value_range("event_type", 0))
    return checker.results(_gaps(spark, folder)).select(*_SHOWN[:2], "low", "high")


def row_counts(spark, folder):
    checker = QualityChecker().check_row_count(1).check_row_count(1, 5).check_schema(["user_id", "email"]).check_schema(["ts"])
    return checker.results(table(spark, folder, "lineitem").withColumns({"user_id": F.lit(1), "ts": F.col("l_shipdate")})).select(
        "position", *_SHOWN[:3])


def predicates(spark, folder):
    lines = table(spark, folder, "lineitem")
    checker = (QualityChecker()
               .add_check("discount_below_tax", F.col("l_discount") <= F.col("l_tax"), max_violations=10)
               .add_check("positive_quantity", F.col("l_quantity") > 0)
               .add_check("returned_in_time", F.nullif("l_returnflag", F.lit("A")) != "R")
               .add_check("whole_table", lambda df: df.columns[0] == "l_orderkey"))
    return checker.results(lines).select("check_name", "passed", "value")


def totals(spark, folder):
    checker = (QualityChecker().check_row_count(1).check_null_rate("event_type", 0.1).check_uniqueness(["event_id"])
               .check_value_range("value", 0, 5).check_schema(["event_id", "email"]).check_null_rate("absent"))
    return report_totals(checker.results(_gaps(spark, folder)), "events", "silver")


def presets(spark, folder):
    orders = table(spark, folder, "orders")
    layers = {name: layer_checks(name, "o_custkey") for name in ("bronze", "silver", "gold")}
    frames = [c.results(orders).select(F.lit(layer).alias("layer"), *_SHOWN[:3]) for layer, c in layers.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def freshness(spark, folder):
    checker = (QualityChecker().check_freshness("ts", "2024-01-31 00:00:00", 24)
               .check_freshness("ts", "2024-02-10 00:00:00", 24))
    return checker.results(table(spark, folder, "events")).select("position", *_SHOWN[:2])


def references(spark, folder):
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    urgent = orders.where(F.col("o_orderpriority") != "1-URGENT")
    return orphan_rate(lines, "l_orderkey", urgent, "o_orderkey").withColumn("rate", F.round("rate", 6))


def reference_checks(spark, folder):
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    checker = (QualityChecker().check_reference("doc_id", labels, "doc_id", 0.1)
               .check_reference("doc_id", documents.withColumnRenamed("doc_id", "id"), "id").check_row_count(1))
    return checker.results(documents).select("position", *_SHOWN[:3])


CHECKS = {
    "q1_null_rate": Check(null_rates, f"""
        SELECT 'null_rate_event_type' AS check_name, avg(CASE WHEN event_type IS NULL THEN 1 ELSE 0 END) <= 0.2 AS passed,
               round(avg(CASE WHEN event_type IS NULL THEN 1 ELSE 0 END), 4) AS value FROM {_GAPS}
        UNION ALL SELECT 'null_rate_value', avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END) <= 0.5,
               round(avg(CASE WHEN value IS NULL THEN 1 ELSE 0 END), 4) FROM {_GAPS}
        UNION ALL SELECT 'null_rate_ts', avg(CASE WHEN ts IS NULL THEN 1 ELSE 0 END) <= 0,
               round(avg(CASE WHEN ts IS NULL THEN 1 ELSE 0 END), 4) FROM {_GAPS}"""),
    "q2_uniqueness": Check(uniqueness, f"""
        WITH n AS (SELECT count(*) AS n FROM events)
        SELECT 'uniqueness_event_id' AS check_name, count(*) / any_value(n) >= 1 AS passed, round(count(*) / any_value(n), 4) AS value
        FROM (SELECT DISTINCT event_id FROM {_GAPS}), n
        UNION ALL SELECT 'uniqueness_user_id,event_type', count(*) / any_value(n) >= 0.05, round(count(*) / any_value(n), 4)
        FROM (SELECT DISTINCT user_id, event_type FROM {_GAPS}), n
        UNION ALL SELECT 'uniqueness_event_type,value', count(*) / any_value(n) >= 0.4, round(count(*) / any_value(n), 4)
        FROM (SELECT DISTINCT event_type, value FROM {_GAPS}), n"""),
    "q3_value_range": Check(ranges, f"""
        SELECT 'range_value' AS check_name, min(value) >= 0 AND max(value) <= 100 AS passed, min(value) AS low, max(value) AS high
        FROM {_GAPS}
        UNION ALL SELECT 'range_user_id', min(user_id) >= 0, min(user_id), max(user_id) FROM {_GAPS}
        UNION ALL SELECT 'range_event_id', max(event_id) <= 10, min(event_id), max(event_id) FROM {_GAPS}
        UNION ALL SELECT 'range_event_type', false, NULL, NULL"""),
    "q4_q5_row_count_schema": Check(row_counts, """
        SELECT 0 AS position, 'row_count' AS check_name, count(*) >= 1 AS passed, CAST(count(*) AS DOUBLE) AS value FROM lineitem
        UNION ALL SELECT 1, 'row_count', count(*) BETWEEN 1 AND 5, CAST(count(*) AS DOUBLE) FROM lineitem
        UNION ALL SELECT 2, 'schema', false, 1.0
        UNION ALL SELECT 3, 'schema', true, 0.0"""),
    "q6_custom_checks": Check(predicates, """
        SELECT 'discount_below_tax' AS check_name, sum(CASE WHEN l_discount <= l_tax THEN 0 ELSE 1 END) <= 10 AS passed,
               CAST(sum(CASE WHEN l_discount <= l_tax THEN 0 ELSE 1 END) AS DOUBLE) AS value FROM lineitem
        UNION ALL SELECT 'positive_quantity', sum(CASE WHEN l_quantity > 0 THEN 0 ELSE 1 END) = 0,
               sum(CASE WHEN l_quantity > 0 THEN 0 ELSE 1 END) FROM lineitem
        UNION ALL SELECT 'returned_in_time', sum(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END) = 0,
               sum(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END) FROM lineitem
        UNION ALL SELECT 'whole_table', true, NULL"""),
    "q7_report": Check(totals, f"""
        WITH r AS (SELECT count(*) >= 1 AS passed FROM {_GAPS}
                   UNION ALL SELECT avg(CASE WHEN event_type IS NULL THEN 1 ELSE 0 END) <= 0.1 FROM {_GAPS}
                   UNION ALL SELECT count(DISTINCT event_id) = count(*) FROM {_GAPS}
                   UNION ALL SELECT min(value) >= 0 AND max(value) <= 5 FROM {_GAPS}
                   UNION ALL SELECT false UNION ALL SELECT false)
        SELECT 'events' AS table_name, 'silver' AS layer, count(*) AS total_checks,
               count(*) FILTER (WHERE passed) AS passed_checks, count(*) FILTER (WHERE NOT passed) AS failed_checks,
               round(100 * count(*) FILTER (WHERE passed) / count(*), 2) AS pass_rate
        FROM r"""),
    "q8_layer_presets": Check(presets, """
        WITH t AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(DISTINCT o_custkey) AS d FROM orders)
        SELECT unnest(['bronze', 'silver', 'gold']) AS layer, 'row_count' AS check_name, n >= 1 AS passed, n AS value FROM t
        UNION ALL SELECT 'silver', 'uniqueness_o_custkey', d = n, round(d / n, 4) FROM t"""),
    "q9_freshness": Check(freshness, """
        SELECT 0 AS position, 'freshness_ts' AS check_name,
               max(ts) >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR AS passed FROM events
        UNION ALL SELECT 1, 'freshness_ts', max(ts) >= TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 24 HOUR FROM events"""),
    "q10_orphan_rate": Check(references, """
        SELECT CAST(count(*) FILTER (WHERE o_orderkey IS NULL) AS BIGINT) AS orphans, count(*) AS total,
               round(count(*) FILTER (WHERE o_orderkey IS NULL) / count(*), 6) AS rate
        FROM lineitem LEFT JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')
          ON l_orderkey = o_orderkey"""),
    "q10_reference_checks": Check(reference_checks, """
        WITH t AS (SELECT avg(CASE WHEN l.doc_id IS NULL THEN 1 ELSE 0 END) AS rate, CAST(count(*) AS DOUBLE) AS n
                   FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id))
        SELECT 0 AS position, 'referential_integrity_doc_id' AS check_name, rate <= 0.1 AS passed, round(rate, 4) AS value FROM t
        UNION ALL SELECT 1, 'referential_integrity_doc_id', true, 0.0
        UNION ALL SELECT 2, 'row_count', n >= 1, n FROM t"""),
}
