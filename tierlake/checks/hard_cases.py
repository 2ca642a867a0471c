"""Queries on what is easily got wrong: CSV payloads, ties, long ranges, shuffled lookups, result files."""

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from tierlake.checks import Check, gold, quality, table
from tierlake.functions.payload import record_count
from tierlake.operators.scans import asof_join
from tierlake.operators.joins import range_join
from tierlake.operators.metrics import layer_health, stored_mb, table_health
from tierlake.plans.sqlsession import SqlSession
from tierlake.session import shared_folder
from tierlake.sources.landing import payload_records
from tierlake.sources.results import write_csv, write_json


def _order_files(spark, folder):
    """Each order's lines as CSV text: a quote inside a cell, a quoted cell over two lines, an empty row."""
    lines = table(spark, folder, "lineitem")
    cells = [F.col("l_linenumber").cast("string"), F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit('" wide')),
             F.concat(F.lit('"'), "l_returnflag", F.lit(', ""'), "l_linestatus", F.lit('""\n"'))]
    rows = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.concat_ws(",", *cells))).alias("rows"))
    text = F.concat(F.lit("n,size,size\n"), F.array_join("rows", "\n"), F.lit("\n,,\n\n"))
    return rows.select("l_orderkey", text.alias("payload"))


def csv_payloads(spark, folder):
    records = payload_records(_order_files(spark, folder), "csv")
    cells = {n: F.get_json_object("payload", f"$['{n}']") for n in ("n", "size", "size.1")}
    return records.select("l_orderkey", *[c.alias(n.replace(".", "_")) for n, c in cells.items()])


def csv_counts(spark, folder):
    return _order_files(spark, folder).select("l_orderkey", record_count(F.col("payload"), F.lit("csv")).alias("records"))


def _hours(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_id") % 11 > 0, F.col("user_id")).alias("user_id"), "event_type", "value",
        F.date_trunc("day", "ts").alias("day"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("name"))


def _asof_ties(tie):
    def run(spark, folder):
        events = _hours(spark, folder)
        buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "day")
        clicks = events.where("event_type = 'click'").select("user_id", "day", "name", (F.col("value") + F.col("event_id") / 1e7).alias("score"))
        return asof_join(buys, clicks, "user_id", "day", {"name": "click"}, tie)

    return run


def _asof_sql(tie):
    return f"""
        WITH e AS (SELECT event_id, CASE WHEN event_id % 11 > 0 THEN user_id END AS user_id, event_type,
                          date_trunc('day', ts) AS day, 'e' || event_id AS name, value + event_id / 1e7 AS score FROM events)
        SELECT b.event_id, b.user_id, b.day, arg_max(c.name, (c.day, c.{tie})) AS click
        FROM (SELECT * FROM e WHERE event_type = 'purchase') b
        LEFT JOIN (SELECT * FROM e WHERE event_type = 'click') c ON b.user_id = c.user_id AND b.day >= c.day GROUP BY ALL"""


def long_ranges(spark, folder):
    """Customers' bands around their balance; one in 97 is a million wide."""
    width = F.when(F.col("c_custkey") % 97 == 0, F.lit(1e6)).otherwise(F.lit(2.0))
    bands = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("low"), (F.col("c_acctbal") + width).alias("high"))
    return range_join(table(spark, folder, "supplier").select("s_suppkey", "s_acctbal"), bands, "s_acctbal", "low", "high", 2.0)


@contextmanager
def _no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _shuffled(run):
    def query(spark, folder):
        with _no_broadcast(spark):
            return run(spark, folder)

    return query


def result_files(spark, folder):
    """Customers written as CSV and as JSON, read back and compared; both sides' rows stay."""
    root = f"{shared_folder(spark)}/results-{uuid.uuid4().hex}"
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("c_name"), "c_acctbal")
    write_csv(rows, f"{root}/csv")
    write_json(rows, f"{root}/json")
    cells = spark.read.schema(rows.schema).options(header=True, escape='"').csv(f"{root}/csv")
    texts = spark.read.schema(rows.schema).json(f"{root}/json")
    return cells.withColumn("format", F.lit("csv")).unionAll(texts.withColumn("format", F.lit("json")))


def _session(spark, folder):
    for name in ("orders", "customer"):
        table(spark, folder, name).createOrReplaceTempView(name)
    return SqlSession(spark, "unused")


def explained(spark, folder):
    """What a plan says of a join: what it reads and whether it joins on equality."""
    session = _session(spark, folder)
    plan = session.explain("SELECT c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 1000")
    facts = {"tables": plan.count("\n(1) Scan parquet") + plan.count("\n(4) Scan parquet"), "joins": int("HashJoin" in plan or "SortMergeJoin" in plan),
             "pushed": int("GreaterThan(o_totalprice,1000" in plan), "columns_read": int("c_mktsegment" not in plan)}
    scanned = table(spark, folder, "orders").agg(F.count(F.lit(1)).alias("orders"))
    return scanned.select("orders", *[F.lit(int(v > 0)).alias(k) for k, v in facts.items()])


def views(spark, folder):
    """The views of a session over two layers, with their rows."""
    from tierlake.session import scratch_root
    from tierlake.sources.snapshots import write_snapshot
    root = scratch_root(spark)
    write_snapshot(table(spark, folder, "orders"), root, "silver", "shop.orders-eu")
    write_snapshot(table(spark, folder, "customer"), root, "gold", "dim_customer")
    session = SqlSession(spark, root)
    session.register_all_tables()
    counts = [spark.table(v).agg(F.lit(v).alias("view"), F.count(F.lit(1)).alias("rows")) for v in session.list_tables()]
    return counts[0].unionAll(counts[1])


def health_with_size(spark, folder):
    """Health of three tables with their stored size, here as whether it is that of their files."""
    kinds = (("events", "bronze", "ts"), ("orders", "silver", "o_orderdate"), ("lineitem", "gold", "l_shipdate"))
    rows = layer_health([table_health(table(spark, folder, t), t, layer, at, F.lit(stored_mb(spark, f"{folder}/{t}.parquet")))
                         for t, layer, at in kinds])
    return rows.select("table", "layer", "record_count", (F.col("size_mb") > 0).alias("has_size"))


CHECKS = {
    "b2_csv_payloads": Check(csv_payloads, """
        SELECT l_orderkey, CAST(l_linenumber AS VARCHAR) AS n, CAST(CAST(trunc(l_quantity) AS INT) AS VARCHAR) || '" wide' AS size,
               l_returnflag || ', "' || l_linestatus || '"' || chr(10) AS size_1 FROM lineitem
        UNION ALL SELECT DISTINCT l_orderkey, NULL, NULL, NULL FROM lineitem"""),
    "b5_csv_counts": Check(csv_counts, """
        SELECT l_orderkey, count(*) + 1 AS records FROM lineitem GROUP BY l_orderkey"""),
    "s13_asof_double_tie": Check(_asof_ties("score"), _asof_sql("score")),
    "s13_asof_text_tie": Check(_asof_ties("name"), _asof_sql("name")),
    "s12_long_ranges": Check(long_ranges, """
        SELECT s_suppkey, s_acctbal, c_custkey, low, high FROM supplier
        JOIN (SELECT c_custkey, c_acctbal AS low, c_acctbal + CASE WHEN c_custkey % 97 = 0 THEN 1e6 ELSE 2.0 END AS high FROM customer)
          ON s_acctbal >= low AND s_acctbal < high"""),
    "g4_lookup_shuffled": Check(_shuffled(gold.last_duplicate), gold.CHECKS["g4_lookup_last_duplicate"].sql),
    "q10_orphan_rate_shuffled": Check(_shuffled(quality.references), quality.CHECKS["q10_orphan_rate"].sql),
    "w3_result_files": Check(result_files, """
        SELECT c_custkey, c_name || ', "' || c_mktsegment || '"' AS c_name, c_acctbal, format
        FROM customer, (VALUES ('csv'), ('json')) AS f(format)"""),
    "s5_explain": Check(explained, """
        SELECT count(*) AS orders, 1 AS tables, 1 AS joins, 1 AS pushed, 1 AS columns_read FROM orders"""),
    "s6_list_views": Check(views, """
        SELECT 'silver_shop_orders_eu' AS "view", count(*) AS "rows" FROM orders
        UNION ALL SELECT 'gold_dim_customer', count(*) FROM customer"""),
    "d1_layer_health_size": Check(health_with_size, """
        SELECT 'events' AS "table", 'bronze' AS layer, count(*) AS record_count, true AS has_size FROM events
        UNION ALL SELECT 'orders', 'silver', count(*), true FROM orders
        UNION ALL SELECT 'lineitem', 'gold', count(*), true FROM lineitem"""),
}
