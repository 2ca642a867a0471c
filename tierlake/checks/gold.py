"""Dimensions and facts."""

from pyspark.sql import functions as F

from tierlake.checks import Check, table
from tierlake.operators.cleaning import keep_last
from tierlake.operators.dimension import dimension, distinct_tuples
from tierlake.operators.fact import aggregate, fact, lookup_key
from tierlake.plans.gold import create_dimension_table, create_fact_table
from tierlake.session import scratch_root
from tierlake.sources.snapshots import read_latest, write_snapshot


def distinct(spark, folder):
    return distinct_tuples(table(spark, folder, "part"), ["p_brand", "absent", "p_type"])


def keyed(spark, folder):
    return dimension(table(spark, folder, "orders"), ["o_custkey", "o_orderpriority"], "order_sk")


def first_seen(spark, folder):
    return dimension(table(spark, folder, "lineitem"), ["l_partkey", "l_returnflag"], "part_sk", "l_shipdate")


def labelled(spark, folder):
    labels = dimension(table(spark, folder, "labels"), ["doc_id", "quality", "toxic"], "label_sk")
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return lookup_key(documents, labels, "doc_id", "label_fk")


def last_duplicate(spark, folder):
    orders = table(spark, folder, "orders")
    dim = dimension(orders, ["o_custkey", "o_orderpriority"], "order_sk")
    lines = orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))
    return lookup_key(lines, dim, "o_custkey", "order_fk")


def _lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        F.nullif("l_returnflag", F.lit("A")).alias("l_returnflag"), "l_linestatus", "l_quantity", "l_extendedprice",
        "l_discount", "l_suppkey", "l_orderkey", "l_tax", "l_shipdate", "l_partkey",
        F.when(F.col("l_linestatus") == "O", F.col("l_linenumber")).alias("l_linenumber"))


def grouped(spark, folder):
    result = aggregate(_lines(spark, folder), ["l_returnflag", "l_linestatus"], {
        "l_quantity": "sum", "l_extendedprice": "avg", "l_discount": "min", "l_tax": "max", "l_orderkey": "count",
        "l_suppkey": "nunique", "l_linenumber": "sum", "absent": "sum"})
    return result.withColumns({c: F.round(c, 2) for c in ("l_quantity", "l_extendedprice")})


def spread(spark, folder):
    result = aggregate(_lines(spark, folder), ["l_suppkey"], {
        "l_quantity": "std", "l_linenumber": "var", "l_tax": "mean", "l_extendedprice": "median"})
    return result.withColumns({c: F.round(c, 4) for c in ("l_quantity", "l_linenumber", "l_tax", "l_extendedprice")})


def ordered(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_type", "value", "event_id")
    return aggregate(events, ["user_id"], {"event_type": "first", "value": "last"}, order_by="event_id")


def median(spark, folder):
    return aggregate(_lines(spark, folder), ["l_returnflag"], {"l_extendedprice": "median", "l_linenumber": "median"})


def sales(spark, folder):
    """Flagship: keep-last orders, customer dimension, key lookup, revenue per customer and status."""
    orders = keep_last(table(spark, folder, "orders"), ["o_custkey", "o_orderdate"], ["o_orderkey"])
    customers = dimension(orders, ["o_custkey"], "customer_sk")
    result = fact(
        orders, {"dim_customer": (customers, "o_custkey", "customer_fk")},
        {"o_totalprice": "sum", "o_orderkey": "count"}, ["customer_fk", "o_orderstatus"])
    return result.withColumn("o_totalprice", F.round("o_totalprice", 2))


def unmatched_groups(spark, folder):
    """A fact grouped by a foreign key drops the rows that found no dimension row."""
    labels = dimension(table(spark, folder, "labels"), ["doc_id"], "label_sk")
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return fact(documents, {"dim_label": (labels, "doc_id", "label_fk")}, {"n_chars": "sum"}, ["label_fk", "lang"])


def pass_through(spark, folder):
    segments = dimension(table(spark, folder, "customer"), ["c_mktsegment"], "segment_sk")
    return fact(table(spark, folder, "customer"), {"dim_segment": (segments, "c_mktsegment", "segment_fk")})


def gold_tables(spark, folder):
    """Silver snapshot, gold dimension, gold fact: written, then read back."""
    root = scratch_root(spark)
    write_snapshot(table(spark, folder, "orders"), root, "silver", "orders")
    create_dimension_table(spark, root, "dim_priority", "orders", ["o_orderpriority"], "priority_sk")
    create_fact_table(
        spark, root, "fact_orders", "orders", ["o_totalprice", "o_orderkey"],
        {"dim_priority": ("o_orderpriority", "priority_fk")}, {"o_totalprice": "max", "o_orderkey": "count"},
        ["priority_fk", "o_custkey"])
    return read_latest(spark, root, "gold", "fact_orders")


_DIM = """
    SELECT row_number() OVER (ORDER BY o_custkey, o_orderpriority) AS order_sk, o_custkey, o_orderpriority
    FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders)"""
_LINES = """
    SELECT nullif(l_returnflag, 'A') AS l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_discount,
           l_suppkey, l_orderkey, l_tax, CASE WHEN l_linestatus = 'O' THEN l_linenumber END AS l_linenumber
    FROM lineitem"""

CHECKS = {
    "g1_distinct_tuples": Check(distinct, "SELECT DISTINCT p_brand, p_type FROM part"),
    "g2_dense_key": Check(keyed, _DIM),
    "g3_dimension_first_seen": Check(first_seen, """
        SELECT row_number() OVER (ORDER BY seen, l_partkey, l_returnflag) AS part_sk, l_partkey, l_returnflag
        FROM (SELECT l_partkey, l_returnflag, min(l_shipdate) AS seen FROM lineitem GROUP BY ALL)"""),
    "g4_lookup": Check(labelled, """
        SELECT d.doc_id, lang, n_chars, label_sk AS label_fk FROM documents d
        LEFT JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id, quality, toxic) AS label_sk
                   FROM (SELECT DISTINCT doc_id, quality, toxic FROM labels)) l USING (doc_id)"""),
    "g4_lookup_last_duplicate": Check(last_duplicate, f"""
        SELECT o_orderkey, o.o_custkey, order_fk
        FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey FROM orders) o
        LEFT JOIN (SELECT o_custkey, max(order_sk) AS order_fk FROM ({_DIM}) GROUP BY o_custkey) d
               ON o.o_custkey = d.o_custkey"""),
    "g5_aggregate": Check(grouped, f"""
        SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS l_quantity,
               round(avg(l_extendedprice), 2) AS l_extendedprice, min(l_discount) AS l_discount,
               max(l_tax) AS l_tax, count(l_orderkey) AS l_orderkey, count(DISTINCT l_suppkey) AS l_suppkey,
               CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS l_linenumber
        FROM ({_LINES}) WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag, l_linestatus"""),
    "g5_aggregate_spread": Check(spread, f"""
        SELECT l_suppkey, round(stddev_samp(l_quantity), 4) AS l_quantity,
               round(var_samp(l_linenumber), 4) AS l_linenumber, round(avg(l_tax), 4) AS l_tax,
               round(median(l_extendedprice), 4) AS l_extendedprice
        FROM ({_LINES}) GROUP BY l_suppkey"""),
    "g5_aggregate_ordered": Check(ordered, """
        SELECT user_id, arg_min(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
        FROM events GROUP BY user_id"""),
    "g5_median": Check(median, f"""
        SELECT l_returnflag, median(l_extendedprice) AS l_extendedprice,
               CAST(median(l_linenumber) AS DOUBLE) AS l_linenumber
        FROM ({_LINES}) WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag"""),
    "g6_fact_sales": Check(sales, """
        WITH kept AS (SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
                FROM orders) WHERE rn = 1),
             dim AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS customer_fk
                     FROM (SELECT DISTINCT o_custkey FROM kept))
        SELECT customer_fk, o_orderstatus, round(sum(o_totalprice), 2) AS o_totalprice, count(o_orderkey) AS o_orderkey
        FROM kept JOIN dim USING (o_custkey) GROUP BY customer_fk, o_orderstatus"""),
    "g6_fact_unmatched": Check(unmatched_groups, """
        SELECT label_fk, lang, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents
        JOIN (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS label_fk
              FROM (SELECT DISTINCT doc_id FROM labels)) USING (doc_id)
        GROUP BY label_fk, lang"""),
    "g6_fact_ungrouped": Check(pass_through, """
        SELECT c.*, segment_fk FROM customer c
        JOIN (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS segment_fk
              FROM (SELECT DISTINCT c_mktsegment FROM customer)) USING (c_mktsegment)"""),
    "w2_gold_tables": Check(gold_tables, """
        SELECT priority_fk, o_custkey, max(o_totalprice) AS o_totalprice, count(o_orderkey) AS o_orderkey
        FROM orders JOIN (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) AS priority_fk
                          FROM (SELECT DISTINCT o_orderpriority FROM orders)) USING (o_orderpriority)
        GROUP BY priority_fk, o_custkey"""),
}
