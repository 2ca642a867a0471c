"""Catalog logs derived from the tables."""

from pyspark.sql import functions as F

from tierlake.checks import Check, table
from tierlake.operators import catalog as C
from tierlake.session import scratch_root
from tierlake.sources.catalogstore import Catalog
from tierlake.sources.snapshots import write_snapshot


def _table_log(spark, folder):
    """Events as registrations of per-user tables, one layer per event type."""
    return table(spark, folder, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("name"), F.col("event_type").alias("layer"),
        F.col("props").alias("location"), F.array(F.lit("day")).alias("partition_keys"),
        F.concat(F.lit("value "), F.floor("value").cast("string")).alias("description"), F.col("event_id").alias("seq"))


def _column_log(spark, folder):
    """Lines as registrations of columns: an order is a table, a line number a column."""
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("table_name"), F.lit("silver").alias("layer"),
        F.concat(F.lit("line_"), F.col("l_linenumber").cast("string")).alias("column_name"),
        F.col("l_returnflag").alias("data_type"), F.col("l_linestatus").alias("description"),
        (F.col("l_linestatus") == "O").alias("is_nullable"), (F.col("l_returnflag") == "A").alias("is_partition_key"),
        (F.round(F.col("l_extendedprice") * 100).cast("long") * 1000000 + F.col("l_partkey")).alias("seq"))


def tables(spark, folder):
    return C.current_tables(_table_log(spark, folder)).drop("partition_keys")


def columns(spark, folder):
    return C.current_columns(_column_log(spark, folder))


_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate")


def statistics(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn(
        "l_returnflag", F.nullif("l_returnflag", F.lit("A"))).withColumn(
        "l_tax", F.when(F.col("l_linestatus") == "O", F.lit(float("nan"))).otherwise(F.col("l_tax")))
    return C.column_statistics(lines)


def text_statistics(spark, folder):
    return C.column_statistics(table(spark, folder, "documents"), ["doc_id", "text", "lang", "source"])


def _version_log(spark, folder):
    """A schema version per user and year half: event type to a type word."""
    events = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("table_name"), F.lit("silver").alias("layer"),
        F.when(F.dayofmonth("ts") <= 15, "1.0").otherwise("2.0").alias("version"), "value", "event_id",
        F.concat("event_type", F.lit("_"), (F.col("event_id") % 5).cast("string")).alias("event_type"))
    types = events.groupBy("table_name", "layer", "version", "event_type").agg(
        F.when(F.max("value") > 20, "double").otherwise("bigint").alias("type"), F.max("event_id").alias("last"))
    # at most five entries per event type are collected
    return types.groupBy("table_name", "layer", "version").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "type"))).alias("schema"), F.max("last").alias("seq"))


_TYPES_SQL = """
    SELECT CAST(user_id AS VARCHAR) AS table_name, CASE WHEN day(ts) <= 15 THEN '1.0' ELSE '2.0' END AS version,
           event_type || '_' || (event_id % 5) AS column_name, CASE WHEN max(value) > 20 THEN 'double' ELSE 'bigint' END AS type,
           max(event_id) AS last
    FROM events GROUP BY ALL"""
_CHANGES_SQL = f"""
    WITH t AS ({_TYPES_SQL}), paired AS (SELECT table_name FROM t GROUP BY table_name HAVING count(DISTINCT version) = 2)
    SELECT table_name, 'silver' AS layer, column_name, from_type, to_type,
           CASE WHEN from_type IS NULL THEN 'added' WHEN to_type IS NULL THEN 'removed' ELSE 'type_changed' END AS change
    FROM (SELECT table_name, column_name, type AS from_type FROM t WHERE version = '1.0')
    FULL JOIN (SELECT table_name, column_name, type AS to_type FROM t WHERE version = '2.0') USING (table_name, column_name)
    WHERE from_type IS DISTINCT FROM to_type AND table_name IN (SELECT table_name FROM paired)"""


def versions(spark, folder):
    log = _version_log(spark, folder)
    return C.versions_of(log, "7", "silver").select("version", F.size("schema").alias("columns"), "seq")


def changes(spark, folder):
    return C.compare_versions(_version_log(spark, folder), "1.0", "2.0")


def compatible(spark, folder):
    return C.compatibility(C.compare_versions(_version_log(spark, folder), "1.0", "2.0"))


def newest(spark, folder):
    latest = C.latest_schemas(_version_log(spark, folder))
    return latest.select("table_name", "version", F.size("schema").alias("columns"), F.col("schema")["click"].alias("click"))


def _edges(spark, folder):
    """Every line an edge from its supplier to its part."""
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("source_table"), F.lit("silver").alias("source_layer"),
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("target_table"), F.lit("gold").alias("target_layer"))


def known(spark, folder):
    suppliers = table(spark, folder, "supplier").where("s_acctbal > 0").select(
        F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")).alias("name"), F.lit("silver").alias("layer"))
    parts = table(spark, folder, "part").where("p_size > 20").select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("name"), F.lit("gold").alias("layer"))
    kept = C.known_edges(_edges(spark, folder), suppliers.unionByName(parts))
    return kept.groupBy("source_table", "target_table").agg(F.count(F.lit(1)).alias("edges"))


def upstream(spark, folder):
    return C.neighbours(_edges(spark, folder), "part_5", "gold").unionByName(
        C.neighbours(_edges(spark, folder), "supplier_3", "silver"))


def found(spark, folder):
    """Documents as tables with their whole text as description, pages as columns."""
    documents = table(spark, folder, "documents").select(
        F.concat("source", F.lit("_"), F.col("doc_id").cast("string")).alias("name"), F.col("lang").alias("layer"),
        F.col("text").alias("description"))
    pages = table(spark, folder, "pages").select(
        F.col("url").alias("column_name"), F.lit("pages").alias("table_name"), F.lit("bronze").alias("layer"),
        F.col("html").alias("description"))
    hits = C.search(documents, pages, "LiC_nse")
    return hits.select("name", "table_name", "layer", "match_type", F.md5("description").alias("description"))


def published(spark, folder):
    """Customers published from a silver snapshot; what the catalog then knows of each column."""
    root = scratch_root(spark)
    write_snapshot(table(spark, folder, "customer"), root, "silver", "customer")
    catalog = Catalog(spark, root)
    catalog.register_table("customer", "bronze", "inbox")
    catalog.publish("silver", "customer", [("customer", "bronze")], "Customers")
    columns = catalog.columns().select("table_name", "layer", "column_name", "data_type")
    return columns.join(catalog.column_stats(), ["table_name", "layer", "column_name"])


CHECKS = {
    "k1_current_tables": Check(tables, """
        SELECT 'user_' || user_id AS name, event_type AS layer, arg_max(props, event_id) AS location,
               arg_max('value ' || CAST(floor(value) AS BIGINT), event_id) AS description,
               min(event_id) AS created_seq, max(event_id) AS updated_seq
        FROM events GROUP BY user_id, event_type"""),
    "k2_current_columns": Check(columns, """
        SELECT 'order_' || l_orderkey AS table_name, 'silver' AS layer, 'line_' || l_linenumber AS column_name,
               arg_max(l_returnflag, seq) AS data_type, arg_max(l_linestatus, seq) AS description,
               arg_min(l_linestatus = 'O', seq) AS is_nullable, arg_min(l_returnflag = 'A', seq) AS is_partition_key
        FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) * 1000000 + l_partkey AS seq FROM lineitem) GROUP BY l_orderkey, l_linenumber"""),
    "k3_column_statistics": Check(statistics, """
        WITH l AS (SELECT * REPLACE (nullif(l_returnflag, 'A') AS l_returnflag,
                                     CASE WHEN l_linestatus <> 'O' THEN l_tax END AS l_tax) FROM lineitem)
        """ + " UNION ALL ".join(f"""
        SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
               count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value,
               CAST(max({c}) AS VARCHAR) AS max_value FROM l""" for c in _LINE_COLUMNS)),
    "k3_text_statistics": Check(text_statistics, """
        SELECT 'doc_id' AS column_name, count(*) AS row_count, CAST(0 AS BIGINT) AS null_count,
               count(DISTINCT doc_id) AS distinct_count, CAST(min(doc_id) AS VARCHAR) AS min_value,
               CAST(max(doc_id) AS VARCHAR) AS max_value FROM documents
        UNION ALL SELECT 'text', count(*), 0, count(DISTINCT text), min(text), max(text) FROM documents
        UNION ALL SELECT 'lang', count(*), 0, count(DISTINCT lang), min(lang), max(lang) FROM documents
        UNION ALL SELECT 'source', count(*), 0, count(DISTINCT source), min(source), max(source) FROM documents"""),
    "k5_versions": Check(versions, f"""
        SELECT version, CAST(count(*) AS INTEGER) AS columns, max(last) AS seq FROM ({_TYPES_SQL})
        WHERE table_name = '7' GROUP BY version"""),
    "k6_known_edges": Check(known, """
        SELECT 'supplier_' || l_suppkey AS source_table, 'part_' || l_partkey AS target_table, count(*) AS edges
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal > 0
        JOIN part ON p_partkey = l_partkey AND p_size > 20 GROUP BY l_suppkey, l_partkey"""),
    "k7_search": Check(found, """
        SELECT source || '_' || doc_id AS name, source || '_' || doc_id AS table_name, lang AS layer, 'table' AS match_type,
               md5(text) AS description FROM documents
        WHERE source || '_' || doc_id ILIKE '%lic_nse%' OR text ILIKE '%lic_nse%'
        UNION ALL SELECT url, 'pages', 'bronze', 'column', md5(html) FROM pages
        WHERE url ILIKE '%lic_nse%' OR html ILIKE '%lic_nse%'"""),
    "k8_neighbours": Check(upstream, """
        SELECT 'upstream' AS direction, 'supplier_' || l_suppkey AS name, 'silver' AS layer FROM lineitem WHERE l_partkey = 5
        UNION ALL SELECT 'downstream', 'part_' || l_partkey, 'gold' FROM lineitem WHERE l_suppkey = 3"""),
    "k10_compare_versions": Check(changes, _CHANGES_SQL),
    "k10_compatibility": Check(compatible, f"""
        SELECT table_name, layer, count(*) FILTER (WHERE change = 'added') AS added,
               count(*) FILTER (WHERE change = 'removed') AS removed,
               count(*) FILTER (WHERE change = 'type_changed') AS type_changed,
               count(*) FILTER (WHERE change <> 'added') = 0 AS is_compatible
        FROM ({_CHANGES_SQL}) GROUP BY table_name, layer"""),
    "k11_latest_schema": Check(newest, f"""
        WITH t AS ({_TYPES_SQL}), v AS (SELECT table_name, version, count(*) AS columns, max(last) AS seq,
                                               max(type) FILTER (WHERE column_name = 'click') AS click
                                        FROM t GROUP BY table_name, version)
        SELECT table_name, version, CAST(columns AS INTEGER) AS columns, click
        FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY seq DESC) AS rn FROM v) WHERE rn = 1"""),
    "k4_k9_publish": Check(published, """
        SELECT 'customer' AS table_name, 'silver' AS layer, 'c_custkey' AS column_name, 'bigint' AS data_type, count(*) AS row_count, CAST(0 AS BIGINT) AS null_count, count(DISTINCT c_custkey) AS distinct_count, CAST(min(c_custkey) AS VARCHAR) AS min_value, CAST(max(c_custkey) AS VARCHAR) AS max_value FROM customer
        UNION ALL SELECT 'customer', 'silver', 'c_name', 'string', count(*), 0, count(DISTINCT c_name), CAST(min(c_name) AS VARCHAR), CAST(max(c_name) AS VARCHAR) FROM customer
        UNION ALL SELECT 'customer', 'silver', 'c_nationkey', 'int', count(*), 0, count(DISTINCT c_nationkey), CAST(min(c_nationkey) AS VARCHAR), CAST(max(c_nationkey) AS VARCHAR) FROM customer
        UNION ALL SELECT 'customer', 'silver', 'c_acctbal', 'double', count(*), 0, count(DISTINCT c_acctbal), CAST(min(c_acctbal) AS VARCHAR), CAST(max(c_acctbal) AS VARCHAR) FROM customer
        UNION ALL SELECT 'customer', 'silver', 'c_mktsegment', 'string', count(*), 0, count(DISTINCT c_mktsegment), CAST(min(c_mktsegment) AS VARCHAR), CAST(max(c_mktsegment) AS VARCHAR) FROM customer"""),
}
