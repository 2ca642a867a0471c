"""Partitions, landing and reading back."""

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from tierlake.checks import Check, table
from tierlake.functions.paths import object_key, parse_key, partition_filter, partition_values
from tierlake.functions.payload import record_count, short_hash
from tierlake.functions.typing import blank_tokens, cast_text, text_types
from tierlake.operators.cleaning import keep_last
from tierlake.plans.silver import process_table
from tierlake.session import scratch_root
from tierlake.sources.landing import (
    ingest_files, ingest_payloads, ingested_files, list_ingested, not_landed, payload_records, read_bronze,
)
from tierlake.sources.records import parse_records, union_records
from tierlake.sources.snapshots import latest_rows, read_latest, write_snapshot

_DAY = datetime(2024, 1, 15, tzinfo=timezone.utc)


def keys(spark, folder):
    orders = table(spark, folder, "orders")
    source = F.when(F.col("o_orderstatus") != "P", F.lower("o_orderstatus"))
    name = F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"), F.lit(".json"))
    return orders.select("o_orderkey", object_key("bronze", "orders", name, F.col("o_orderdate"), source).alias("key"))


def parsed_keys(spark, folder):
    keyed = keys(spark, folder)
    parts = parse_key(F.col("key"))
    names = ("layer", "table", "source", "year", "month", "day", "filename")
    return keyed.select("o_orderkey", *[parts[n].alias(n) for n in names])


def pruned(spark, folder):
    orders = table(spark, folder, "orders")
    values = partition_values(F.col("o_orderdate"))
    dated = orders.withColumns({k: v.cast("int") for k, v in values.items()}).withColumn("source", F.col("o_orderstatus"))
    kept = dated.where(partition_filter(date(1996, 11, 15), date(1997, 2, 10), "F"))
    return kept.select("o_orderkey", "source", "year", "month", "day")


def hashes(spark, folder):
    return table(spark, folder, "documents").select("doc_id", short_hash(F.col("text")).alias("file_hash"))


def _as_files(documents):
    return documents.select(
        F.concat_ws("/", F.lit("bronze"), "source", "lang").alias("_source_file"), F.md5("text").alias("_content_md5"))


def fresh(spark, folder):
    """Documents as incoming files, those with labels as landed before."""
    documents = table(spark, folder, "documents")
    labelled = documents.join(table(spark, folder, "labels"), "doc_id", "left_semi")
    incoming = _as_files(documents).groupBy("_source_file", "_content_md5").agg(F.count(F.lit(1)).alias("copies"))
    return not_landed(incoming, _as_files(labelled).distinct())


def counts(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    events = table(spark, folder, "events").select("event_id", F.concat(F.lit("[1, "), "props", F.lit("]")).alias("text"))
    lines = documents.select(F.lit("jsonl").alias("format"), F.col("doc_id").alias("id"), "text")
    rows = documents.select(F.lit("csv").alias("format"), F.col("doc_id").alias("id"), "text")
    arrays = events.select(F.lit("json").alias("format"), F.col("event_id").alias("id"), "text")
    contents = lines.unionByName(rows).unionByName(arrays)
    return contents.select("format", "id", record_count(F.col("text"), F.col("format")).alias("record_count"))


def exploded(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.col("text").alias("payload"))
    return payload_records(documents, "jsonl")


def _event_records(spark, folder):
    events = table(spark, folder, "events")
    return events.select(
        F.to_json(F.struct("event_id", "user_id", "event_type", "value", F.col("props").alias("note"))).alias("payload"),
        F.lit("events.jsonl").alias("_source_file"), F.lit(0).cast("long").alias("_block_pos"),
        F.col("event_id").alias("_row_pos"), F.lit("jsonl").alias("_original_format"))


def json_parsed(spark, folder):
    return parse_records(_event_records(spark, folder)).drop("_source_file", "_block_pos", "_row_pos")


def csv_typed(spark, folder):
    lines = table(spark, folder, "lineitem")
    cells = lines.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", "NA").otherwise(F.col("l_partkey").cast("string")).alias("part"),
        F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_discount").cast("string")).alias("discount"),
        F.when(F.col("l_linestatus") == "O", "True").otherwise("False").alias("open"),
        F.concat("l_returnflag", "l_linestatus").alias("flags"))
    blanked = blank_tokens(cells)
    return cast_text(blanked, text_types(blanked, ["part", "discount", "open", "flags"]))


def by_name(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    nations = table(spark, folder, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("balance"))
    return union_records([customers, suppliers, nations])


def newest(spark, folder):
    return latest_rows(table(spark, folder, "orders"), "o_orderdate")


def snapshots(spark, folder):
    """Two snapshots of a table; the reader takes the second."""
    root, orders = scratch_root(spark), table(spark, folder, "orders")
    write_snapshot(orders, root, "silver", "orders", at=datetime(2024, 1, 1, tzinfo=timezone.utc))
    write_snapshot(keep_last(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]), root, "silver", "orders", at=_DAY)
    return read_latest(spark, root, "silver", "orders")


def landed_to_silver(spark, folder):
    """Every order as one named JSON payload, landed in bronze, cleaned and deduplicated into silver."""
    root = scratch_root(spark)
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    name = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lit(".json"))
    payloads = orders.select(F.to_json(F.struct("*")).alias("payload"), name.alias("filename"))
    ingest_payloads(payloads, root, "orders", "shop", "json", at=_DAY)
    process_table(spark, root, "orders", schema={"o_custkey": "str"}, dedup_columns=["o_custkey"])
    return read_latest(spark, root, "silver", "orders")


def files_to_bronze(spark, folder):
    """Events written as CSV, landed from the files, typed from their text."""
    root = scratch_root(spark)
    events = table(spark, folder, "events").select("event_id", "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "value", "props")
    events.write.option("header", True).option("escape", '"').csv(f"{root}/inbox")
    ingest_files(spark, root, "events", "shop", f"{root}/inbox/*.csv", at=_DAY)
    return parse_records(read_bronze(spark, root, "events")).drop("_source_file", "_block_pos", "_row_pos")


def listed(spark, folder):
    """Documents with labels landed on one day, the others on a later one; a listing of the first day."""
    root = scratch_root(spark)
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    for how, source, day in (("left_semi", "labelled", 15), ("left_anti", "plain", 20)):
        part = documents.join(labels, "doc_id", how).select(
            F.to_json(F.struct("doc_id", "text")).alias("payload"),
            F.concat(F.col("doc_id").cast("string"), F.lit(".json")).alias("filename"))
        ingest_payloads(part, root, "texts", source, "json", at=_DAY.replace(day=day))
    span = {"start": date(2024, 1, 10), "end": date(2024, 1, 16)}
    stored = list_ingested(spark, root, "texts", **span).groupBy("source", "year", "month", "day").agg(
        (F.sum("size") > 0).alias("stored"))
    files = ingested_files(spark, root, "texts", **span).withColumn("source", parse_key(F.col("_source_file"))["source"])
    counted = files.groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.sum("record_count").alias("records"))
    return stored.join(counted, "source")


_KEY_SQL = """
    SELECT o_orderkey, o_orderdate,
           'bronze/orders/' || coalesce('source=' || lower(nullif(o_orderstatus, 'P')) || '/', '')
           || strftime(o_orderdate, 'year=%Y/month=%m/day=%d/') || 'order_' || o_orderkey || '.json' AS key,
           lower(nullif(o_orderstatus, 'P')) AS source
    FROM orders"""
_LINES = """[x FOR x IN string_split({0}, chr(10)) IF trim(translate(x, chr(13) || chr(9), '  ')) <> '']"""
_UNQUOTED = """regexp_replace(text, '"[^"]*"', 'q', 'g')"""

CHECKS = {
    "p1_object_key": Check(keys, f"SELECT o_orderkey, key FROM ({_KEY_SQL})"),
    "p2_parse_key": Check(parsed_keys, f"""
        SELECT o_orderkey, 'bronze' AS layer, 'orders' AS "table", source, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
               'order_' || o_orderkey || '.json' AS filename
        FROM ({_KEY_SQL})"""),
    "p3_partition_filter": Check(pruned, """
        SELECT o_orderkey, o_orderstatus AS source, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
        FROM orders
        WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-11-15' AND DATE '1997-02-10'"""),
    "b2_payload_records": Check(exploded, f"""
        SELECT doc_id, CAST(i - 1 AS BIGINT) AS _row_pos, kept[i] AS payload
        FROM (SELECT doc_id, kept, unnest(range(1, len(kept) + 1)) AS i
              FROM (SELECT doc_id, {_LINES.format('text')} AS kept FROM documents))"""),
    "b3_content_hash": Check(hashes, "SELECT doc_id, substring(md5(text), 1, 8) AS file_hash FROM documents"),
    "b4_not_landed": Check(fresh, """
        WITH files AS (SELECT doc_id, 'bronze/' || source || '/' || lang AS _source_file, md5(text) AS _content_md5
                       FROM documents)
        SELECT _source_file, _content_md5, count(*) AS copies FROM files f
        WHERE NOT EXISTS (SELECT 1 FROM files g JOIN labels USING (doc_id)
                          WHERE g._source_file = f._source_file AND g._content_md5 = f._content_md5)
        GROUP BY _source_file, _content_md5"""),
    "b5_record_count": Check(counts, f"""
        SELECT 'jsonl' AS format, doc_id AS id, CAST(len({_LINES.format('text')}) AS BIGINT) AS record_count FROM documents
        UNION ALL
        SELECT 'csv', doc_id,
               CAST(greatest(len({_LINES.format(_UNQUOTED)}) - 1, 0) AS BIGINT)
        FROM documents
        UNION ALL SELECT 'json', event_id, CAST(json_array_length('[1, ' || props || ']') AS BIGINT) FROM events"""),
    "r1_parse_json": Check(json_parsed, """
        SELECT event_id, user_id, event_type, value, props AS note FROM events"""),
    "r1_type_csv_cells": Check(csv_typed, """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'A' THEN l_partkey END AS part,
               CASE WHEN l_returnflag <> 'N' THEN l_discount END AS discount, l_linestatus = 'O' AS open,
               l_returnflag || l_linestatus AS flags
        FROM lineitem"""),
    "r2_union_by_name": Check(by_name, """
        SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
        UNION ALL BY NAME SELECT s_acctbal AS balance, s_name AS name FROM supplier
        UNION ALL BY NAME SELECT n_name AS name, CAST(n_nationkey AS DOUBLE) AS balance FROM nation"""),
    "r3_latest_rows": Check(newest, "SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)"),
    "w1_latest_snapshot": Check(snapshots, """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
        WHERE rn = 1"""),
    "b1_land_and_process": Check(landed_to_silver, """
        SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice,
               coalesce(nullif(o_orderstatus, 'P'), '') AS o_orderstatus FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
        WHERE rn = 1"""),
    "b1_land_csv_files": Check(files_to_bronze, """
        SELECT event_id, user_id, nullif(event_type, 'error') AS event_type, value, props FROM events"""),
    "b6_list_ingested": Check(listed, """
        SELECT 'labelled' AS source, CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month,
               CAST(15 AS INTEGER) AS day, true AS stored, count(*) AS files, count(*) AS records
        FROM documents SEMI JOIN labels USING (doc_id)"""),
}
