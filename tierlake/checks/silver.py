"""Cleaning."""

from pyspark.sql import functions as F

from tierlake.checks import Check, table
from tierlake.operators.cleaning import (
    apply_transforms, by_column, clean, enforce_types, fill_nulls, keep_last,
)


def transforms(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"), "p_type")
    return apply_transforms(parts, {
        "p_name": by_column(lambda c: F.upper(F.trim(c))), "p_type": F.lower, "absent": F.lower})


def opaque_transforms(spark, folder):
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    return apply_transforms(events, {
        "event_type": lambda s: s.title() if s else s, "value": lambda v: float(int(v))})


def _gaps(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", "ts", "user_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("event_type") == "click", F.lit(float("nan")))
        .when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.when(F.col("user_id") % 3 > 0, F.col("user_id")).alias("buyer"),
        F.when(F.col("user_id") % 2 == 0, F.col("value") > 5).alias("big"),
    )


_GAPS_SQL = """
SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type,
       CASE WHEN event_type NOT IN ('view', 'click') THEN value END AS value,
       CASE WHEN user_id % 3 > 0 THEN user_id END AS buyer,
       CASE WHEN user_id % 2 = 0 THEN value > 5 END AS big
FROM events
"""


def fills(spark, folder):
    return fill_nulls(_gaps(spark, folder))


def casts(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").cast("string").alias("l_quantity"),
        F.when(F.col("l_returnflag") == "R", "true").otherwise("false").alias("returned"))
    return enforce_types(lines, {
        "l_linenumber": "float", "l_partkey": "str", "l_quantity": "int64", "returned": "bool", "absent": "int"})


def last_event(spark, folder):
    return keep_last(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"])


def last_turn(spark, folder):
    turns = table(spark, folder, "conversations")
    return keep_last(turns, ["conv_id", "role"], ["turn", "text"])


def cleaned(spark, folder):
    return clean(
        _gaps(spark, folder),
        schema={"buyer": "str", "value": "float64"},
        dedup_columns=["user_id", "event_type"],
        transforms={"event_type": by_column(lambda c: F.upper(F.trim(c)))},
        order=["ts", "event_id"],
    )


CHECKS = {
    "c1_transform": Check(transforms, """
        SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS p_name, lower(p_type) AS p_type
        FROM part"""),
    "u1_python_transform": Check(opaque_transforms, """
        SELECT event_id, upper(event_type[1]) || lower(event_type[2:]) AS event_type, trunc(value) AS value
        FROM events"""),
    "c2_fill_nulls": Check(fills, f"""
        SELECT event_id, ts, user_id, coalesce(event_type, '') AS event_type, coalesce(value, 0) AS value,
               coalesce(buyer, 0) AS buyer, coalesce(big, false) AS big
        FROM ({_GAPS_SQL})"""),
    "c3_enforce_types": Check(casts, """
        SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(l_partkey AS VARCHAR) AS l_partkey,
               CAST(l_quantity AS BIGINT) AS l_quantity, l_returnflag = 'R' AS returned
        FROM lineitem"""),
    "c4_keep_last": Check(last_event, """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1"""),
    "c4_keep_last_texts": Check(last_turn, """
        SELECT conv_id, turn, role, text FROM (
            SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC, text DESC) AS rn
            FROM conversations)
        WHERE rn = 1"""),
    "c5_clean": Check(cleaned, f"""
        SELECT event_id, ts, user_id, event_type, value, buyer, big FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
            FROM (SELECT event_id, ts, user_id, coalesce(upper(trim(event_type)), '') AS event_type,
                         coalesce(value, 0) AS value, CAST(coalesce(buyer, 0) AS VARCHAR) AS buyer,
                         coalesce(big, false) AS big
                  FROM ({_GAPS_SQL})))
        WHERE rn = 1"""),
}
