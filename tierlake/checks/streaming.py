"""ST1: arrivals cleaned incrementally."""

from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.checks import Check, table
from tierlake.session import scratch_root
from tierlake.sources.landing import ingest_payloads
from tierlake.streaming.arrivals import compact, current, start

_SCHEMA = (
    T.StructType().add("event_id", T.LongType()).add("user_id", T.LongType())
    .add("event_type", T.StringType()).add("value", T.DoubleType())
)


def arrivals(spark, folder):
    """Two arrivals of events, the later day's first; the stream runs after each."""
    root = scratch_root(spark)
    events = table(spark, folder, "events").select(
        "event_id", "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "value")
    files = events.select(
        F.to_json(F.struct("*")).alias("payload"),
        F.concat(F.lpad(F.col("event_id").cast("string"), 12, "0"), F.lit(".jsonl")).alias("filename"))
    early = F.get_json_object("payload", "$.value").cast("double") < 10
    for day, part in ((16, files.where(~early)), (15, files.where(early))):
        ingest_payloads(part, root, "events", "app", "jsonl", at=datetime(2024, 1, day, tzinfo=timezone.utc))
        stream = start(spark, root, "events", _SCHEMA, f"{root}/stream", dedup_columns=["user_id"], max_files_per_trigger=4)
        stream.awaitTermination()
        compact(spark, root, "events", ["user_id"])
    return current(spark, root, "events", ["user_id"])


CHECKS = {
    "st1_arrivals": Check(arrivals, """
        SELECT event_id, user_id, coalesce(nullif(event_type, 'error'), '') AS event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value >= 10 DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1"""),
}
