from datetime import datetime, timezone

import pytest
from pyspark.sql import types as T

from tierlake.plans.silver import process_table
from tierlake.sources.folders import subfolders
from tierlake.sources.landing import ingest_payloads
from tierlake.sources.snapshots import read_latest
from tierlake.streaming.arrivals import arrivals_path, compact, current, publish_snapshot, start

SCHEMA = T.StructType().add("id", T.LongType()).add("v", T.StringType())


def land(spark, root, day, name, *records):
    batch = spark.createDataFrame([("\n".join(records), name)], "payload string, filename string")
    ingest_payloads(batch, root, "t", "s", "jsonl", at=datetime(2024, 1, day, tzinfo=timezone.utc)).collect()


def rows(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def test_arrivals_equal_the_batch_run(spark, tmp_path):
    root, mark = str(tmp_path / "lake"), str(tmp_path / "mark")

    def arrive():
        start(spark, root, "t", SCHEMA, mark, dedup_columns=["id"]).awaitTermination()

    with pytest.raises(ValueError, match="No silver data"):
        current(spark, root, "t", ["id"])
    land(spark, root, 15, "b.jsonl", '{"id": 1, "v": "day 15"}', '{"id": 2, "v": null}')
    arrive()
    assert rows(current(spark, root, "t", ["id"])) == [(1, "day 15"), (2, "")]
    land(spark, root, 14, "z.jsonl", '{"id": 1, "v": "late arrival of day 14"}', '{"id": 3, "v": "x"}')
    land(spark, root, 16, "a.jsonl", '{"id": 2, "v": "day 16"}')
    arrive()
    batches = subfolders(spark, arrivals_path(root, "t"))
    arrive()  # nothing new
    assert subfolders(spark, arrivals_path(root, "t")) == batches
    expected = [(1, "day 15"), (2, "day 16"), (3, "x")]
    assert rows(current(spark, root, "t", ["id"])) == expected
    process_table(spark, root, "t", dedup_columns=["id"], read_schema=SCHEMA)
    assert rows(read_latest(spark, root, "silver", "t")) == expected


def test_compaction_keeps_the_result(spark, tmp_path):
    root, mark = str(tmp_path / "lake"), str(tmp_path / "mark")
    for day in (1, 2, 3):
        land(spark, root, day, "a.jsonl", f'{{"id": 1, "v": "{day}"}}', f'{{"id": {day + 10}, "v": "x"}}')
        start(spark, root, "t", SCHEMA, mark, dedup_columns=["id"]).awaitTermination()
        if day == 2:
            name = compact(spark, root, "t", ["id"])
            assert compact(spark, root, "t", ["id"]) == name
    assert rows(current(spark, root, "t", ["id"])) == [(1, "3"), (11, "x"), (12, "x"), (13, "x")]
    assert publish_snapshot(spark, root, "t", ["id"])["row_count"] == 4
    assert read_latest(spark, root, "silver", "t").columns == ["id", "v"]
