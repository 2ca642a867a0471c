from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierlake.functions.paths import object_key, parse_key, partition_filter

KEY = "bronze/orders/source=pos/year=2024/month=01/day=05/data.json"


def test_generate_and_parse(spark):
    row = spark.range(1).select(F.lit("2024-01-05 10:00:00").cast("timestamp_ntz").alias("ts"), F.lit("pos").alias("s"))
    keys = row.select(
        object_key("bronze", "orders", F.lit("data.json"), F.col("ts"), F.col("s")).alias("a"),
        object_key("silver", "orders", F.lit("x.parquet"), F.col("ts")).alias("b"),
        object_key("silver", "orders", F.lit("x.parquet"), F.col("ts"), F.lit("")).alias("c"),
        object_key("silver", "orders", F.lit("x.parquet")).alias("d"))
    found = keys.first()
    assert found["a"] == KEY
    assert found["b"] == found["c"] == "silver/orders/year=2024/month=01/day=05/x.parquet"
    assert f"year={datetime.now().year}" in found["d"]
    parts = keys.select(*[c.alias(n) for n, c in parse_key(F.col("a")).items()]).first()
    assert (parts["layer"], parts["table"], parts["source"], parts["year"], parts["month"], parts["day"], parts["filename"]) == (
        "bronze", "orders", "pos", 2024, 1, 5, "data.json")
    extra = spark.range(1).select(F.lit("l/t/region=eu=1/f.txt").alias("k"))
    parts = extra.select(*[c.alias(n) for n, c in parse_key(F.col("k")).items()]).first()
    assert parts["partitions"] == {"region": "eu=1"} and parts["year"] is None


@pytest.mark.parametrize("start, end, source, days", [
    (None, None, None, 5),
    (date(2024, 1, 15), date(2024, 1, 15), None, 1),
    (date(2024, 1, 15), date(2024, 2, 10), None, 2),
    (date(2023, 12, 1), date(2024, 1, 20), None, 2),
    (datetime(2024, 2, 1), None, None, 2),
    (None, datetime(2024, 1, 1), None, 2),
    (None, None, "web", 0),
])
def test_exact_ranges(spark, start, end, source, days):
    df = spark.createDataFrame(
        [("pos", 2023, 12, 31), ("pos", 2024, 1, 15), ("pos", 2024, 2, 10), ("pos", 2024, 3, 1), ("pos", 2022, 1, 15)],
        "source string, year int, month int, day int")
    assert df.where(partition_filter(start, end, source)).count() == days
