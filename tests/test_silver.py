from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierlake.operators.cleaning import (
    apply_transforms, by_column, clean, enforce_types, fill_nulls, keep_last, python_transform,
)
from tierlake.plans.silver import process_table
from tierlake.sources.landing import ingest_files, ingest_payloads, read_bronze
from tierlake.sources.records import parse_records
from tierlake.sources.snapshots import read_latest, snapshot_tags

DAY = datetime(2024, 1, 15, tzinfo=timezone.utc)


def rows(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=repr)


def test_fill_by_type(spark):
    """Every kind of column once present and once missing."""
    kinds = {"city": "string", "share": "double", "ratio": "float", "seats": "int", "price": "decimal(6,2)", "open": "boolean",
             "tags": "array<string>", "seen": "timestamp", "_source_file": "string"}
    present = ("Linz", 0.25, 0.5, 12, Decimal("7.50"), True, ["x"], datetime(2024, 5, 1), "in.csv")
    frame = spark.createDataFrame([present, (None,) * len(kinds)], ", ".join(f"{n} {t}" for n, t in kinds.items()))
    full, gaps = fill_nulls(frame).collect()
    assert tuple(full) == present
    assert tuple(gaps) == ("", 0.0, 0.0, 0, Decimal(0), False, None, None, None)
    nan = spark.createDataFrame([(float("nan"), -0.5)], "share double, other double")
    assert tuple(fill_nulls(nan).first()) == (0.0, -0.5)


def test_keep_last_by_several_keys_and_orders(spark):
    readings = [("t1", "a", day, hour, day * 100 + hour) for day in (3, 1, 2) for hour in (7, 23, 11)]
    readings += [("t1", "b", 1, 5, -1), ("t2", "a", 9, 9, -2), ("t2", "a", 9, None, -3)]
    frame = spark.createDataFrame(readings, "sensor string, channel string, day int, hour int, value int").repartition(4)
    kept = keep_last(frame, ["sensor", "channel"], ["day", "hour"])
    assert kept.columns == frame.columns
    assert {(r["sensor"], r["channel"]): r["value"] for r in kept.collect()} == {("t1", "a"): 323, ("t1", "b"): -1, ("t2", "a"): -2}


def test_keep_last_aggregates_before_the_shuffle(spark, tables):
    from plans import plan_text

    kept = keep_last(spark.read.parquet(f"{tables}/events.parquet"), ["user_id"], ["ts", "event_id"])
    text = plan_text(kept)
    assert "partial_max_by" in text and text.count("Exchange") == 1


def test_casts_to_named_types(spark):
    frame = spark.createDataFrame([("17", "2.50", "true", 8, "2024-03-01 04:05:06"), (None, "-1e3", "no", -1, None)],
                                  "seats string, share string, open string, code long, seen string")
    typed = enforce_types(frame, {"seats": "int32", "share": "float64", "open": "bool", "code": "object",
                                  "seen": "datetime64[ns]", "missing": "int"})
    assert [t for _, t in typed.dtypes] == ["int", "double", "boolean", "string", "timestamp"]
    assert [tuple(r)[:4] for r in typed.collect()] == [(17, 2.5, True, "8"), (None, -1000.0, False, "-1")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        enforce_types(spark.createDataFrame([("x",)], "price string"), {"price": "int"}).collect()


def test_transforms_on_columns_and_plain_python(spark):
    df = spark.createDataFrame([(" vienna\t", 1), (None, 2), ("graz  ", 3)], "name string, n long")
    on_columns = apply_transforms(df, {"name": by_column(lambda c: F.upper(F.trim(F.translate(c, "\t", " ")))), "absent": F.upper})
    by_python = apply_transforms(df, {"name": lambda s: s.strip().upper() if s else s})
    assert [r["name"] for r in on_columns.collect()] == ["VIENNA", None, "GRAZ"]
    assert [r["name"] for r in by_python.collect()] == ["VIENNA", None, "GRAZ"]
    halved = apply_transforms(df, {"n": python_transform(lambda n: n / 2, "double")})
    assert [r["n"] for r in halved.collect()] == [0.5, 1.0, 1.5]


def test_transform_sees_nulls_and_runs_before_the_fill(spark):
    df = spark.createDataFrame([(None,), ("x",)], "name string")
    done = clean(df, transforms={"name": by_column(lambda c: F.coalesce(c, F.lit("unknown")))})
    assert [r["name"] for r in done.collect()] == ["unknown", "x"]


def test_process_table_end_to_end(spark, tmp_path):
    root = str(tmp_path / "lake")
    batch = spark.createDataFrame([('[{"id":1,"name":"a"},{"id":2,"name":"b"},{"id":1,"name":"c"}]',)], "payload string")
    ingest_payloads(batch, root, "t", "s", "json", at=DAY)
    stats = process_table(spark, root, "t", dedup_columns=["id"])
    assert (stats["records_in"], stats["records_out"], stats["duplicates_removed"]) == (3, 2, 1)
    silver = read_latest(spark, root, "silver", "t")
    assert rows(silver) == [{"id": 1, "name": "c"}, {"id": 2, "name": "b"}]
    assert snapshot_tags(spark, stats["location"])["records_in"] == "3"


def test_empty_bronze(spark, tmp_path):
    assert process_table(spark, str(tmp_path), "none") == {"status": "no_data", "records_in": 0, "records_out": 0}
    with pytest.raises(ValueError, match="No silver data found for none"):
        read_latest(spark, str(tmp_path), "silver", "none")


def test_union_of_files_with_different_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,price,flag,gap\n1,"x, y",1.5,True,\n2,NA,2,False,\n')
    (tmp_path / "b.jsonl").write_text(
        '{"id": 3, "city": "Rome", "items": [{"product_id": "P1", "quantity": 2, "unit_price": 1.5}]}\n{"id": 4, "city": null}\n')
    root = str(tmp_path / "lake")
    ingest_files(spark, root, "t", "s", [str(tmp_path / "a.csv"), str(tmp_path / "b.jsonl")], at=DAY)
    parsed = parse_records(read_bronze(spark, root, "t"))
    types = dict(parsed.dtypes)
    assert (types["id"], types["price"], types["flag"], types["gap"]) == ("bigint", "double", "boolean", "double")
    assert types["items"] == "array<struct<product_id:string,quantity:bigint,unit_price:double>>"
    process_table(spark, root, "t")
    silver = {r["id"]: r.asDict(recursive=True) for r in read_latest(spark, root, "silver", "t").collect()}
    assert silver[1]["name"] == "x, y" and silver[2]["name"] == "" and silver[3]["name"] == ""
    assert silver[3]["price"] == 0.0 and silver[1]["city"] == "" and silver[4]["items"] is None
    assert silver[3]["items"] == [{"product_id": "P1", "quantity": 2, "unit_price": 1.5}]


def test_later_file_wins_across_files_and_days(spark, tmp_path):
    root = str(tmp_path / "lake")
    for day, value in ((16, "late"), (15, "early")):
        batch = spark.createDataFrame([(f'{{"id": 1, "v": "{value}"}}', "a.json")], "payload string, filename string")
        ingest_payloads(batch, root, "t", "s", "json", at=datetime(2024, 1, day, tzinfo=timezone.utc))
    process_table(spark, root, "t", dedup_columns=["id"])
    assert rows(read_latest(spark, root, "silver", "t")) == [{"id": 1, "v": "late"}]
    first_day = process_table(spark, root, "t", dedup_columns=["id"], start_date=DAY, end_date=DAY)
    assert first_day["records_in"] == 1
    assert rows(read_latest(spark, root, "silver", "t")) == [{"id": 1, "v": "early"}]


def test_mixed_number_types_and_declared_schema(spark, tmp_path):
    root = str(tmp_path / "lake")
    (tmp_path / "a.jsonl").write_text('{"id": 1, "v": 1}\n{"id": 2, "v": 2.5}\n{"id": 3, "v": null}\n')
    ingest_files(spark, root, "t", "s", str(tmp_path / "a.jsonl"), at=DAY)
    assert dict(parse_records(read_bronze(spark, root, "t")).dtypes)["v"] == "double"
    from pyspark.sql import types as T

    schema = T.StructType().add("id", T.LongType()).add("v", T.StringType())
    stats = process_table(spark, root, "t", schema={"v": "float"}, read_schema=schema,
                          transformations={"v": by_column(lambda c: F.coalesce(c, F.lit("0")))})
    assert stats["records_out"] == 3
    assert dict(read_latest(spark, root, "silver", "t").dtypes) == {"id": "bigint", "v": "double"}


def test_unfinished_snapshot_is_not_read(spark, tmp_path):
    from tierlake.sources.snapshots import write_snapshot

    root = str(tmp_path)
    write_snapshot(spark.range(3), root, "silver", "t")
    spark.range(9).write.parquet(f"{root}/silver/t/snapshot_ts=99990101T000000_000000Z")
    assert read_latest(spark, root, "silver", "t").count() == 3


def test_odd_column_names_and_values(spark, tmp_path):
    root = str(tmp_path / "lake")
    (tmp_path / "a.jsonl").write_text(
        '{"a b": 1, "a.b": "x", "ünï": [], "select": {"1x": 1.5, "VARIANT": true}, "mix": 1, "twice": 1, "twice": 2}\n'
        '{"mix": "text", "ünï": [1, 2.5]}\n', encoding="utf-8")
    ingest_files(spark, root, "t", "s", str(tmp_path / "a.jsonl"), at=DAY)
    process_table(spark, root, "t", dedup_columns=["a b"])
    silver = read_latest(spark, root, "silver", "t")
    assert dict(silver.dtypes)["select"] == "struct<1x:double,VARIANT:boolean>"
    first = [r for r in silver.collect() if r["a b"] == 1][0].asDict(recursive=True)
    assert first == {"a b": 1, "a.b": "x", "ünï": [], "select": {"1x": 1.5, "VARIANT": True}, "mix": "1", "twice": 2}


def test_csv_cells_with_commas_quotes_and_line_breaks(spark, tmp_path):
    root = str(tmp_path / "lake")
    (tmp_path / "a.csv").write_text('id,note,id\r\n1,"a, ""b""\r\nc",x\r\n 2 ,N/A\r\n', newline="")
    (tmp_path / "b.csv").write_text("id,note\n3,+7\n4,07\n")
    ingest_files(spark, root, "t", "s", [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], at=DAY)
    rows_ = {r["id"]: r.asDict() for r in parse_records(read_bronze(spark, root, "t")).collect()}
    assert rows_[1]["note"].replace("\r\n", "\n") == 'a, "b"\nc' and rows_[1]["id.1"] == "x"
    assert rows_[2]["note"] is None and rows_[2]["id.1"] is None and rows_[3]["note"] == "+7"


@pytest.mark.parametrize("line", ['{"id": 2} {"id": 3}', '{"id": 2}, {"id": 3}', '{"id": 2', 'text'])
def test_malformed_lines_raise(spark, tmp_path, line):
    root = str(tmp_path / "lake")
    (tmp_path / "a.jsonl").write_text(f'{{"id": 1}}\n{line}\n')
    ingest_files(spark, root, "t", "s", str(tmp_path / "a.jsonl"), at=DAY)
    from pyspark.sql import types as T

    with pytest.raises(Exception, match="JSON|MALFORMED"):
        process_table(spark, root, "t", read_schema=T.StructType().add("id", T.LongType()))


def test_python_functions_give_python_results(spark):
    df = spark.createDataFrame([("abcdef", -7), (None, None)], "s string, n int")

    def width(text: str) -> int:
        return len(text or "")

    found = apply_transforms(df.withColumn("t", F.col("s")).withColumn("u", F.col("s")), {
        "s": lambda x: x and x[1:3], "n": lambda x: None if x is None else x % 3,
        "t": lambda x: (x or "") + "_x", "u": width})
    assert [tuple(r) for r in found.select("s", "n", "t", "u").collect()] == [("bc", 2, "abcdef_x", 6), (None, None, "_x", 0)]
    with pytest.raises(Exception, match="python_transform"):
        apply_transforms(df, {"s": lambda x: len(x or "")}).collect()
