import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tierlake.functions import payload as P
from tierlake.sources import landing
from tierlake.sources.landing import (
    hash_files, ingest_file, ingest_files, ingest_payloads, ingested_files, list_ingested, read_bronze,
)

DAY = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


@pytest.mark.parametrize("name, text, count", [
    ("a.json", '[{"id": 1},\n {"id": 2, "n": {"x": [1, 2]}}, {"id": 3}]', 3),
    ("b.json", '{"id": 1}', 1),
    ("c.jsonl", '{"id": 1}\n{"id": 2}\n{"id": 3}', 3),
    ("d.jsonl", '{"id": 1}\n\n  \n{"id": 2}\n', 2),
    ("e.csv", "id,name\n1,a\n2,b\n", 2),
    ("f.csv", "id,name\n", 0),
    ("g.csv", 'id,name\n1,"a\nb"\n\n2,"x ""y"""\n', 2),
    ("h.JSONL", '{"id": 1}\r\n{"id": 2}\r\n', 2),
    ("i j+k.csv", "id,name\n1,a\n", 1),
    ("k.json", "[]", 0),
    ("l[1]{x}.csv", '\r\n"id, no",name\r\n1,"a\r\nb"\r\n2,c\r\n', 2),
    ("m.jsonl", "", 0),
    ("n.csv", "", 0),
    ("o.csv", 'h\n5" a\n6" b\n', 2),
    ("p.csv", 'a,b,c\n5" x,"m\nn",6" y\n7,8,9\n', 2),
    ("q.csv", 'a,"b\nc",d\n1,2,3\n', 1),
    ("r.csv", "a,b\n1,2\n,\n3,4\n", 3),
    ("s.csv", "a,a,\n1,2,3\n", 1),
])
def test_record_counts_of_files_and_payloads(spark, tmp_path, name, text, count):
    root = str(tmp_path / "lake")
    result = ingest_file(spark, root, "t", "pos", write(tmp_path, name, text), at=DAY)
    assert result["record_count"] == count
    kind = name.rsplit(".", 1)[1].lower()
    in_memory = spark.createDataFrame([(text, kind)], "payload string, kind string")
    assert in_memory.select(P.record_count(F.col("payload"), F.col("kind"))).first()[0] == count
    landed = ingest_payloads(in_memory.select("payload"), root, "u", "pos", kind, at=DAY).first()
    assert landed["record_count"] == count


def test_key_hash_and_tags(spark, tmp_path):
    import hashlib

    text = '{"id": 1}\n'
    root = str(tmp_path / "lake")
    result = ingest_file(spark, root, "orders", "pos", write(tmp_path, "day 1.jsonl", text), "2.0", DAY)
    digest = hashlib.md5(text.encode()).hexdigest()[:8]
    assert result["file_hash"] == digest
    assert result["key"] == f"bronze/orders/source=pos/year=2024/month=01/day=15/day 1_{digest}.jsonl"
    row = read_bronze(spark, root, "orders").first()
    assert (row["_schema_version"], row["_original_format"], row["source"], row["month"]) == ("2.0", "jsonl", "pos", 1)
    assert (tmp_path / "lake/bronze/orders/source=pos/year=2024/month=01/day=15").is_dir()


def test_same_content_lands_once_a_day(spark, tmp_path):
    root = str(tmp_path / "lake")
    path = write(tmp_path, "a.jsonl", '{"id": 1}\n{"id": 2}')
    first = ingest_file(spark, root, "t", "pos", path, at=DAY)
    again = ingest_file(spark, root, "t", "pos", path, at=DAY)
    assert first["key"] == again["key"] and again["record_count"] == 2
    assert read_bronze(spark, root, "t").count() == 2
    ingest_file(spark, root, "t", "web", path, at=DAY)
    ingest_file(spark, root, "t", "pos", path, at=datetime(2024, 1, 16, tzinfo=timezone.utc))
    ingest_file(spark, root, "t", "pos", write(tmp_path, "a.jsonl", '{"id": 3}'), at=DAY)
    assert read_bronze(spark, root, "t").count() == 7
    assert ingested_files(spark, root, "t").count() == 4
    assert ingested_files(spark, root, "t", source="web").first()["record_count"] == 2


def test_folder_of_mixed_files(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    write(inbox, "a.csv", "id,name\n1,x\n")
    write(inbox, "b.csv", "id,city\n2,y\n3\n")
    write(inbox, "c.json", '[{"id": 4}]')
    results = {r["key"].rsplit("/", 1)[1][0]: r["record_count"]
               for r in ingest_files(spark, str(tmp_path / "lake"), "t", "s", str(inbox), at=DAY).collect()}
    assert results == {"a": 1, "b": 2, "c": 1}
    payloads = {r[0] for r in read_bronze(spark, str(tmp_path / "lake"), "t").select("payload").collect()}
    assert json.loads('{"id":"3","city":null}') in [json.loads(p) for p in payloads]


def test_long_csv_row_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="longer than its header"):
        ingest_file(spark, str(tmp_path / "lake"), "t", "s", write(tmp_path, "a.csv", "a,b\n1,2,3\n"), at=DAY)


def test_rejects_unknown_formats_and_missing_files(spark, tmp_path):
    with pytest.raises(ValueError, match="Unsupported format"):
        ingest_file(spark, str(tmp_path / "lake"), "t", "s", write(tmp_path, "a.xml", "<a/>"))
    with pytest.raises(FileNotFoundError):
        ingest_file(spark, str(tmp_path / "lake"), "t", "s", str(tmp_path / "none.csv"))


def test_big_files_are_hashed_in_chunks(spark, tmp_path):
    path = write(tmp_path, "a b.jsonl", "x" * 5000)
    whole = hash_files(spark, [path]).first()
    assert hash_files(spark, [path], whole_file_bytes=10).first() == whole


def test_records_keep_file_order_over_splits(spark, tmp_path):
    path = write(tmp_path, "a.jsonl", "\n".join(f'{{"id": {i}}}' for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        ingest_file(spark, str(tmp_path / "lake"), "t", "s", path, at=DAY)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    rows = read_bronze(spark, str(tmp_path / "lake"), "t").orderBy(*landing.FILE_ORDER)
    assert [json.loads(r["payload"])["id"] for r in rows.collect()] == list(range(5000))


def test_listing_by_source_and_date(spark, tmp_path):
    root = str(tmp_path / "lake")
    path = write(tmp_path, "a.jsonl", '{"id": 1}')
    for source, day in (("pos", 15), ("pos", 20), ("a/b", 15)):
        ingest_file(spark, root, "t", source, path, at=datetime(2024, 1, day, tzinfo=timezone.utc))
    assert list_ingested(spark, root, "t").count() == 3
    assert list_ingested(spark, root, "t", source="a/b").count() == 1
    only = list_ingested(spark, root, "t", "pos", datetime(2024, 1, 16), datetime(2024, 2, 1)).collect()
    assert len(only) == 1 and only[0]["day"] == 20 and only[0]["size"] > 0
    assert list_ingested(spark, root, "absent").count() == 0


def test_equal_payloads_in_one_batch_land_once(spark, tmp_path):
    batch = spark.createDataFrame([('{"a":1}', "x.json"), ('{"a":1}', "x.json"), ('[{"a":2},{"a":{"b":[3]}}]', "y.json")],
                                  "payload string, filename string")
    results = ingest_payloads(batch, str(tmp_path / "lake"), "t", "s", "json", at=DAY).collect()
    assert sorted(r["record_count"] for r in results) == [1, 2]
    assert read_bronze(spark, str(tmp_path / "lake"), "t").count() == 3


def test_date_range_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "lake")
    path = write(tmp_path, "a.jsonl", '{"id": 1}')
    for month, day in ((1, 14), (1, 15), (1, 31), (2, 10), (2, 11)):
        ingest_file(spark, root, "t", "pos", path, at=datetime(2024, month, day, tzinfo=timezone.utc))
    part = read_bronze(spark, root, "t", datetime(2024, 1, 15), datetime(2024, 2, 10), "pos")
    assert sorted((r["month"], r["day"]) for r in part.collect()) == [(1, 15), (1, 31), (2, 10)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "make_date" in filters and "source" in filters
    assert read_bronze(spark, root, "t", start=datetime(2024, 2, 1)).count() == 2


@pytest.mark.parametrize("text", [
    '{\n"a":1\n}\n{\n"a":2\n}\n', '[\n{"a":1},\n{"a":2}\n]\n[\n{"a":3}\n]', '{"a": 1', '{"id": 1}\n{"id": 2}\n', '{"id": 1} {"id": 2}', '\n{"id": {"x": 1}}\n\n[1]'])
def test_several_documents_in_a_json_file_are_refused(spark, tmp_path, text):
    with pytest.raises(ValueError, match="not one JSON document"):
        ingest_file(spark, str(tmp_path / "lake"), "t", "s", write(tmp_path, "a.json", text), at=DAY)


def test_json_documents_over_several_lines(spark, tmp_path):
    root = str(tmp_path / "lake")
    pretty = json.dumps([{"id": i, "n": {"x": i}} for i in range(3)], indent=1)
    assert ingest_file(spark, root, "t", "s", write(tmp_path, "a.json", pretty), at=DAY)["record_count"] == 3
    odd = '{"id": 1, "n": {"x": 2}\n, "m": {"y": 3}\n}'
    assert ingest_file(spark, root, "t", "s", write(tmp_path, "b.json", odd), at=DAY)["record_count"] == 1
    lines = '[\n{"id": 1},\n{"id": 2}\n]'
    assert ingest_file(spark, root, "t", "s", write(tmp_path, "c.json", lines), at=DAY)["record_count"] == 2


CELLS = ["", "x", " y ", 'q"q', '"a, b"', '"say ""hi"""', '"two\nlines"', "7", "NA", "é"]


@pytest.mark.parametrize("seed", range(6))
def test_csv_files_and_payloads_agree(spark, tmp_path, seed):
    import csv
    import io
    import random

    pick = random.Random(seed)
    width = pick.randint(1, 4)
    header = ",".join(pick.choice(["a", "b", '"c d"', ""]) for _ in range(width)) or "a"
    cells = CELLS[1:] if width == 1 else CELLS
    rows = [",".join(pick.choice(cells) for _ in range(pick.randint(1, width))) for _ in range(30)]
    rows = [r for r in rows if r.strip()]
    text = "\n".join([header, *rows]) + "\n"
    expected = len([r for r in csv.reader(io.StringIO(text, newline="")) if r]) - 1
    root = str(tmp_path / "lake")
    assert ingest_file(spark, root, "f", "s", write(tmp_path, "a.csv", text), at=DAY)["record_count"] == expected
    payload = spark.createDataFrame([(text, "a.csv")], "payload string, filename string")
    assert ingest_payloads(payload, root, "p", "s", "csv", at=DAY).first()["record_count"] == expected
    assert payload.select(P.record_count(F.col("payload"), F.lit("csv"))).first()[0] == expected

    def landed(name):
        found = read_bronze(spark, root, name).orderBy(*landing.FILE_ORDER).select("payload").collect()
        return [json.loads(r["payload"]) for r in found]

    assert landed("f") == landed("p")


def test_repeated_csv_columns_and_empty_rows_are_kept(spark, tmp_path):
    payload = spark.createDataFrame([("a,a\n1,2\n,\n", "a.csv")], "payload string, filename string")
    root = str(tmp_path / "lake")
    ingest_payloads(payload, root, "t", "s", "csv", at=DAY)
    found = [json.loads(r["payload"]) for r in read_bronze(spark, root, "t").orderBy("_row_pos").collect()]
    assert found == [{"a": "1", "a.1": "2"}, {"a": None, "a.1": None}]
