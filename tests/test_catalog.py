import pytest
from pyspark.sql import Observation, functions as F

from tierlake.operators import catalog as C
from tierlake.sources.catalogstore import Catalog
from tierlake.sources.snapshots import write_snapshot


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path))


def test_register_table_replaces_all_but_creation(catalog):
    catalog.register_table("orders", "silver", "s3://a", ["day"], "first")
    catalog.register_table("orders", "silver", "s3://b", None, "second")
    catalog.register_table("orders", "gold", "s3://c")
    rows = {r["layer"]: r for r in catalog.tables().collect()}
    assert len(rows) == 2
    assert (rows["silver"]["location"], rows["silver"]["description"], rows["silver"]["partition_keys"]) == ("s3://b", "second", None)
    assert rows["silver"]["created_seq"] < rows["silver"]["updated_seq"]


def test_register_column_keeps_first_flags(catalog):
    with pytest.raises(ValueError, match="silver.orders not found"):
        catalog.register_column("orders", "silver", "id", "int")
    catalog.register_table("orders", "silver", "s3://a")
    catalog.register_column("orders", "silver", "id", "int", "key", is_nullable=False, is_partition_key=True)
    catalog.register_column("orders", "silver", "id", "long", "the key")
    row = catalog.columns().first()
    assert (row["data_type"], row["description"], row["is_nullable"], row["is_partition_key"]) == ("long", "the key", False, True)


def test_statistics_are_computed(catalog, spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, float("nan")), (2, "b", None)], "id long, name string, v double")
    catalog.register_table("t", "silver", "x")
    with pytest.raises(ValueError, match="not found in silver.t"):
        catalog.update_column_stats("t", "silver", df)
    for name in df.columns:
        catalog.register_column("t", "silver", name, "any")
    catalog.update_column_stats("t", "silver", df)
    stats = {r["column_name"]: tuple(r)[3:] for r in catalog.column_stats().collect()}
    assert stats == {"id": (3, 0, 2, "1", "2"), "name": (3, 1, 2, "a", "b"), "v": (3, 2, 1, "1.0", "1.0")}
    nested = C.column_statistics(spark.createDataFrame([([1, 2],), (None,)], "items array<long>")).first()
    assert (nested["null_count"], nested["min_value"]) == (1, "[1,2]")


FIRST = {"parcel_no": "bigint", "weight": "float", "city": "string", "sent": "timestamp"}
SECOND = {"parcel_no": "bigint", "weight": "decimal(9,3)", "street": "string", "zip": "string", "sent": "timestamp"}


def test_schema_evolution(catalog):
    catalog.register_table("parcels", "silver", "/lake/parcels")
    assert catalog.latest_schema("parcels", "silver") is None
    assert [catalog.register_schema("parcels", "silver", s) for s in (FIRST, SECOND)] == ["1.0", "2.0"]
    assert catalog.register_schema("parcels", "silver", FIRST | {"fragile": "boolean"}, "trial") == "trial"
    assert [r["version"] for r in catalog.schema_versions("parcels", "silver").collect()] == ["1.0", "2.0", "trial"]
    assert catalog.latest_schema("parcels", "silver") == FIRST | {"fragile": "boolean"}

    def compared(old, new):
        found = catalog.compare_schemas("parcels", "silver", old, new)
        return sorted(found["added"]), sorted(found["removed"]), found["type_changed"], found["is_compatible"]

    weight = {"weight": {"from": "float", "to": "decimal(9,3)"}}
    assert compared("1.0", "2.0") == (["street", "zip"], ["city"], weight, False)
    assert compared("2.0", "2.0") == ([], [], {}, True)
    assert compared("1.0", "trial") == (["fragile"], [], {}, True)
    assert compared("trial", "1.0") == ([], ["fragile"], {}, False)
    catalog.add_schema_version("parcels", "silver", "1.0", FIRST | {"sent": "date"})  # of a repeated version the last counts
    assert compared("1.0", "trial")[2] == {"sent": {"from": "date", "to": "timestamp"}}
    for version, table in (("7.0", "parcels"), ("1.0", "letters")):
        with pytest.raises(ValueError):
            catalog.compare_schemas(table, "silver", version, "2.0")
    with pytest.raises(ValueError):
        catalog.add_schema_version("letters", "silver", "1.0", {})


def test_lineage_of_a_fan_out(catalog):
    for layer, names in (("bronze", ["scans", "routes"]), ("silver", ["parcels"]), ("gold", ["per_day", "per_depot"])):
        for name in names:
            catalog.register_table(name, layer, f"/lake/{layer}/{name}")
    with pytest.raises(ValueError, match="not found in catalog"):
        catalog.add_lineage("parcels", "silver", "per_week", "gold")
    for source in ("scans", "routes", "scans"):  # each run is an edge
        catalog.add_lineage(source, "bronze", "parcels", "silver", "join of the day")
    for target in ("per_day", "per_depot"):
        catalog.add_lineage("parcels", "silver", target, "gold")
    middle = catalog.lineage("parcels", "silver")
    assert sorted(e["name"] for e in middle["upstream"]) == ["routes", "scans", "scans"]
    assert {(e["name"], e["layer"]) for e in middle["downstream"]} == {("per_day", "gold"), ("per_depot", "gold")}
    assert catalog.lineage("routes", "bronze") == {"upstream": [], "downstream": [{"name": "parcels", "layer": "silver"}]}
    assert catalog.lineage("letters", "gold") == {"upstream": [], "downstream": []}


def test_search_over_names_and_descriptions(catalog):
    catalog.register_table("parcels", "silver", "p", description="One row for each parcel, 100% of depots")
    catalog.register_table("depots", "gold", "d", description="Where parcels wait")
    catalog.register_column("depots", "gold", "max_weight", "double", "kg per shelf (dry)")

    def hits(text):
        return sorted((r["match_type"], r["table_name"], r["name"]) for r in catalog.search(text).collect())

    assert hits("PARCEL") == [("table", "depots", "depots"), ("table", "parcels", "parcels")]
    assert hits("wait") == [("table", "depots", "depots")]
    assert hits("weig") == hits("(DRY)") == hits("m_x%t") == [("column", "depots", "max_weight")]
    assert hits("letters") == []


def test_publish(catalog, spark, tmp_path):
    write_snapshot(spark.range(5), str(tmp_path), "silver", "t")
    catalog.register_table("t", "bronze", "x")
    catalog.publish("silver", "t", [("t", "bronze")])
    catalog.publish("silver", "t", [("t", "bronze")])
    assert catalog.schema_versions("t", "silver").count() == 1
    assert catalog.latest_schema("t", "silver") == {"id": "bigint"}
    assert catalog.column_stats().first()["row_count"] == 5
    assert len(catalog.lineage("t", "silver")["upstream"]) == 2


def _plain_statistics(df, name):
    """Counts by Spark's own distinct, one column at a time."""
    held = df.where(F.col(f"`{name}`").isNotNull())
    return df.count(), df.count() - held.count(), held.select(f"`{name}`").distinct().count()


def test_statistics_of_many_types_in_one_scan(spark):
    long_text = "x" * 40
    rows = spark.createDataFrame(
        [(1, "a", long_text, 0.0, [1, None], ("p", None), {"k": 1}, b"\x00", "2024-01-01 10:00:00.000001"),
         (2, "a", long_text + "y", -0.0, [1], (None, "p"), {"k": 2}, b"\x00" * 50, "2024-01-01 10:00:00.000002"),
         (2, None, None, None, None, None, None, None, None),
         (1, "", "x" * 32, 1.5, [None, 1], ("p", None), {"k": 1}, b"", "2024-01-01 10:00:00.000001")],
        "at int, `a b.c` string, digest string, v double, items array<int>, pair struct<x: string, y: string>,"
        " m map<string, int>, raw binary, shown string")
    df = rows.withColumn("ts", F.col("shown").cast("timestamp")).withColumn("nested", F.array("ts"))
    found = {r["column_name"]: r for r in C.column_statistics(df).collect()}
    assert list(found) == df.columns
    for name in df.columns:
        if name != "m":
            assert tuple(found[name])[1:4] == _plain_statistics(df, name), name
    assert tuple(found["m"])[1:] == (4, 1, 2, '{"k":1}', '{"k":2}')
    assert tuple(found["at"])[4:] == ("1", "2") and tuple(found["a b.c"])[4:] == ("", "a")
    assert found["ts"]["max_value"] == "2024-01-01 10:00:00.000002" and found["digest"]["max_value"] == long_text + "y"


def test_statistics_of_no_rows(spark):
    for df in (spark.createDataFrame([], "a int, t string"), spark.range(5).where("id > 7").selectExpr("id AS a", "'t' AS t")):
        assert [tuple(r) for r in C.column_statistics(df).collect()] == [("a", 0, 0, 0, None, None), ("t", 0, 0, 0, None, None)]


def test_statistics_of_a_wide_table_read_it_once(spark, tmp_path):
    columns = [f"c{i}" for i in range(300)]
    spark.range(50).select(*((F.col("id") % (i + 1)).alias(c) for i, c in enumerate(columns))).write.parquet(f"{tmp_path}/wide")
    wide = spark.read.parquet(f"{tmp_path}/wide")
    plan = C._counted(wide, columns, Observation())._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Generate") == 1 and "Expand" not in plan and "Join" not in plan
    found = {r["column_name"]: tuple(r)[1:] for r in C.column_statistics(wide).collect()}
    assert found == {c: (50, 0, min(i + 1, 50), "0", str(min(i, 49))) for i, c in enumerate(columns)}
