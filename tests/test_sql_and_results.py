import json

import pytest

from tierlake.plans.sqlsession import SqlSession
from tierlake.sources import results
from tierlake.sources.landing import ingest_payloads
from tierlake.sources.snapshots import write_snapshot


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    people = spark.createDataFrame([(1, "Alice", 100.0), (2, "Bob", 200.0), (3, "Charlie", 300.0)], "id long, name string, amount double")
    write_snapshot(people.limit(1), root, "silver", "people")
    write_snapshot(people, root, "silver", "people")
    write_snapshot(people, root, "gold", "dim.people-eu")
    ingest_payloads(spark.createDataFrame([('{"id": 1}',)], "payload string"), root, "raw", "s", "json")
    return root


def test_queries_over_registered_tables(spark, lake):
    session = SqlSession(spark, lake)
    assert session.register_table("silver", "people") == "silver_people"
    assert session.register_table("silver", "people", "my.view-1") == "my_view_1"
    assert [r["name"] for r in session.query_rows("SELECT * FROM silver_people WHERE amount > 150 ORDER BY id")] == ["Bob", "Charlie"]
    assert session.query_rows("SELECT count(*) AS n FROM my_view_1") == [{"n": 3}]
    assert session.query_arrow("SELECT * FROM silver_people").num_rows == 3
    assert list(session.query_df("SELECT id FROM silver_people ORDER BY id")["id"]) == [1, 2, 3]
    with pytest.raises(ValueError, match="No silver data"):
        session.register_table("silver", "absent")
    with pytest.raises(ValueError):
        session.register_table("bronze", "absent")
    with pytest.raises(ValueError):
        session.register_table("platinum", "people")


def test_register_all_skips_what_cannot_be_read(spark, lake):
    spark.range(1).selectExpr("'x' AS v").write.text(f"{lake}/silver/broken")
    session = SqlSession(spark, lake)
    assert sorted(session.register_all_tables()) == ["bronze_raw", "gold_dim_people_eu", "silver_people"]
    assert session.list_tables() == ["bronze_raw", "gold_dim_people_eu", "silver_people"]
    assert session.query_rows("SELECT payload FROM bronze_raw") == [{"payload": '{"id": 1}'}]
    session.close()
    assert session.list_tables() == [] and not spark.catalog.tableExists("silver_people")


def test_default_limit_and_plan(spark, lake):
    session = SqlSession(spark, lake)
    spark.range(500).createOrReplaceTempView("numbers")
    assert session.preview("SELECT id AS credit_limit FROM numbers;").count() == 100
    assert session.preview("SELECT id FROM numbers", 7).count() == 7
    assert session.query("SELECT id FROM numbers").count() == 500
    assert "== Physical Plan ==" in session.explain("SELECT id FROM numbers WHERE id > 3")


def test_result_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a, "b"'), (2, None)], "id long, name string")
    assert json.loads(results.json_text(df))[0] == {"id": 1, "name": 'a, "b"'}
    assert results.csv_text(df) == 'id,name\n1,"a, ""b"""\n2,\n'
    assert results.rows(df, 1) == [{"id": 1, "name": 'a, "b"'}]
    results.write_csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert {r["name"] for r in back.collect()} == {'a, "b"', None}
    results.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_results_come_whole_or_not_at_all(spark, monkeypatch):
    monkeypatch.setattr(results, "MOST_ROWS", 5)
    for whole in (results.rows, results.to_pandas, results.to_arrow, results.json_text, results.csv_text):
        assert len(results.rows(spark.range(5))) == 5
        with pytest.raises(ValueError, match="more than 5 rows"):
            whole(spark.range(6))
    assert len(results.rows(spark.range(9), 7)) == 7
