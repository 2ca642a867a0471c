"""A small shop from raw files to facts: customers (JSON array and CSV), products, nested orders."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tierlake.operators.quality import QualityChecker
from tierlake.plans.gold import create_dimension_table, create_fact_table
from tierlake.operators.cleaning import by_column
from tierlake.plans.silver import process_table
from tierlake.plans.sqlsession import SqlSession
from tierlake.sources.catalogstore import Catalog
from tierlake.sources.landing import ingest_files
from tierlake.sources.snapshots import read_latest

DAY = datetime(2024, 3, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    inbox = tmp_path_factory.mktemp("inbox")
    root = str(tmp_path_factory.mktemp("lake"))
    customers = [
        {"customer_id": f"CUST{i:06d}", "first_name": f"First{i}", "last_name": "O'Neil, \"Jr\"", "email": f"c{i}@example.com",
         "created_at": f"2023-01-{i:02d}T10:00:00", "segment": ["retail", "business"][i % 2], "country": "DE"}
        for i in range(1, 11)]
    (inbox / "customers.json").write_text(json.dumps(customers))
    changed = [dict(c, country="AT") for c in customers[:3]]
    header = ",".join(customers[0])
    quoted = "\n".join(",".join('"' + v.replace('"', '""') + '"' for v in c.values()) for c in changed)
    (inbox / "customers_update.csv").write_text(f"{header}\n{quoted}\n")
    products = [
        {"product_id": f"PROD{i:06d}", "name": f"Product {i}", "category": "toys", "price": 10.5 + i, "cost": 5.0,
         "stock_quantity": i * 10, "supplier_id": f"SUP{i % 3:03d}"} for i in range(1, 11)]
    (inbox / "products.json").write_text(json.dumps(products))
    orders = [
        {"order_id": f"ORD{i:08d}", "customer_id": f"CUST{i % 12 + 1:06d}", "order_date": "2024-02-01T00:00:00",
         "status": " Shipped " if i % 2 else "open", "total_amount": 10.0 * i,
         "items": [{"product_id": f"PROD{k:06d}", "quantity": k, "unit_price": 1.5} for k in range(1, i % 3 + 2)],
         "shipping_country": "DE"} for i in range(1, 13)]
    (inbox / "orders.jsonl").write_text("\n".join(map(json.dumps, orders + orders[:2])))
    for table, names in {"customers": ["customers.json", "customers_update.csv"], "products": ["products.json"],
                         "orders": ["orders.jsonl"]}.items():
        ingest_files(spark, root, table, "web", [str(inbox / n) for n in names], at=DAY).collect()
    return root


def test_raw_files_to_facts(spark, shop):
    customers = process_table(spark, shop, "customers", dedup_columns=["customer_id"])
    assert (customers["records_in"], customers["records_out"]) == (13, 10)
    silver = read_latest(spark, shop, "silver", "customers")
    assert silver.where("country = 'AT'").count() == 3
    assert {r["last_name"] for r in silver.select("last_name").distinct().collect()} == {"O'Neil, \"Jr\""}
    products = process_table(spark, shop, "products", dedup_columns=["product_id"], schema={"stock_quantity": "float"})
    assert products["duplicates_removed"] == 0
    orders = process_table(
        spark, shop, "orders", dedup_columns=["order_id"], transformations={"status": by_column(lambda c: F.upper(F.trim(c)))})
    assert (orders["records_in"], orders["records_out"]) == (14, 12)
    assert dict(read_latest(spark, shop, "silver", "orders").dtypes)["items"].startswith("array<struct<")

    create_dimension_table(spark, shop, "dim_customer", "customers", ["customer_id", "segment"], "customer_sk")
    made = create_fact_table(
        spark, shop, "fact_sales", "orders", ["total_amount"], {"dim_customer": ("customer_id", "customer_fk")},
        {"total_amount": "sum"}, ["customer_fk", "status"])
    assert made["row_count"] == 10  # two orders name customers that do not exist
    session = SqlSession(spark, shop)
    session.register_all_tables()
    total = session.query_rows("SELECT sum(total_amount) AS t FROM gold_fact_sales")[0]["t"]
    assert total == sum(10.0 * i for i in range(1, 13) if i % 12 + 1 <= 10)
    nested = session.query_rows("""
        SELECT sum(item.quantity * item.unit_price) AS t FROM silver_orders LATERAL VIEW explode(items) AS item""")
    assert nested[0]["t"] == sum(k * 1.5 for i in range(1, 13) for k in range(1, i % 3 + 2))

    report = (QualityChecker().check_uniqueness(["order_id"]).check_value_range("total_amount", 0)
              .check_reference("customer_id", silver, "customer_id", 0.1)
              .run(read_latest(spark, shop, "silver", "orders"), "orders", "silver"))
    assert [r.passed for r in report.results] == [True, True, False]

    catalog = Catalog(spark, shop)
    catalog.register_table("orders", "bronze", f"{shop}/bronze/orders")
    catalog.publish("silver", "orders", [("orders", "bronze")], "Cleaned orders")
    catalog.publish("gold", "fact_sales", [("orders", "silver")])
    assert catalog.lineage("orders", "silver") == {
        "upstream": [{"name": "orders", "layer": "bronze"}], "downstream": [{"name": "fact_sales", "layer": "gold"}]}
    stats = {r["column_name"]: r for r in catalog.column_stats().where("table_name = 'orders'").collect()}
    assert stats["order_id"]["distinct_count"] == 12 and stats["items"]["distinct_count"] == 3
    assert {r["name"] for r in catalog.search("amount").collect()} == {"total_amount"}
