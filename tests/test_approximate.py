import re

from plans import plan_text

from tierlake.checks import all_checks


def test_no_sketch_is_held_for_each_order(spark, tmp_path):
    rows = [("R", 1), ("R", 1), ("R", 2), ("N", None), (None, 7), (None, None), ("N", None)]
    spark.createDataFrame(rows, "l_returnflag string, l_orderkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(0).selectExpr("id AS o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    found = all_checks()["s25_approximate"].run(spark, str(tmp_path))
    sketched = [line for line in plan_text(found).splitlines() if "approx_count_distinct" in line]
    assert sketched and not any(re.search(r"keys=\[[^\]]*l_orderkey", line) for line in sketched)
    assert {tuple(r) for r in found.collect()} == {("R", 2, True), ("N", 0, True), (None, 1, True)}
