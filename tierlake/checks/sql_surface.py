"""SQL, passed to Spark as it is, and the two joins SQL lacks."""

from decimal import Decimal

from pyspark.sql import functions as F

from tierlake.checks import Check, table
from tierlake.operators.joins import range_join, theta_totals
from tierlake.operators.scans import asof_join, first_value, in_pieces, range_sum
from tierlake.plans.sqlsession import SqlSession
from tierlake.session import scratch_root
from tierlake.sources.snapshots import write_snapshot

_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def _ask(text):
    """Run the text over views of the tables it mentions."""

    def run(spark, folder):
        for name in _TABLES:
            if name in text:
                table(spark, folder, name).createOrReplaceTempView(name)
        return spark.sql(text)

    return run


def _same(text):
    """The text means the same to Spark and to the checking engine."""
    return Check(_ask(text), text)


def registered(spark, folder):
    root = scratch_root(spark)
    write_snapshot(table(spark, folder, "orders"), root, "silver", "shop.orders-eu")
    write_snapshot(table(spark, folder, "customer"), root, "gold", "dim_customer")
    session = SqlSession(spark, root)
    session.register_all_tables()
    return session.query("""
        SELECT c_mktsegment, count(*) AS orders, count(DISTINCT c_custkey) AS buyers
        FROM silver_shop_orders_eu JOIN gold_dim_customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")


def preview(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("orders")
    session = SqlSession(spark, "unused")
    return session.preview("SELECT o_orderkey, o_totalprice AS credit_limit FROM orders ORDER BY o_totalprice DESC, o_orderkey;")


def asof(spark, folder):
    events = table(spark, folder, "events")
    buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    clicks = events.where("event_type = 'click'").select("user_id", "ts", "event_id", "value")
    return asof_join(buys, clicks, "user_id", "ts", {"event_id": "click_id", "value": "click_value"}, "event_id")


def _events_in_pieces(spark, folder):
    events = table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    return in_pieces(events, ["user_id"], [F.col("ts").asc_nulls_first(), F.col("event_id").asc()])


def analytic(spark, folder):
    """Over all events, a user's rows in as many tasks as they need."""
    found = _events_in_pieces(spark, folder).ranked(F.col("day"), "r", "dr").tiled(4, "quarter").near(
        1, 2, previous=lambda w: F.lag("event_type").over(w), later=lambda w: F.lead("event_type", 2).over(w))
    found = found.running(first_event=first_value(F.col("event_id"))).result()
    return found.select("event_id", "user_id", F.col("r").cast("long"), F.col("dr").cast("long"), "quarter", "previous", "later", "first_event")


def rows_frame(spark, folder):
    found = _events_in_pieces(spark, folder).near(
        3, 2, recent=lambda w: F.sum("event_id").over(w.rowsBetween(-3, 0)), peak=lambda w: F.max("value").over(w.rowsBetween(-3, 0)),
        ahead=lambda w: F.min("value").over(w.rowsBetween(1, 2)))
    return found.result().select("event_id", "recent", "peak", "ahead")


def range_frame(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", F.col("ts").cast("date").alias("day"))
    found = range_sum(events, "user_id", "day", F.lit(1).cast("long"), F.date_sub("day", 3), "in_three_days")
    return found.select("event_id", "in_three_days")


def bands(spark, folder):
    """Orders in price bands made from the part sizes."""
    sizes = table(spark, folder, "part").select("p_size").distinct()
    priced = sizes.select("p_size", (F.col("p_size") * 9000.0).alias("low"), (F.col("p_size") * 9000.0 + 4500).alias("high"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return range_join(orders, priced, "o_totalprice", "low", "high", 4500).select("o_orderkey", "p_size", "low", "high")


def below_both(spark, folder):
    """Per supplier the parts that cost less than its balance and are no larger than its nation's number."""
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    below = theta_totals(
        parts, suppliers, [("p_retailprice", "<", "s_acctbal"), ("p_size", "<=", "s_nationkey")],
        {"parts": ("count", F.lit(1)), "sizes": ("sum", F.col("p_size")), "largest_key": ("max", F.col("p_partkey"))})
    return below.groupBy("s_suppkey").agg(
        F.sum("parts").alias("parts"), F.sum("sizes").alias("sizes"), F.max("largest_key").alias("largest_key"))


def approximate(spark, folder):
    """Distinct orders by return flag, and whether a sketch of 0.02 comes near their number.

    Beside ``count(DISTINCT)`` a sketch would be held for each flag and order. Repeats change no sketch,
    so both are taken over the distinct pairs, with one sketch a flag and task.
    """
    orders = table(spark, folder, "lineitem").select("l_returnflag", "l_orderkey").distinct()
    exact, sketch = F.count("l_orderkey"), F.approx_count_distinct("l_orderkey", 0.02)
    return orders.groupBy("l_returnflag").agg(
        exact.alias("orders"), (F.abs(sketch - exact) <= F.lit(Decimal("0.1")) * exact).alias("close"))


CHECKS = {
    "s1_s3_registered_views": Check(registered, """
        SELECT c_mktsegment, count(*) AS orders, count(DISTINCT c_custkey) AS buyers
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"""),
    "s4_default_limit": Check(preview, """
        SELECT o_orderkey, o_totalprice AS credit_limit FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"""),
    "s10_filters": _same("""
        SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status,
               CASE WHEN o_totalprice > 300000 THEN 'big' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'small' END AS size
        FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 50000 AND 400000
          AND o_orderpriority LIKE '%-%' AND o_orderdate >= DATE '1996-01-01' AND o_custkey IS NOT NULL"""),
    "s11_inner_join": _same("""
        SELECT r_name, n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name"""),
    "s11_left_join": _same("""
        SELECT c_custkey, c_mktsegment, orders FROM customer
        LEFT JOIN (SELECT o_custkey, count(*) AS orders FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey) o
               ON c_custkey = o_custkey"""),
    "s11_right_join": _same("""
        SELECT s_name, n_name FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey + 10"""),
    "s11_full_join": _same("""
        SELECT coalesce(o_custkey, s_suppkey + 1450) AS k, orders, s_acctbal
        FROM (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey) o
        FULL JOIN supplier ON o_custkey = s_suppkey + 1450"""),
    # distinct keys first: of a hot key one row per map task enters the join
    "s11_semi_join": _same("""
        SELECT c_custkey, c_name FROM customer SEMI JOIN (SELECT DISTINCT o_custkey FROM orders) o ON c_custkey = o_custkey"""),
    "s11_anti_join": _same("""
        SELECT o_orderkey FROM orders
        ANTI JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') r ON o_orderkey = l_orderkey"""),
    "s12_range_join": Check(bands, """
        SELECT o_orderkey, p_size, p_size * CAST(9000 AS DOUBLE) AS low, p_size * CAST(9000 AS DOUBLE) + 4500 AS high
        FROM orders JOIN (SELECT DISTINCT p_size FROM part)
          ON o_totalprice >= p_size * 9000 AND o_totalprice < p_size * 9000 + 4500"""),
    "s12_theta_join": Check(below_both, """
        SELECT s_suppkey, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS sizes, max(p_partkey) AS largest_key
        FROM part JOIN supplier ON p_retailprice < s_acctbal AND p_size <= s_nationkey GROUP BY s_suppkey"""),
    "s13_asof_join": Check(asof, """
        SELECT b.event_id, b.user_id, b.ts, b.value, c.event_id AS click_id, c.value AS click_value
        FROM (SELECT * FROM events WHERE event_type = 'purchase') b
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON b.user_id = c.user_id AND b.ts >= c.ts"""),
    "s14_aggregation": _same("""
        SELECT l_returnflag, l_linestatus, count(*) AS lines, count(DISTINCT l_suppkey) AS suppliers,
               count(*) FILTER (WHERE l_discount > 0.05) AS discounted, round(sum(l_quantity), 2) AS quantity,
               CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18, 4))) AS DOUBLE) AS revenue, round(avg(l_extendedprice), 2) AS price
        FROM lineitem WHERE l_shipdate <= DATE '1998-09-02'
        GROUP BY l_returnflag, l_linestatus HAVING count(*) > 10"""),
    "s14_distinct": _same("SELECT DISTINCT event_type, CAST(floor(value / 10) AS BIGINT) AS tens FROM events"),
    "s15_cube": _same("""
        SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) AS BIGINT) AS all_flags,
               CAST(grouping(l_linestatus) AS BIGINT) AS all_states, count(*) AS lines
        FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)"""),
    "s15_rollup": _same("""
        SELECT p_brand, p_type, count(*) AS parts, CAST(max(p_size) AS BIGINT) AS largest
        FROM part GROUP BY ROLLUP (p_brand, p_type)"""),
    "s15_grouping_sets": _same("""
        SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM orders
        GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())"""),
    "s16_top_per_group": _same("""
        SELECT o_custkey, o_orderkey, CAST(place AS BIGINT) AS place FROM (
            SELECT o_custkey, o_orderkey,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders)
        WHERE place <= 3"""),
    "s16_analytic": Check(analytic, """
        SELECT event_id, user_id, rank() OVER w AS r, dense_rank() OVER w AS dr, ntile(4) OVER t AS quarter,
               lag(event_type) OVER t AS previous, lead(event_type, 2) OVER t AS later, first_value(event_id) OVER t AS first_event
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY CAST(ts AS DATE)), t AS (PARTITION BY user_id ORDER BY ts, event_id)"""),
    "s17_rows_frame": Check(rows_frame, """
        SELECT event_id, CAST(sum(event_id) OVER (t ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS BIGINT) AS recent,
               max(value) OVER (t ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS peak,
               min(value) OVER (t ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS ahead
        FROM events WINDOW t AS (PARTITION BY user_id ORDER BY ts, event_id)"""),
    "s17_range_frame": Check(range_frame, """
        SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)
                                        RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW) AS in_three_days
        FROM events"""),
    "s18_top_k": _same("""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
        ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100 OFFSET 50"""),
    "s19_set_operations": _same("""
        SELECT 'both' AS kind, k FROM (SELECT DISTINCT c_nationkey AS k FROM customer INTERSECT SELECT DISTINCT s_nationkey FROM supplier) a
        UNION ALL
        SELECT 'idle', k FROM (SELECT DISTINCT c_custkey AS k FROM customer EXCEPT SELECT DISTINCT o_custkey FROM orders) b
        UNION ALL
        SELECT 'either', k FROM (SELECT o_custkey AS k FROM orders UNION SELECT s_suppkey FROM supplier) c"""),
    "s19_texts_in_common": _same("""
        SELECT text FROM documents UNION SELECT text FROM benchmark"""),
    "s20_subqueries": _same("""
        WITH spend AS (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY o_custkey)
        SELECT c_custkey, round(total, 2) AS total FROM customer JOIN spend ON c_custkey = o_custkey
        WHERE total > (SELECT avg(total) FROM spend)
          AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)
          AND EXISTS (SELECT 1 FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') o WHERE o.k = c_custkey)"""),
    "s20_correlated_scalar": _same("""
        SELECT o_orderkey, o_orderpriority FROM orders o
        WHERE o_totalprice > (SELECT 1.7 * avg(i.o_totalprice) FROM orders i
                              WHERE i.o_orderpriority = o.o_orderpriority AND i.o_orderstatus = o.o_orderstatus)"""),
    "s21_strings": _same("""
        SELECT page_id, upper(split_part(url, ':', 1)) AS scheme, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
               concat_ws('|', split_part(url, '/', 4), substring(url, 1, 12)) AS parts, trim(replace(url, '#', ' ')) AS plain,
               CAST(length(html) AS BIGINT) AS chars, html LIKE '%<table%' AS has_table
        FROM pages"""),
    "s21_whole_texts": _same("""
        SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, md5(text) AS digest,
               CAST(length(text) - length(replace(text, ' ', '')) AS BIGINT) AS blanks,
               text ILIKE '%license%' AS licensed
        FROM documents"""),
    "s22_dates": Check(_ask("""
        SELECT o_orderkey, CAST(CAST(date_trunc('MONTH', o_orderdate) AS DATE) AS STRING) AS month, CAST(year(o_orderdate) AS BIGINT) AS y,
               CAST(quarter(o_orderdate) AS BIGINT) AS q, CAST(datediff(DATE '2000-01-01', o_orderdate) AS BIGINT) AS days,
               CAST(to_date(o_orderdate) AS STRING) AS d, date_format(o_orderdate, 'yyyy/MM/dd') AS text,
               CAST(last_day(o_orderdate) AS STRING) AS month_end,
               CAST(date_add(to_date(o_orderdate), 10) AS STRING) AS due
        FROM orders"""), """
        SELECT o_orderkey, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, year(o_orderdate) AS y,
               quarter(o_orderdate) AS q, date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS days,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, strftime(o_orderdate, '%Y/%m/%d') AS text,
               CAST(last_day(o_orderdate) AS VARCHAR) AS month_end,
               CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 10 DAY AS DATE) AS VARCHAR) AS due
        FROM orders"""),
    "s23_math": _same("""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / 7, 3) AS seventh, abs(l_discount - l_tax) AS gap,
               CAST(floor(l_extendedprice) AS BIGINT) AS whole, CAST(ceil(l_quantity / 3) AS BIGINT) AS thirds,
               round(power(l_quantity, 2), 2) AS squared, round(sqrt(l_quantity), 6) AS root,
               greatest(l_discount, l_tax) AS larger, least(l_discount, l_tax) AS smaller,
               CAST(l_orderkey % 7 AS BIGINT) AS rest, round(ln(l_quantity), 6) AS log
        FROM lineitem"""),
    "s24_arrays": Check(_ask("""
        SELECT label, place, count(*) AS vectors, round(avg(x), 5) AS mean, CAST(max(dims) AS BIGINT) AS dims
        FROM (SELECT label, size(embedding) AS dims, posexplode(embedding) AS (place, x) FROM embeddings)
        GROUP BY label, place"""), """
        SELECT label, CAST(place - 1 AS INTEGER) AS place, count(*) AS vectors, round(avg(CAST(x AS DOUBLE)), 5) AS mean,
               CAST(max(dims) AS BIGINT) AS dims
        FROM (SELECT label, len(embedding) AS dims, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS place
              FROM embeddings)
        GROUP BY label, place"""),
    "s24_json": Check(_ask("""
        SELECT event_id, CAST(get_json_object(props, '$.k') AS BIGINT) AS k, from_json(props, 'k BIGINT').k + 1 AS next_k,
               element_at(from_json(props, 'MAP<STRING, BIGINT>'), 'k') AS mapped FROM events"""), """
        SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) + 1 AS next_k,
               CAST(json_extract(props, '$.k') AS BIGINT) AS mapped FROM events"""),
    "s24_collected": Check(_ask("""
        SELECT l_orderkey, array_join(array_sort(array_agg(DISTINCT l_linenumber)), ',') AS numbers,
               count(*) AS parts FROM lineitem GROUP BY l_orderkey"""), """
        SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_linenumber)), ',') AS numbers, count(*) AS parts
        FROM lineitem GROUP BY l_orderkey"""),
    # median keeps a count per distinct value: quantities are a few dozen
    "s25_statistics": _same("""
        SELECT l_returnflag, median(l_quantity) AS middle, round(stddev_samp(l_extendedprice), 2) AS spread,
               round(var_samp(l_discount), 6) AS variance, round(corr(l_quantity, l_extendedprice), 6) AS correlation,
               max_by(l_orderkey, l_extendedprice + l_orderkey / 1e9) AS dearest
        FROM lineitem GROUP BY l_returnflag"""),
    # the sketch must come within its error bound of the exact count
    "s25_approximate": Check(approximate, """
        SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_orderkey) > 0 AS close
        FROM lineitem GROUP BY l_returnflag"""),
    "s26_pivot": Check(_ask("""
        SELECT * FROM (SELECT user_id, event_type, event_id FROM events)
        PIVOT (count(event_id) FOR event_type IN ('click' AS clicks, 'view' AS views, 'purchase' AS purchases))"""), """
        SELECT user_id, nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS clicks,
               nullif(count(*) FILTER (WHERE event_type = 'view'), 0) AS views,
               nullif(count(*) FILTER (WHERE event_type = 'purchase'), 0) AS purchases
        FROM events GROUP BY user_id"""),
    "s26_unpivot": Check(_ask("""
        SELECT * FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, p_retailprice AS price FROM part)
        UNPIVOT (amount FOR measure IN (size, price))"""), """
        SELECT p_partkey, 'size' AS measure, CAST(p_size AS DOUBLE) AS amount FROM part
        UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part"""),
}
