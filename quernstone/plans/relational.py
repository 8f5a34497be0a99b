"""Relational and event queries: roll-ups, joins, windows, ranges, sessions, sketches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quernstone.operators import relational
from quernstone.plans.base import query
from quernstone.session import table


@query("SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def pricing_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02 00:00:00'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))


@query("SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def local_revenue(spark, sf_dir):
    t = lambda n: table(spark, sf_dir, n)
    j = t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey")).join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(t("supplier"), (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey"))).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, grouping(o_orderpriority) + grouping(o_orderstatus) AS level FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)")
def order_rollup(spark, sf_dir):
    o = table(spark, sf_dir, "orders").rollup("o_orderpriority", "o_orderstatus")
    return o.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), (F.grouping("o_orderpriority").cast("long") + F.grouping("o_orderstatus")).alias("level"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def line_cube(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, o_orderkey, rnk FROM (SELECT o_custkey AS c_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rnk FROM orders) WHERE rnk <= 3")
def top_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return o.withColumn("rnk", F.row_number().over(W.partitionBy("c_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))).where("rnk <= 3").select("c_custkey", "o_orderkey", "rnk")


@query("SELECT c_custkey, o_orderkey FROM customer FULL OUTER JOIN orders ON c_custkey = o_custkey WHERE o_orderkey IS NULL OR c_custkey IS NULL")
def unmatched_outer(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "full").where("o_orderkey is null or c_custkey is null").select("c_custkey", "o_orderkey")


@query("SELECT DISTINCT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def semi_customers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left_semi")


@query("SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 0")
def nation_intersect(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")).intersect(table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_nationkey"))


@query("SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def parts_except(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey").subtract(table(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_partkey"))


@query("SELECT l.event_id, r.value AS last_value FROM events l ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY 1, 2) r ON l.user_id = r.user_id AND l.ts >= r.ts WHERE l.event_type <> 'purchase'")
def asof_purchases(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    r = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("last_value"))
    return relational.asof_join(e.where("event_type <> 'purchase'").select("user_id", "ts", "event_id"), r, ["user_id"], "ts", ["last_value"]).select("event_id", "last_value")


@query("SELECT event_id, p_partkey FROM events JOIN part ON value >= p_retailprice / 20 AND value < p_retailprice / 20 + 0.5")
def range_join_prices(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "value")
    p = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") / 20).alias("lo"), (F.col("p_retailprice") / 20 + 0.5).alias("hi"))
    return relational.range_join(e, p, "value", "lo", "hi", 1.0).select("event_id", "p_partkey")


@query(
    "WITH g AS (SELECT event_id, user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) > 1800000000 THEN 1 ELSE 0 END AS n FROM events), s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g) SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS events, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) AS micros FROM s GROUP BY 1, 2"
)
def event_sessions(spark, sf_dir):
    s = relational.sessions(table(spark, sf_dir, "events"), ["user_id"], "ts", 1800)
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    return s.groupBy("user_id", "session").agg(F.count("*").alias("events"), (us(F.max("ts")) - us(F.min("ts"))).alias("micros"))


@query("SELECT event_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) // 1000000 AS start_s, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_windows(spark, sf_dir):
    g = table(spark, sf_dir, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select("event_type", F.unix_seconds(F.col("w.start").cast("timestamp")).alias("start_s"), "n", "total")


@query("SELECT event_id, CAST(regexp_extract(props, '\"k\":\\s*(-?\\d+)', 1) AS INTEGER) AS k FROM events WHERE regexp_matches(props, '\"k\":\\s*-?\\d+')")
def variant_get(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k")).where("k is not null")


@query("SELECT user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving, event_id FROM events")
def moving_average(spark, sf_dir):
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 0)
    return table(spark, sf_dir, "events").select("user_id", F.round(F.avg("value").over(w), 6).alias("moving"), "event_id")


@query("SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS open, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS filled FROM lineitem GROUP BY 1")
def status_pivot(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").pivot("l_linestatus", ["O", "F"]).count().select("l_returnflag", F.coalesce("O", F.lit(0)).alias("open"), F.coalesce("F", F.lit(0)).alias("filled"))


@query()
def approximate_counts(spark, sf_dir):
    """Distinct users and median value of each event type by sketches."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id").alias("users"), F.percentile_approx("value", 0.5).alias("median"))


@query("SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) AS z, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS building FROM customer")
def tabular_preprocessing(spark, sf_dir):
    c = relational.standardized(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), ["c_acctbal"])
    return relational.one_hot(c, "c_mktsegment", ["BUILDING"]).select("c_custkey", F.round("c_acctbal", 6).alias("z"), F.col("c_mktsegment_BUILDING").alias("building"))


@query("SELECT 'c' AS kind, c_nationkey AS nationkey, c_acctbal AS balance, NULL AS status FROM customer UNION ALL SELECT 's', s_nationkey, s_acctbal, 'supplier' FROM supplier")
def union_by_name(spark, sf_dir):
    from quernstone.operators.transforms import union

    c = table(spark, sf_dir, "customer").select(F.lit("c").alias("kind"), F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf_dir, "supplier").select(F.lit("s").alias("kind"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("status"))
    return union(c, s)


@query("SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def complete_lookup(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return relational.complete_left_join(o, c, "c_custkey").select("o_orderkey", "c_mktsegment")
