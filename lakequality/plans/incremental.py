"""Incremental loading, de-duplication, upserts, paging, newest and oldest rows."""

from pyspark.sql import functions as F

from lakequality.operators import analytics, incremental, packs, quality
from lakequality.plans import sql
from lakequality.plans.quality import silver_orders
from lakequality.plans.registry import query
from lakequality.plans.rules import ITEM, ITEM_SQL
from lakequality.session import materialize
from lakequality.sources import samples


@query(
    "incremental_unprocessed",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
""",
)
def incremental_unprocessed(spark, sf_dir):
    lines = samples.table(spark, sf_dir, "lineitem")
    done = samples.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    processed = done.select(F.col("o_orderkey").alias("l_orderkey"))
    return incremental.unprocessed(lines, processed, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query(
    "dedup_latest",
    """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS place
  FROM lineitem) WHERE place = 1
""",
)
def dedup_latest(spark, sf_dir):
    lines = samples.table(spark, sf_dir, "lineitem")
    return incremental.newest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "upsert_merge",
    """
WITH changes AS (
  SELECT CASE WHEN l_linenumber = 7 THEN l_orderkey + 1000000000000 ELSE l_orderkey END AS o_orderkey,
         'R' AS o_orderstatus, l_extendedprice AS o_totalprice, l_shipdate AS o_orderdate
  FROM lineitem WHERE l_returnflag = 'R'
),
settled AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey
      ORDER BY o_orderdate DESC, o_orderstatus DESC, o_totalprice DESC) AS place FROM changes)
  WHERE place = 1
)
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       round(CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END, 6)
         AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate
FROM orders t FULL JOIN settled s ON t.o_orderkey = s.o_orderkey
""",
)
def upsert_merge(spark, sf_dir):
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    target = samples.table(spark, sf_dir, "orders").select(*columns)
    lines = samples.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    changes = lines.select(
        F.when(F.col("l_linenumber") == 7, F.col("l_orderkey") + 1000000000000)
        .otherwise(F.col("l_orderkey"))
        .alias("o_orderkey"),
        F.lit("R").alias("o_orderstatus"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_shipdate").alias("o_orderdate"),
    )
    return incremental.upsert(target, changes, ["o_orderkey"], "o_orderdate")


@query("union_layers", f"WITH {sql.VALIDATED} SELECT {ITEM_SQL}, failed_rules > 0 AS quarantined FROM validated")
def union_layers(spark, sf_dir):
    rules = packs.order_rules(samples.ORDERS_AS_OF)
    sided = quality.with_side(samples.order_items(spark, sf_dir), rules).select(*ITEM, "quarantined")
    sided = materialize(sided, "sides")
    good = sided.filter("NOT quarantined").select(*ITEM, F.lit(False).alias("quarantined"))
    bad = sided.filter("quarantined").select(F.lit(True).alias("quarantined"), *ITEM)
    return incremental.union_all([good, bad])


@query(
    "paged_batches",
    """
SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) AS position,
       CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 1000) AS BIGINT) AS page
FROM events
""",
)
def paged_batches(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "events").select("event_id", "event_type")
    return incremental.paged(rows, ["event_id"], 1000)


@query(
    "latest_rows",
    """
SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 10
""",
)
def latest_rows(spark, sf_dir):
    rows = samples.table(spark, sf_dir, "events")
    return analytics.latest_rows(rows, "ts", 10, "event_id").select(
        "event_id", "ts", "event_type", "value"
    )


@query(
    "lineage_sample",
    f"""
WITH {sql.VALIDATED}
SELECT ship_date AS validated_at, {ITEM_SQL}, vendor_id, quality_flag,
       sha256('orders:0') AS lineage_id
FROM validated ORDER BY ship_date, {ITEM_SQL}, vendor_id, quantity LIMIT 10
""",
)
def lineage_sample(spark, sf_dir):
    rows = silver_orders(spark, sf_dir).withColumn("lineage_id", quality.lineage("orders", 0))
    return analytics.earliest_rows(rows, "validated_at", 10, *ITEM, "vendor_id", "quantity").select(
        "validated_at", *ITEM, "vendor_id", "quality_flag", "lineage_id"
    )
