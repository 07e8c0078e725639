"""Clustering and versions of tables in the shared folder."""

import datetime
import uuid

from pyspark.sql import functions as F

from lakequality.operators import layout, maintenance, sinks, statistics, versions
from lakequality.plans import sql
from lakequality.plans.bronze import written_bronze
from lakequality.plans.registry import query
from lakequality.session import materialize, work_dir
from lakequality.sources import samples

ZORDERED = ("l_partkey", "l_suppkey", "l_shipdate")
N_FILES = 64


@query(
    "zorder_layout",
    """
WITH ends AS (
  SELECT max(l_partkey) // 10 AS part, max(l_suppkey) // 10 AS supp,
         min(l_shipdate)::DATE + CAST((max(l_shipdate)::DATE - min(l_shipdate)::DATE) // 10 AS INTEGER) AS ship
  FROM lineitem
)
SELECT 'all' AS column_name, count(*) AS n, round(sum(l_quantity), 2) AS quantity, true AS few_files FROM lineitem
UNION ALL
SELECT 'l_partkey', count(*), round(sum(l_quantity), 2), true FROM lineitem, ends WHERE l_partkey <= part
UNION ALL
SELECT 'l_suppkey', count(*), round(sum(l_quantity), 2), true FROM lineitem, ends WHERE l_suppkey <= supp
UNION ALL
SELECT 'l_shipdate', count(*), round(sum(l_quantity), 2), true FROM lineitem, ends WHERE l_shipdate::DATE <= ship
""",
)
def zorder_layout(spark, sf_dir):
    """Line items clustered on three columns; a filter on each finds its rows in less than half of the files."""
    path = work_dir(spark, "zorder")
    items = samples.table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    layout.zorder(items, path, ZORDERED, files=N_FILES)
    rows = spark.read.parquet(path)
    ends = rows.agg(
        F.min("l_partkey").alias("low_part"), F.floor(F.max("l_partkey") / 10).alias("part"),
        F.min("l_suppkey").alias("low_supp"), F.floor(F.max("l_suppkey") / 10).alias("supp"),
        F.min("l_shipdate").alias("low_ship"),
        F.expr("date_add(min(l_shipdate), CAST(floor(datediff(max(l_shipdate), min(l_shipdate)) / 10) AS INT))").alias("ship"),
    ).first()
    asked = {
        "l_partkey": (ends.low_part, ends.part),
        "l_suppkey": (ends.low_supp, ends.supp),
        "l_shipdate": (ends.low_ship, ends.ship),
    }
    read = layout.files_to_read(rows, asked).select("column_name", (F.col("read_files") * 2 < F.col("files")).alias("few_files"))
    inside = {name: F.col(name) <= F.lit(high) for name, (_, high) in asked.items()}
    inside["all"] = F.lit(True)
    sums = rows.agg(
        *(F.count_if(where).alias(f"n_{name}") for name, where in inside.items()),
        *(F.sum(F.when(where, F.col("l_quantity"))).alias(f"q_{name}") for name, where in inside.items()),
    )
    listed = F.array(
        *(
            F.struct(F.lit(name).alias("column_name"), F.col(f"n_{name}").alias("n"), F.round(f"q_{name}", 2).alias("quantity"))
            for name in inside
        )
    )
    found = sums.select(F.inline(listed)).join(read, "column_name", "left")
    return found.withColumn("few_files", F.coalesce("few_files", F.col("column_name") == "all"))


@query(
    "vacuum_versions",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, count(*) AS n, CAST(sum(payload_size_bytes) AS BIGINT) AS bytes,
       CASE WHEN ingestion_date < DATE '2024-01-16' THEN 3 ELSE 1 END AS folders_before,
       CASE WHEN ingestion_date < DATE '2024-01-16' THEN 2 ELSE 1 END AS folders_kept,
       1 AS folders_left
FROM bronze GROUP BY ingestion_date
""",
)
def vacuum_versions(spark, sf_dir):
    """Compact the older dates twice, switch to the first version, and remove what nothing reads.

    The first vacuum spares the second version, which is younger than its limit; a later one takes it.
    """
    rows = written_bronze(spark, sf_dir).select("record_id", "payload_size_bytes", "ingestion_date")
    table = f"versions_{uuid.uuid4().hex}"
    root = work_dir(spark, table)
    sinks.save_table(
        rows.repartitionByRange("ingestion_date"), table, mode="overwrite", partitions=["ingestion_date"], path=f"{root}/v0"
    )
    try:
        older = rows.filter("ingestion_date < DATE '2024-01-16'")
        maintenance.compact(older, f"{root}/v1", partitions=["ingestion_date"], cluster_by=["record_id"])
        maintenance.repoint(spark, table, f"{root}/v1")
        newest = versions.stored_files(spark, root).agg(F.max("modified")).first()[0]
        limit = newest + datetime.timedelta(milliseconds=1)
        maintenance.compact(older, f"{root}/v2", partitions=["ingestion_date"], cluster_by=["payload_size_bytes"])
        counts = [_folders(spark, root, "folders_before")]
        versions.vacuum(spark, [table], root, limit)
        counts.append(_folders(spark, root, "folders_kept"))
        versions.vacuum(spark, [table], root, limit + datetime.timedelta(days=1))
        counts.append(_folders(spark, root, "folders_left"))
        left = spark.table(table).groupBy("ingestion_date").agg(
            F.count(F.lit(1)).alias("n"), F.sum("payload_size_bytes").cast("bigint").alias("bytes")
        )
        for listed in counts:
            left = left.join(listed, "ingestion_date", "left")
        return materialize(left, "versions")
    finally:
        spark.sql(f"DROP TABLE {table}")


def _folders(spark, root, name):
    """Folders with files for each date, kept as they are now."""
    date = F.regexp_extract("folder", "ingestion_date=([0-9-]+)", 1).cast("date").alias("ingestion_date")
    listed = versions.stored_files(spark, root).select(date, "folder")
    return materialize(listed.groupBy("ingestion_date").agg(F.count_distinct("folder").cast("int").alias(name)), "folders")


@query(
    "column_statistics",
    """
WITH figures AS (
  SELECT count(*) AS n, min(o_orderkey)::VARCHAR AS min_key, max(o_orderkey)::VARCHAR AS max_key,
         min(cust)::VARCHAR AS min_cust, max(cust)::VARCHAR AS max_cust, count(*) - count(cust) AS no_cust,
         min(day)::VARCHAR AS min_day, max(day)::VARCHAR AS max_day, count(*) - count(day) AS no_day,
         max(length(o_orderpriority)) AS long_priority, max(length(o_orderstatus)) AS long_status
  FROM (SELECT *, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS cust,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate::DATE END AS day FROM orders)
)
SELECT 'o_orderkey' AS column_name, min_key AS min_value, max_key AS max_value, 0::BIGINT AS nulls, 8::BIGINT AS max_bytes, n AS table_rows, true AS fresh FROM figures
UNION ALL SELECT 'cust', min_cust, max_cust, no_cust, 8, n, true FROM figures
UNION ALL SELECT 'day', min_day, max_day, no_day, 4, n, true FROM figures
UNION ALL SELECT 'o_orderpriority', NULL, NULL, 0, long_priority, n, true FROM figures
UNION ALL SELECT 'o_orderstatus', NULL, NULL, 0, long_status, n, true FROM figures
""",
)
def column_statistics(spark, sf_dir):
    """Statistics of an analysed table; `fresh` says that they are those of the table, distinct values within 5 %."""
    orders = samples.table(spark, sf_dir, "orders")
    rows = orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey")).alias("cust"),
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate").cast("date")).alias("day"),
        "o_orderpriority",
        "o_orderstatus",
    )
    table = f"statistics_{uuid.uuid4().hex}"
    sinks.save_table(rows, table, mode="overwrite", path=work_dir(spark, table))
    try:
        maintenance.analyze(spark, table, max_error=0.01)
        known = statistics.column_statistics(spark, table)
        stale = statistics.stale_columns(spark, table, rows.columns).select("column_name", F.lit(False).alias("fresh")).distinct()
        told = known.withColumn("table_rows", F.lit(statistics.table_rows(spark, table)).cast("bigint")).join(stale, "column_name", "left")
        return materialize(
            told.select("column_name", "min_value", "max_value", "nulls", "max_bytes", "table_rows", F.coalesce("fresh", F.lit(True)).alias("fresh")),
            "statistics",
        )
    finally:
        spark.sql(f"DROP TABLE {table}")


@query(
    "catalog_repair",
    """
WITH rows AS (
  SELECT event_id, CASE event_type WHEN 'click' THEN 'a/b: 100%' WHEN 'view' THEN NULL ELSE event_type END AS site,
         day(ts) > 15 AS late FROM events
),
steps AS (
  SELECT 'written' AS step, site, count(*) AS n FROM rows WHERE NOT late GROUP BY ALL
  UNION ALL SELECT 'repaired', site, count(*) FROM rows WHERE NOT late GROUP BY ALL
  UNION ALL SELECT 'added', site, count(*) FROM rows WHERE NOT late GROUP BY ALL
  UNION ALL SELECT 'added', 'late', count(*) FROM rows WHERE late GROUP BY ALL
  UNION ALL SELECT 'dropped', site, count(*) FROM rows WHERE NOT late AND site IS DISTINCT FROM 'a/b: 100%' GROUP BY ALL
  UNION ALL SELECT 'dropped', 'late', count(*) FROM rows WHERE late GROUP BY ALL
)
SELECT step, site, n, CAST(CASE step WHEN 'repaired' THEN (SELECT count(*) FROM steps WHERE step = 'written') END AS INTEGER) AS found
FROM steps WHERE step <> 'written'
""",
)
def catalog_repair(spark, sf_dir):
    """Folders written behind the catalog's back are found, one is added from elsewhere, one is dropped.

    Partition values hold characters that folder names escape, and null.
    """
    kind = F.col("event_type")
    site = F.when(kind == "click", "a/b: 100%").when(kind != "view", kind)
    rows = samples.table(spark, sf_dir, "events").select("event_id", F.dayofmonth("ts").alias("day"), site.alias("site"))
    table = f"repair_{uuid.uuid4().hex}"
    path, elsewhere = work_dir(spark, table), work_dir(spark, f"{table}-late")
    maintenance.create_table(spark, table, "event_id BIGINT, site STRING", partitions=["site"], path=path)
    try:
        rows.filter("day <= 15").select("event_id", "site").write.mode("append").partitionBy("site").parquet(path)
        found = maintenance.repair(spark, table)
        steps = [_by_site(spark, table, "repaired", found)]
        rows.filter("day > 15").select("event_id").write.parquet(elsewhere)
        maintenance.add_partition(spark, table, {"site": "late"}, elsewhere)
        spark.catalog.refreshTable(table)
        steps.append(_by_site(spark, table, "added"))
        maintenance.drop_partitions(spark, table, [{"site": "a/b: 100%"}])
        spark.catalog.refreshTable(table)
        steps.append(_by_site(spark, table, "dropped"))
        return steps[0].unionByName(steps[1]).unionByName(steps[2])
    finally:
        spark.sql(f"DROP TABLE {table}")


def _by_site(spark, table, step, found=None):
    """Rows of each registered partition as they are now."""
    listed = maintenance.partitions(spark, table).select(F.col("site").alias("known"))
    counted = spark.table(table).groupBy("site").agg(F.count(F.lit(1)).alias("n"))
    both = listed.join(counted, F.col("known").eqNullSafe(F.col("site")), "full")
    return materialize(
        both.select(F.lit(step).alias("step"), F.coalesce("known", "site").alias("site"), "n", F.lit(found).cast("int").alias("found")), "repair"
    )
