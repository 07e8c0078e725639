"""Table upkeep on tables written to the shared folder."""

import uuid

from pyspark.sql import functions as F

from lakequality.operators import maintenance, sinks
from lakequality.plans import sql
from lakequality.plans.bronze import written_bronze
from lakequality.plans.quality import silver_orders
from lakequality.plans.registry import query
from lakequality.session import work_dir
from lakequality.sources import samples


@query(
    "table_statistics",
    f"""
WITH {sql.VALIDATED}
SELECT CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
       count(*) AS n, CAST(count_if(quality_flag = 'PASS') AS BIGINT) AS pass_records,
       round(avg(quality_score), 6) AS avg_score, max(ship_date) AS newest
FROM validated GROUP BY 1, 2
""",
)
def table_statistics(spark, sf_dir):
    rows = silver_orders(spark, sf_dir).withColumns(
        {"order_year": F.year("order_date"), "order_month": F.month("order_date")}
    )
    return maintenance.table_statistics(rows, ["order_year", "order_month"], "validated_at")


@query(
    "recent_partitions",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, ingestion_hour, count(*) AS n FROM bronze GROUP BY 1, 2
ORDER BY ingestion_date DESC, ingestion_hour DESC LIMIT 10
""",
)
def recent_partitions(spark, sf_dir):
    rows = samples.bronze_events(spark, sf_dir)
    return maintenance.recent_partitions(rows, ["ingestion_date", "ingestion_hour"])


@query(
    "storage_stats",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, count(*) AS n, true AS has_files, true AS has_bytes FROM bronze GROUP BY 1
""",
)
def storage_stats(spark, sf_dir):
    stats = maintenance.storage_stats(written_bronze(spark, sf_dir), "ingestion_date")
    return stats.select(
        "ingestion_date",
        "n",
        (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") > 0).alias("has_bytes"),
    )


@query(
    "retention_candidates",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, count(*) AS n FROM bronze
WHERE ingestion_date < DATE '2024-01-31' - 10 GROUP BY 1
""",
)
def retention_candidates(spark, sf_dir):
    as_of = F.lit("2024-01-31").cast("date")
    return maintenance.retention_candidates(
        written_bronze(spark, sf_dir), "ingestion_date", as_of, 10
    )


@query(
    "table_compaction",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, record_id, log_partition, payload_size_bytes FROM bronze
""",
)
def table_compaction(spark, sf_dir):
    path = work_dir(spark, "compacted")
    maintenance.compact(
        written_bronze(spark, sf_dir),
        path,
        partitions=["ingestion_date"],
        cluster_by=["log_partition", "record_id"],
    )
    return spark.read.parquet(path).select(
        "ingestion_date", "record_id", "log_partition", "payload_size_bytes"
    )


def _saved(spark, rows, partitions):
    """An external catalog table of its own for one query, with few files in each partition."""
    rows = rows.repartitionByRange(*partitions)
    name = f"upkeep_{uuid.uuid4().hex}"
    sinks.save_table(rows, name, mode="overwrite", partitions=partitions, path=work_dir(spark, name))
    return name


@query(
    "compaction_switch",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, count(*) AS n, CAST(sum(payload_size_bytes) AS BIGINT) AS bytes
FROM bronze GROUP BY ingestion_date
""",
)
def compaction_switch(spark, sf_dir):
    """Compact the older half of the dates and switch to it; every date keeps its rows."""
    rows = written_bronze(spark, sf_dir).select("record_id", "payload_size_bytes", "ingestion_date")
    table = _saved(spark, rows, ["ingestion_date"])
    path = work_dir(spark, "compacted-half")
    older = spark.table(table).filter("ingestion_date < DATE '2024-01-16'")
    maintenance.compact(older, path, partitions=["ingestion_date"], cluster_by=["record_id"])
    maintenance.repoint(spark, table, path)
    return spark.table(table).groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("payload_size_bytes").cast("bigint").alias("bytes")
    )


@query(
    "retention_drop",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, 'part:' || (CAST(log_partition AS INTEGER) % 2) AS site, count(*) AS n FROM bronze
WHERE ingestion_date >= DATE '2024-01-31' - 10 GROUP BY 1, 2
""",
)
def retention_drop(spark, sf_dir):
    """What is left of a table, with a partition value that its folder escapes, after the drop."""
    site = F.concat(F.lit("part:"), (F.col("log_partition").cast("int") % 2).cast("string"))
    rows = written_bronze(spark, sf_dir).select("record_id", "ingestion_date", site.alias("site"))
    table = _saved(spark, rows, ["ingestion_date", "site"])
    maintenance.expire(spark, table, "ingestion_date", "2024-01-31", 10)
    return spark.table(table).groupBy("ingestion_date", "site").agg(F.count(F.lit(1)).alias("n"))


@query(
    "table_append",
    f"""
WITH {sql.BRONZE}
SELECT ingestion_date, record_id, payload_size_bytes FROM bronze
""",
)
def table_append(spark, sf_dir):
    """Overwrite an external table with the older dates, then append the others to it."""
    rows = written_bronze(spark, sf_dir).select("record_id", "payload_size_bytes", "ingestion_date")
    older = F.col("ingestion_date") < F.lit("2024-01-16").cast("date")
    table = _saved(spark, rows.filter(older), ["ingestion_date"])
    sinks.save_table(rows.filter(~older), table, partitions=["ingestion_date"])
    return spark.table(table).select("ingestion_date", "record_id", "payload_size_bytes")
