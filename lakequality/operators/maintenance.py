"""Table upkeep: creation, partitions, statistics, retention and compaction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequality.operators.quality import PASS


DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def create_table(
    spark: SparkSession,
    table: str,
    ddl: str,
    *,
    partitions: Sequence[str] = (),
    path: str | None = None,
    format: str = "parquet",
    properties: Mapping[str, str] | None = None,
    comment: str | None = None,
) -> None:
    """Create a table from schema text, external when a path is given."""
    text = f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING {format}"
    if partitions:
        text += f" PARTITIONED BY ({', '.join(partitions)})"
    if path:
        text += f" LOCATION '{path}'"
    if comment:
        text += f" COMMENT '{comment}'"
    if properties:
        listed = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
        text += f" TBLPROPERTIES ({listed})"
    spark.sql(text)


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """The partitions of a table, one column per partition key.

    Values are decoded from their folder names; the default partition is null.
    """
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    keys = _partition_keys(spark, table)
    pairs = F.str_to_map("partition", F.lit("/"), F.lit("="))
    # Folder names escape as %XX alone, so a plus is a plus.
    value = {key: F.url_decode(F.replace(pairs[key], F.lit("+"), F.lit("%2B"))) for key in keys}
    return listed.select(
        "partition",
        *(F.when(pairs[key] != DEFAULT_PARTITION, value[key]).alias(key) for key in keys),
    )


def _partition_keys(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def repair(spark: SparkSession, table: str) -> int:
    """Register folders that the catalog does not know; returns how many were added."""
    before = spark.sql(f"SHOW PARTITIONS {table}").count()
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.sql(f"SHOW PARTITIONS {table}").count() - before


def _quoted(value: object) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _spec(values: Mapping[str, object]) -> str:
    return ", ".join(f"`{key}` = {_quoted(value)}" for key, value in values.items())


def add_partition(
    spark: SparkSession, table: str, values: Mapping[str, object], location: str | None = None
) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_spec(values)}){where}")


def drop_partitions(
    spark: SparkSession, table: str, specs: Sequence[Mapping[str, object]]
) -> None:
    """Drop partitions in one statement; a managed table loses their files too.

    A partition that is not there is an error, so a wrong name can't pass for a drop.
    """
    if specs:
        listed = ", ".join(f"PARTITION ({_spec(values)})" for values in specs)
        spark.sql(f"ALTER TABLE {table} DROP {listed}")


def analyze(
    spark: SparkSession, table: str, columns: Sequence[str] = (), max_error: float | None = None
) -> None:
    """Table and column statistics for the cost-based optimiser.

    `max_error` is the relative error allowed for distinct values; the session's setting is kept.
    """
    scope = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    name = "spark.sql.statistics.ndv.maxError"
    before = spark.conf.get(name)
    try:
        if max_error is not None:
            spark.conf.set(name, str(max_error))
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {scope}")
    finally:
        spark.conf.set(name, before)
    spark.catalog.refreshTable(table)


def table_statistics(df: DataFrame, partition_columns: Sequence[str], time: str) -> DataFrame:
    """Per partition: rows, rows that passed, mean score, newest `time`; one aggregate."""
    return df.groupBy(*partition_columns).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("quality_flag") == PASS).alias("pass_records"),
        F.avg("quality_score").alias("avg_score"),
        F.max(time).alias("newest"),
    )


def recent_partitions(df: DataFrame, partition_columns: Sequence[str], n: int = 10) -> DataFrame:
    """Rows of the newest n partitions."""
    counted = df.groupBy(*partition_columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(*(F.desc(name) for name in partition_columns)).limit(n)


def files(df: DataFrame, *by: str) -> DataFrame:
    """Rows and bytes of every data file, found by the tasks that read them."""
    path, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
    return (
        df.select(path.alias("file"), size.alias("bytes"), *by)
        .groupBy("file", *by)
        .agg(F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    )


def storage_stats(df: DataFrame, *by: str) -> DataFrame:
    """Files, bytes and rows, in all or per partition column."""
    listed = files(df, *by)
    grouped = listed.groupBy(*by) if by else listed
    return grouped.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum("n").alias("n"),
    )


def cutoff(as_of: Column, days: int) -> Column:
    return F.date_sub(as_of, days)


def retention_candidates(df: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    """Partition values older than `days` days, with their rows; only those folders are read."""
    return (
        df.filter(F.col(column) < cutoff(as_of, days))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def expire(spark: SparkSession, table: str, column: str, as_of: str, days: int) -> DataFrame:
    """Drop the partitions older than `days` days; returns them with files, bytes and rows.

    Files are counted before the drop, and the report holds those partitions that are gone after it.
    Only partition names reach the driver.
    """
    limit = cutoff(F.lit(as_of).cast("date"), days)
    keys = _partition_keys(spark, table)
    old = partitions(spark, table).filter(F.col(column).cast("date") < limit)
    specs = [row.asDict() for row in old.select(*keys).collect()]
    doomed = spark.table(table).filter(F.col(column) < limit)
    report = storage_stats(doomed, column).collect()
    drop_partitions(spark, table, specs)
    spark.catalog.refreshTable(table)
    left = {str(row[column]) for row in partitions(spark, table).select(column).distinct().collect()}
    gone = [row for row in report if str(row[column]) not in left]
    return spark.createDataFrame(gone, f"{column} DATE, files BIGINT, bytes BIGINT, n BIGINT")


def compact(
    df: DataFrame,
    path: str,
    *,
    partitions: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    max_records_per_file: int = 5_000_000,
) -> None:
    """Write a compacted version of a table to a new folder, in few, sorted files.

    Rows are range-partitioned by partition and cluster columns, so a hot partition is cut into
    ranges, and each file covers a narrow range for min/max skipping. The order also serves the
    partitioned write, so there is one shuffle and one sort. Readers switch with `repoint`.
    """
    keys = [*partitions, *cluster_by]
    if not keys:
        raise ValueError("compaction needs partition or cluster columns")
    writer = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", max_records_per_file)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


def repoint(
    spark: SparkSession,
    table: str,
    path: str,
    only: Sequence[Mapping[str, object]] | None = None,
    checked: bool = True,
) -> None:
    """Make a table, or partitions of it, read from a new version folder.

    Of a partitioned table only partitions that the new version holds are switched, or those of `only`, which it must hold.
    Their rows are counted in both versions first; where the counts differ, nothing is switched and
    ValueError is raised. `checked=False` leaves the count out, for versions that differ on purpose.
    """
    keys = _partition_keys(spark, table)
    if not keys:  # a table without partitions has one version, named by the caller
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(path)}")
        spark.catalog.refreshTable(table)
        return
    new = spark.read.schema(spark.table(table).schema).parquet(path)
    old_counts = _counts(spark.table(table), keys)
    new_counts = _counts(new, keys)
    wanted = set(new_counts)
    if only is not None:
        wanted = {tuple(None if v[key] is None else str(v[key]) for key in keys) for v in only}
    names = {tuple(row[key] for key in keys): row["partition"] for row in partitions(spark, table).collect()}
    wrong = [w for w in wanted if w not in new_counts or checked and old_counts.get(w) != new_counts[w]]
    wrong += [w for w in wanted if w not in names]
    if wrong:
        raise ValueError(f"the new version does not hold the same rows: {sorted(map(str, wrong))[:5]}")
    for values in sorted(wanted, key=str):
        where = f"PARTITION ({_spec(dict(zip(keys, values, strict=True)))})"
        spark.sql(f"ALTER TABLE {table} {where} SET LOCATION {_quoted(path + '/' + names[values])}")
    spark.catalog.refreshTable(table)


def _counts(df: DataFrame, keys: Sequence[str]) -> dict[tuple, int]:
    """Rows by partition; one number for each partition reaches the driver."""
    grouped = df.groupBy(*(F.col(key).cast("string").alias(key) for key in keys)).agg(F.count(F.lit(1)).alias("__n"))
    return {tuple(row[key] for key in keys): row["__n"] for row in grouped.collect()}
