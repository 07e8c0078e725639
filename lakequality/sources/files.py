"""Files and tables, batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_path(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    return spark.read.format(format).options(**options).load(path)


def read_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL text as a source; `{name}` stands for the DataFrame given under that name."""
    return spark.sql(text, **tables)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    format: str = "parquet",
    *,
    max_files: int | None = None,
    max_bytes: str | int | None = None,
    **options,
) -> DataFrame:
    """A folder as a stream: explicit schema, bounded batches, oldest files first.

    A batch takes at most `max_files` new files, or files up to `max_bytes` (as `64m`) in all, and one
    file at least. The two bounds exclude each other.
    """
    reader = spark.readStream.format(format).schema(schema).options(**options)
    return _bounded(reader, max_files, max_bytes).load(path)


def _bounded(reader, max_files: int | None, max_bytes: str | int | None):
    if max_files and max_bytes:
        raise ValueError("bound batches by files or by bytes, not both")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader


def stream_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    max_files: int | None = None,
    max_bytes: str | int | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """One JSON document per file, of one or many lines; a file may hold an array of records.

    With `corrupt`, a document that is no JSON or does not fit the schema comes as one row with its
    text in that column and what could be read in the others. Without it such rows are all null.
    """
    options = {"multiLine": True}
    if corrupt:
        given = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*given.fields, T.StructField(corrupt, T.StringType())])
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    return stream_files(spark, path, schema, "json", max_files=max_files, max_bytes=max_bytes, **options)


def stream_table(
    spark: SparkSession, table: str, *, max_files: int | None = None, max_bytes: str | int | None = None
) -> DataFrame:
    return _bounded(spark.readStream, max_files, max_bytes).table(table)


def bronze_range(
    bronze: DataFrame, start: str | None = None, end: str | None = None, hours: Sequence[int] = ()
) -> DataFrame:
    """Bronze rows of a range of dates and a list of hours.

    Both are partition columns and compared with typed literals, so only those folders are listed
    and read.
    """
    date, hour = F.col("ingestion_date"), F.col("ingestion_hour")
    if start is not None:
        bronze = bronze.filter(date >= F.lit(start).cast("date"))
    if end is not None:
        bronze = bronze.filter(date <= F.lit(end).cast("date"))
    if hours:
        bronze = bronze.filter(hour.isin(list(hours)))
    return bronze
