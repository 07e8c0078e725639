"""Column statistics of catalog tables, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the catalog tells of a column, by the names it is described with.
_FIELDS = {
    "data_type": "data_type",
    "min": "min_value",
    "max": "max_value",
    "num_nulls": "nulls",
    "distinct_count": "distinct_values",
    "avg_col_len": "mean_bytes",
    "max_col_len": "max_bytes",
}
_NUMBERS = ("nulls", "distinct_values", "mean_bytes", "max_bytes")


def column_statistics(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> DataFrame:
    """The statistics that `maintenance.analyze` left in the catalog: one row for each column.

    `min_value` and `max_value` are text, as the catalog holds them; `distinct_values` is an estimate.
    A column that was not analysed has nulls. Only descriptions are read, never the table.
    """
    found = None
    for name in columns or spark.table(table).columns:
        quoted = name.replace("`", "``")
        listed = spark.sql(f"DESCRIBE EXTENDED {table} `{quoted}`")
        told = {row["info_name"]: row["info_value"] for row in listed.collect()}
        values = [None if told.get(key) in (None, "NULL") else told[key] for key in _FIELDS]
        row = [(name, *values)]
        found = row if found is None else found + row
    schema = "column_name STRING, " + ", ".join(f"{name} STRING" for name in _FIELDS.values())
    return spark.createDataFrame(found or [], schema).withColumns({name: F.col(name).cast("bigint") for name in _NUMBERS})


def table_rows(spark: SparkSession, table: str) -> int | None:
    """The rows that the catalog knows of a table, or None before it was analysed."""
    for row in spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Statistics'").collect():
        for part in row["data_type"].split(","):
            if part.strip().endswith("rows"):
                return int(part.split()[0])
    return None


def stale_columns(spark: SparkSession, table: str, columns: Sequence[str], tolerance: float = 0.05) -> DataFrame:
    """Figures that no longer describe the table: `column_name`, `figure`, `known` and `actual`, as text.

    Least and greatest value and nulls must be exact, distinct values within `tolerance`, in one
    aggregate over the table. The catalog holds no least and greatest text. Columns listed here
    should be analysed again, those that never were are listed with all they lack.
    """
    df = spark.table(table)
    entries = []
    for row in column_statistics(spark, table, columns).collect():
        column, kind = F.col(f"`{row.column_name}`"), df.schema[row.column_name].dataType
        ends = [("min", row.min_value, F.min(column)), ("max", row.max_value, F.max(column))]
        if isinstance(kind, (T.StringType, T.BinaryType)):
            ends = []
        figures = [(name, known, F.lit(known).cast(kind), actual, None) for name, known, actual in ends]
        figures.append(("nulls", row.nulls, F.lit(row.nulls), F.count_if(column.isNull()), None))
        figures.append(("distinct", row.distinct_values, F.lit(row.distinct_values), F.approx_count_distinct(column, tolerance / 5), tolerance))
        for name, known, value, actual, slack in figures:
            same = value.eqNullSafe(actual) if slack is None else F.coalesce(F.abs(value - actual) <= slack * actual, F.lit(False))
            entries.append(
                F.struct(
                    F.lit(row.column_name).alias("column_name"), F.lit(name).alias("figure"),
                    F.lit(None if known is None else str(known)).cast("string").alias("known"),
                    actual.cast("string").alias("actual"), same.alias("same"),
                )
            )
    listed = df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))
    return listed.filter(~F.col("same")).drop("same")
