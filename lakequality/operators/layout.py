"""Clustering on several columns at once: rows in the order of interleaved bits of their ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequality.operators.quality import free_name

# Ranges of each column are 2**BITS; all columns together have at most 63 bits.
BITS = 8
# Leading characters of a text that its rank looks at.
_TEXT_BYTES = 7


def _number(df: DataFrame, name: str) -> Column:
    """A number in the order of a column's values, which quantiles can be taken of."""
    column, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return column
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return column.cast("int")
    if isinstance(kind, T.StringType):
        head = F.substring(F.encode(column, "UTF-8"), 1, _TEXT_BYTES)
        return F.conv(F.rpad(F.hex(head), 2 * _TEXT_BYTES, "0"), 16, 10).cast("bigint")
    raise ValueError(f"column {name} of type {kind.simpleString()} has no order to cluster by")


def range_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Quantiles that cut each column into 2**bits ranges of like many rows, in one aggregate.

    Quantiles follow the data, so a skewed column is cut finely where its rows are.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    row = df.agg(*(F.percentile_approx(_number(df, name), shares).alias(name) for name in columns)).first()
    return {name: list(row[name] or []) for name in columns}


def range_index(value: Column, bounds: Sequence) -> Column:
    """How many of the ascending bounds are at or below a value, found by halving; 0 for null."""
    if not bounds:
        return F.lit(0)
    held = F.array(*(F.lit(bound) for bound in bounds))
    steps = [1 << k for k in range((len(bounds) + 1).bit_length() - 2, -1, -1)]

    def halve(at, step):
        return F.when(value >= F.element_at(held, at + step), at + step).otherwise(at)

    return F.aggregate(F.array(*(F.lit(step) for step in steps)), F.lit(0), halve)


def interleave(indexes: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of several numbers in turns, highest first, as one BIGINT."""
    n = len(indexes)
    if n * bits > 63:
        raise ValueError(f"{n} columns of {bits} bits do not fit in 63 bits")
    parts = [
        F.shiftleft(F.shiftright(index, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * n + n - 1 - k)
        for k, index in enumerate(indexes)
        for bit in range(bits)
    ]
    return reduce(lambda left, right: left + right, parts)


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Where a row lies on the curve through the ranges of all columns; near rows are near in each.

    Nulls lie in the first range. The quantiles are computed once, on the whole table.
    """
    if not columns:
        raise ValueError("clustering needs columns")
    bounds = range_bounds(df, columns, bits)
    return interleave([range_index(_number(df, name), bounds[name]) for name in columns], bits)


def zorder(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    *,
    partitions: Sequence[str] = (),
    files: int | None = None,
    bits: int = BITS,
    max_records_per_file: int = 5_000_000,
) -> None:
    """Write a version of a table in which files are narrow in every one of the columns.

    A sort by several columns narrows files in the first of them alone. Here rows are
    range-partitioned by their place on the curve (one shuffle, one sort), so a hot partition or
    value is cut into ranges of like size. `files` sets how many ranges there are at least. Readers
    switch with `maintenance.repoint`.
    """
    key = free_name("zorder_", df.columns)
    keyed = df.withColumn(key, zorder_key(df, columns, bits))
    order = [*partitions, key]
    ranged = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    writer = (
        ranged.sortWithinPartitions(*order)
        .drop(key)
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", max_records_per_file)
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per data file: rows, and least and greatest value of each column."""
    return (
        df.select(F.col("_metadata.file_path").alias("file"), *(F.col(f"`{name}`") for name in columns))
        .groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *(F.min(f"`{name}`").alias(f"min_{name}") for name in columns),
            *(F.max(f"`{name}`").alias(f"max_{name}") for name in columns),
        )
    )


def files_to_read(df: DataFrame, ranges: Mapping[str, tuple[object, object]]) -> DataFrame:
    """Per column: all files, and those whose values meet the range asked for, which no reader can skip."""
    listed = file_ranges(df, list(ranges))
    counts = listed.agg(
        F.count(F.lit(1)).alias("files"),
        *(
            F.count_if((F.col(f"min_{name}") <= F.lit(high)) & (F.col(f"max_{name}") >= F.lit(low))).alias(f"read_{name}")
            for name, (low, high) in ranges.items()
        ),
    )
    rows = F.array(
        *(F.struct(F.lit(name).alias("column_name"), "files", F.col(f"read_{name}").alias("read_files")) for name in ranges)
    )
    return counts.select(F.inline(rows))
