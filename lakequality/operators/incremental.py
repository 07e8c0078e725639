"""Incremental loading: what is new, what is latest, what replaces what."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakequality.session import materialize


def unprocessed(bronze: DataFrame, silver: DataFrame, key: str) -> DataFrame:
    """Bronze rows whose key is not in Silver yet: an anti join, no list of ids on the driver."""
    return bronze.join(silver.select(key), key, "left_anti")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, first by `order`.

    With the filter on the row number Spark keeps one row per key and map task before the shuffle,
    so a hot key sends only as many rows as there are tasks.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(newest_first))
    return ranked.filter("__rank = 1").drop("__rank")


def newest(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """The latest row per key; the other columns break ties, so every run picks the same row."""
    rest = [name for name in df.columns if name not in (*keys, time)]
    return latest_per_key(df, keys, [F.desc(time), *(F.desc_nulls_last(name) for name in rest)])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], time: str | None = None
) -> DataFrame:
    """Rows of `source` replace target rows of the same key; new keys are added.

    Repeated source keys are settled first, by `time`. The target is only anti-joined with the
    source keys: while the changes are small they are broadcast and the target is not shuffled.
    The changes are read twice, for their keys and for their rows; store them first if that is dear.
    """
    if time is not None:
        source = newest(source, keys, time)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def union_all(frames: Sequence[DataFrame], *, by_name: bool = True) -> DataFrame:
    return reduce(
        lambda left, right: left.unionByName(right) if by_name else left.union(right), frames
    )


def paged(df: DataFrame, order: Sequence[str], page_size: int) -> DataFrame:
    """Every row with its position and page in the order of `order`, which must be unique.

    LIMIT and OFFSET per page would sort the table once per page. Here it is range-partitioned
    and sorted once; each row carries its part and its number in it, and is shifted by the rows of
    the parts before. The ranges are drawn from a sample, so the parts are written down first.
    """
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()  # the part in the upper bits, the row below them
    in_part = F.lit((1 << 33) - 1)
    ranged = materialize(
        parts.withColumn("__row", row)
        .withColumn("__part", F.shiftright("__row", 33))
        .withColumn("__row_in_part", F.col("__row").bitwiseAND(in_part) + 1)
        .drop("__row"),
        "pages",
    )
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows_in_part"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("__part").alias("__part_id"),
        F.coalesce(F.sum("__rows_in_part").over(before), F.lit(0)).alias("__rows_before"),
    )
    return (
        ranged.join(offsets, F.col("__part") == F.col("__part_id"))
        .withColumn("position", F.col("__rows_before") + F.col("__row_in_part"))
        .withColumn("page", F.floor((F.col("position") - 1) / page_size))
        .drop("__part", "__part_id", "__row_in_part", "__rows_before")
    )
