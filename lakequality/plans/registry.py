"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequality.session import COMPRESSION, prepare, work_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without `sql` only its rows can be checked."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presentable(build(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register


_STORED: dict[tuple[str, str, str], str] = {}


def stored(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    build: Callable[[], DataFrame],
    partitions: Sequence[str] = (),
) -> DataFrame:
    """A table in the shared folder that several queries read; written once per session."""
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _STORED:
        path = work_dir(spark, label)
        build().write.partitionBy(*partitions).parquet(path, compression=COMPRESSION)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def presentable(df: DataFrame) -> DataFrame:
    """Types that compare across engines: plain timestamps, doubles, and joined arrays."""

    def shown(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.TimestampType):
            return column.cast("timestamp_ntz")
        if isinstance(kind, T.DecimalType):
            return F.round(column.cast("double"), 6)
        if isinstance(kind, T.DoubleType):
            return F.round(column, 6)
        if isinstance(kind, T.ArrayType):
            return F.array_join(column, "; ")
        if isinstance(kind, T.MapType):
            pair = F.transform(
                F.array_sort(F.map_entries(column)),
                lambda item: F.concat_ws("=", item["key"], item["value"].cast("string")),
            )
            return F.array_join(pair, "; ")
        return column

    return df.select(*(shown(field).alias(field.name) for field in df.schema))
