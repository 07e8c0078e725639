"""Shared steps of the operators: the session, stored tables, and columns added by Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequality.session import materialize, prepare

# Rows of one Arrow batch; whole texts can be long, and a worker holds one batch at a time.
BATCH_ROWS = "512"
# Bits of the filter that `maybe_in` broadcasts, in at most 131072 rows.
FILTER_BITS = 1 << 23


def session(spark: SparkSession) -> SparkSession:
    prepare(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """A table in the shared folder, read back: lost executors cost no earlier work."""
    return materialize(df, f"llm-{label}")


def small(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A few rows that the driver holds as a table, without an RDD."""
    import json

    return spark.sql(
        f"SELECT inline(from_json(:rows, 'array<struct<{schema}>>'))", args={"rows": json.dumps(rows)}
    )


def col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns of `df` but those of the given names, which a result is about to use."""
    taken = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in taken]


def maybe_in(rows: DataFrame, hashed: Column, wanted: DataFrame) -> DataFrame:
    """Rows whose hash may be among the hashes of `wanted` (one column), in front of a join with it.

    Few whole texts travel to that join then. A table of at most FILTER_BITS / 64 rows of bits is
    broadcast. Where `wanted` is so large that all bits are set, every row passes; the join decides.
    A null hash never passes.
    """

    def place(h):
        bit = F.pmod(h, F.lit(FILTER_BITS))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))
        return F.shiftright(bit, 6), mask

    word, mask = place(col(wanted.columns[0]))
    marks = wanted.groupBy(word.alias("__filter_word")).agg(F.bit_or(mask).alias("__filter_bits"))
    word, mask = place(hashed)
    here = (word == F.col("__filter_word")) & (F.col("__filter_bits").bitwiseAND(mask) != 0)
    return rows.join(F.broadcast(marks), here, "left_semi")


def add_columns(
    df: DataFrame,
    schema: str,
    needs: Sequence[str],
    compute: Callable[..., Sequence[Sequence]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add columns that Python computes from the whole columns of an Arrow batch.

    `compute` takes the Arrow columns named in `needs` and returns one sequence for each field of
    `schema`. An input column of the same name as a new one is replaced. `keep` names the input
    columns to pass on, all by default.
    """
    import pyarrow as pa

    added = T._parse_datatype_string(schema)
    passed = [c for c in (df.columns if keep is None else keep)]
    passed = [c for c in passed if c.lower() not in {n.lower() for n in added.names}]
    read_in = list(dict.fromkeys([*passed, *needs]))
    source = df.select(*(col(c) for c in read_in))
    out = T.StructType([source.schema[c] for c in passed] + added.fields)

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in added.fields]
    names = added.names

    def batches(parts):
        for part in parts:
            made = compute(*(part.column(read_in.index(c)) for c in needs))
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, k) for v, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(read_in.index(c)) for c in passed] + arrays, names=[*passed, *names]
            )

    return source.mapInArrow(batches, out)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now; it does so when the driver collects."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


# Spark removes the shuffle files of a statement when it ends.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """A stored table that is removed as soon as nothing needs it, to keep the shared folder small.

    With `clean`, the shuffle files of its making go as soon as it is written.
    """

    def __init__(self, df: DataFrame, label: str, clean: bool = False):
        from lakequality.session import work_dir

        self.spark = df.sparkSession
        self.path = work_dir(self.spark, f"llm-{label}")
        before = self.spark.conf.get(_FILE_CLEANUP, None)
        if clean:
            self.spark.conf.set(_FILE_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(self.path)
        finally:
            if clean and before is None:
                self.spark.conf.unset(_FILE_CLEANUP)
            elif clean:
                self.spark.conf.set(_FILE_CLEANUP, before)
        self.rows = self.spark.read.schema(df.schema).parquet(self.path)

    def remove(self) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
