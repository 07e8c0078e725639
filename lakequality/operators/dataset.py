"""Checks on a whole dataset: duplicates, freshness, volume, schema, completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequality.functions.checks import moment


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; counted before the shuffle, so a hot key stays small."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies"))
    return counted.filter("__copies > 1").withColumnRenamed("__copies", "n")


def flag_duplicates(df: DataFrame, keys: Sequence[str], name: str = "is_unique") -> DataFrame:
    """Every row with whether its key is unique.

    A window over the key would gather a hot key in one task. Joining the few repeated keys back
    broadcasts while they are small, and lets the adaptive skew join split hot keys otherwise.
    """
    repeated = duplicate_keys(df, keys).select(
        *(F.col(key).alias(f"__repeated_{key}") for key in keys), F.lit(True).alias("__repeated")
    )
    same = [F.col(key).eqNullSafe(F.col(f"__repeated_{key}")) for key in keys]
    joined = df.join(repeated, same, "left")
    return joined.withColumn(name, F.col("__repeated").isNull()).drop(*repeated.columns)


def no_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the number of repeated keys, and whether there are none."""
    groups = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("value"))
    return groups.select(
        F.lit("no_duplicates").alias("check"), "value", (F.col("value") == 0).alias("passed")
    )


def freshness(df: DataFrame, column: str, hours: int, as_of=None) -> DataFrame:
    """The newest row is at most `hours` old."""
    newest = F.max(column)
    limit = moment(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return df.agg(newest.alias("newest")).select(
        F.lit("freshness").alias("check"),
        "newest",
        F.coalesce(F.col("newest") >= limit, F.lit(False)).alias("passed"),
    )


def minimum_count(df: DataFrame, least: int) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("value")).select(
        F.lit("minimum_count").alias("check"), "value", (F.col("value") >= least).alias("passed")
    )


def schema_diff(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Every expected or present column: its types on both sides, its NULLs, and a verdict.

    Types are compared from the schemas; a column declared NOT NULL is checked on the data.
    """
    present = {field.name: field.dataType.simpleString() for field in df.schema}
    wanted = {field.name: field for field in expected}
    listed = [*wanted, *(name for name in present if name not in wanted)]
    nulls = df.agg(
        *(
            (F.count_if(F.col(name).isNull()) if name in present else F.lit(None).cast("bigint"))
            .alias(name)
            for name in listed
        )
    )

    def entry(name):
        field = wanted.get(name)
        type_wanted = field.dataType.simpleString() if field else None
        if name not in present:
            verdict = F.lit("missing")
        elif field is None:
            verdict = F.lit("unexpected")
        elif present[name] != type_wanted:
            verdict = F.lit("type differs")
        elif field.nullable:
            verdict = F.lit("ok")
        else:
            verdict = F.when(F.col(name) > 0, "has nulls").otherwise("ok")
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(type_wanted).cast("string").alias("expected_type"),
            F.lit(present.get(name)).cast("string").alias("actual_type"),
            F.col(name).alias("nulls"),
            verdict.alias("verdict"),
        )

    return nulls.select(F.inline(F.array(*map(entry, listed))))


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, filled rows, NULL rows and the filled share; one scan, one aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"), *(F.count(name).alias(f"n_{name}") for name in columns)
    )
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("column"), F.col(f"n_{name}").alias("filled"))
            for name in columns
        )
    )
    return counts.select("total", F.inline(entries)).select(
        "column",
        "total",
        "filled",
        (F.col("total") - F.col("filled")).alias("nulls"),
        F.try_divide("filled", "total").alias("share"),
    )


def validation_list(df: DataFrame, validations: Sequence[Mapping]) -> DataFrame:
    """Violations of declared checks (`not_null`, `positive`, `valid_values`), all in one scan."""

    def good(item) -> Column:
        column = F.col(item["column"])
        kinds = {
            "not_null": lambda: column.isNotNull(),
            "positive": lambda: column > 0,
            "valid_values": lambda: column.isin(list(item["values"])),
        }
        if item["check"] not in kinds:
            raise ValueError(f"unknown validation: {item['check']}")
        return F.coalesce(kinds[item["check"]](), F.lit(False))

    violations = [F.count_if(~good(item)).alias(f"v{i}") for i, item in enumerate(validations)]
    counts = df.agg(F.count(F.lit(1)).alias("total_records"), *violations)
    entries = F.array(
        *(
            F.struct(
                F.lit(item["column"]).alias("column"),
                F.lit(item["check"]).alias("check"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, item in enumerate(validations)
        )
    )
    return counts.select("total_records", F.inline(entries)).withColumn(
        "is_valid", F.col("violations") == 0
    )


def is_blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def bronze_validation(bronze: DataFrame, flag: str = "is_valid") -> DataFrame:
    """Long-form report: missing ids, empty payloads, and rows per validity and per date.

    One aggregate by (date, flag) feeds all four parts, so the table is read once.
    """
    cells = bronze.groupBy("ingestion_date", flag).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("record_id").isNull()).alias("null_ids"),
        F.count_if(is_blank("raw_payload")).alias("empty"),
    )

    def part(check, item, n):
        return F.struct(F.lit(check).alias("check"), item.alias("item"), F.col(n).alias("n"))

    parts = F.array(
        part("null_record_ids", F.lit(""), "null_ids"),
        part("empty_payloads", F.lit(""), "empty"),
        part("validity", F.coalesce(F.col(flag).cast("string"), F.lit("")), "n"),
        part("date", F.coalesce(F.col("ingestion_date").cast("string"), F.lit("")), "n"),
    )
    return cells.select(F.inline(parts)).groupBy("check", "item").agg(F.sum("n").alias("n"))


def sample_rows(df: DataFrame, size: int, key: str) -> DataFrame:
    """A Bernoulli sample of about `size` rows, and all rows when there are fewer.

    A row is drawn by the first 52 bits of the MD5 of its key, so the sample is the same for any
    partitioning. The share is a scalar subquery; nothing runs while the plan is built.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    draw = F.conv(F.substr(F.md5(F.col(key).cast("string")), F.lit(1), F.lit(13)), 16, 10).cast("double")
    return df.filter(draw < F.lit(float(size)) / total * F.lit(float(1 << 52)))
