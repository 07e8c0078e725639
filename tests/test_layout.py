"""Clustering on several columns, and removal of versions that nothing reads."""

import datetime
import itertools
import os
import uuid

import pytest
from pyspark.sql import functions as F

from lakequality.operators import layout, maintenance, sinks, statistics, versions
from lakequality.session import work_dir


def test_interleaved_bits(spark):
    pairs = list(itertools.product(range(8), repeat=2))
    df = spark.createDataFrame(pairs, "a int, b int")
    key = layout.interleave([F.col("a"), F.col("b")], 3)
    got = {(r.a, r.b): r.k for r in df.select("a", "b", key.alias("k")).collect()}
    for a, b in pairs:
        assert got[a, b] == int("".join(x + y for x, y in zip(f"{a:03b}", f"{b:03b}", strict=True)), 2)
    with pytest.raises(ValueError, match="63 bits"):
        layout.interleave([F.col("a")] * 8, 8)


def test_range_index_counts_bounds(spark):
    bounds = [3, 3, 5, 8, 13, 21, 34]
    values = [(None,), *((v,) for v in range(-1, 40))]
    df = spark.createDataFrame(values, "v int").select("v", layout.range_index(F.col("v"), bounds).alias("k"))
    assert all(r.k == sum(b <= r.v for b in bounds) if r.v is not None else r.k == 0 for r in df.collect())


def test_zorder_narrows_files_in_every_column(spark):
    rows = spark.range(20000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).cast("double")).alias("b"),
        F.expr("CASE WHEN id % 50 <> 0 THEN date_add(DATE '2024-01-01', CAST(pmod(xxhash64(id, 2), 365) AS INT)) END").alias("c"),
        F.concat(F.lit("é"), F.pmod(F.xxhash64("id", F.lit(3)), F.lit(97)).cast("string")).alias("d"),
        (F.col("id") % 2 == 0).alias("zorder_"),
        F.col("id"),
    )
    path, plain = work_dir(spark, "z"), work_dir(spark, "sorted")
    layout.zorder(rows, path, ["a", "b", "c"], files=64)
    written = spark.read.parquet(path)
    assert written.columns == rows.columns and written.exceptAll(rows).count() == 0 and rows.exceptAll(written).count() == 0
    asked = {"a": (0, 99), "b": (400.0, 450.0), "c": (datetime.date(2024, 3, 1), datetime.date(2024, 3, 31))}
    read = {r.column_name: r.read_files / r.files for r in layout.files_to_read(written, asked).collect()}
    assert all(share < 0.5 for share in read.values()), read
    # The lexicographic order narrows the first column only.
    rows.repartitionByRange(64, "a", "b", "c").sortWithinPartitions("a", "b", "c").write.parquet(plain)
    read = {r.column_name: r.read_files / r.files for r in layout.files_to_read(spark.read.parquet(plain), asked).collect()}
    assert read["a"] < 0.5 and read["c"] > 0.9
    # Texts, times and partitions; an empty table.
    both = rows.withColumn("t", F.timestamp_micros(F.col("id") * 1000000)).withColumn("p", F.col("id") % 3)
    split = work_dir(spark, "z-parts")
    layout.zorder(both, split, ["d", "t", "zorder_"], partitions=["p"], files=12, max_records_per_file=500)
    again = spark.read.parquet(split)
    assert again.count() == 20000 and layout.file_ranges(again, ["d"]).agg(F.max("n")).first()[0] <= 500
    layout.zorder(rows.limit(0), work_dir(spark, "z-none"), ["a", "d"])
    with pytest.raises(ValueError, match="no order"):
        layout.zorder_key(spark.createDataFrame([([1],)], "x array<int>"), ["x"])


def test_vacuum_takes_only_what_nothing_reads(spark):
    name = f"vacuum_{uuid.uuid4().hex}"
    root = work_dir(spark, name)
    rows = spark.range(100).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("a b:%"), (F.col("id") % 3).cast("string"))).alias("site"))
    sinks.save_table(rows, name, mode="overwrite", partitions=["site"], path=f"{root}/v0")
    other, flat = f"{name}_other", f"{name}_flat"
    sinks.save_table(rows.select("id"), other, mode="overwrite", path=f"{root}/other")
    rows.select("id").write.parquet(f"{root}/flat-old")
    rows.select("id").write.parquet(f"{root}/flat-new")
    spark.sql(f"CREATE TABLE {flat} (id BIGINT) USING parquet LOCATION '{root}/flat-old'")
    maintenance.repoint(spark, flat, f"{root}/flat-new")
    maintenance.compact(rows, f"{root}/v1", partitions=["site"], cluster_by=["id"])
    maintenance.repoint(spark, name, f"{root}/v1", only=[{"site": "a b:%1"}, {"site": None}])
    tables = [name, other, flat]
    early, late = datetime.datetime(2000, 1, 1), datetime.datetime.now() + datetime.timedelta(days=1)
    # Nothing is older than a limit far back.
    assert versions.vacuum(spark, tables, root, early).count() == 0
    free = {r.folder[len(versions_root(spark, root)) + 1 :] for r in versions.unreferenced(spark, tables, root).collect()}
    assert len(free) == 4 and {f.split("/")[0] for f in free} == {"v0", "v1", "flat-old"}
    gone = versions.vacuum(spark, tables, root, late)
    assert gone.count() == 4 and gone.agg(F.sum("files")).first()[0] >= 4
    assert spark.table(name).exceptAll(rows).count() == 0 and spark.table(name).count() == 100
    assert spark.table(other).count() == spark.table(flat).count() == 100
    held = {r.file for r in versions.stored_files(spark, root).collect()}
    read = set()
    for table in tables:
        paths = spark.table(table).select(versions._plain(F.col("_metadata.file_path")).alias("f")).distinct()
        read |= {r.f for r in paths.collect()}
    assert read <= held and all(f.rsplit("/", 1)[0] in {r.rsplit("/", 1)[0] for r in read} for f in held)
    # Emptied version folders go as well, and a second run finds nothing.
    assert not os.path.exists(f"{root}/flat-old") and sorted(os.listdir(root)) == ["flat-new", "other", "v0", "v1"]
    assert versions.vacuum(spark, tables, root, late).count() == 0
    for table in tables:
        spark.sql(f"DROP TABLE {table}")


def versions_root(spark, root):
    return spark.createDataFrame([("file:" + root if root.startswith("/") else root,)], "p string").select(versions._plain(F.col("p"))).first()[0]


def test_column_statistics_are_read_back_and_change_a_join(spark):
    name = f"stat_{uuid.uuid4().hex}"
    small, large = f"{name}_small", f"{name}_large"
    rows = spark.range(40000).select(
        "id", F.when(F.col("id") % 4 > 0, F.col("id") % 100).alias("part"), F.repeat(F.lit("x"), 200).alias("filler"),
        F.expr("date_add(DATE '2024-01-01', CAST(id % 300 AS INT))").alias("day"),
    )
    for table in (small, large):
        sinks.save_table(rows, table, mode="overwrite", path=work_dir(spark, table))
    assert statistics.table_rows(spark, small) is None
    assert all(r.min_value is None and r.nulls is None for r in statistics.column_statistics(spark, small).collect())
    assert {r.figure for r in statistics.stale_columns(spark, small, ["part"]).collect()} == {"min", "max", "nulls", "distinct"}

    def plan():
        joined = spark.table(small).filter("id < 40").join(spark.table(large), "id")
        return joined._jdf.queryExecution().sparkPlan().toString()

    settings = {"spark.sql.cbo.enabled": "true", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "64k"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert "SortMergeJoin" in plan()
        for table in (small, large):
            maintenance.analyze(spark, table, max_error=0.01)
        assert "BroadcastHashJoin" in plan()  # forty rows are expected now
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    known = {r.column_name: r for r in statistics.column_statistics(spark, small).collect()}
    assert (known["id"].min_value, known["id"].max_value, known["part"].nulls) == ("0", "39999", 10000)
    assert (known["day"].min_value, known["day"].max_value) == ("2024-01-01", "2024-10-26")
    assert abs(known["id"].distinct_values - 40000) <= 2000 and known["filler"].max_bytes == 200
    assert statistics.table_rows(spark, small) == 40000
    assert statistics.stale_columns(spark, small, ["id", "part", "day", "filler"]).count() == 0
    # Rows that another writer adds to the folder; Spark's own writes drop the statistics.
    late = spark.range(50000, 50010).select("id", F.lit(None).cast("bigint").alias("part"), F.lit("y").alias("filler"), F.lit("2023-01-01").cast("date").alias("day"))
    late.write.mode("append").parquet(versions.locations(spark, small)[0])
    spark.catalog.refreshTable(small)
    late = {(r.column_name, r.figure): (r.known, r.actual) for r in statistics.stale_columns(spark, small, ["id", "part", "day"]).collect()}
    assert late == {("id", "max"): ("39999", "50009"), ("part", "nulls"): ("10000", "10010"), ("day", "min"): ("2024-01-01", "2023-01-01")}
    for table in (small, large):
        spark.sql(f"DROP TABLE {table}")
