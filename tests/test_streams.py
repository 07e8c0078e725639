"""Streams: same rows as in batch, exact restarts, harmless replays."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from lakequality import schemas, work_dir
from lakequality.operators import packs, quality, silver
from lakequality.sources import files
from lakequality.sources import log as log_source
from lakequality.streaming import progress, streams

from .test_silver import READING, bronze_rows

NOW = "available now"
ORDER = (
    "order_id STRING, product_id STRING, quantity INT, unit_price DOUBLE, total_amount DOUBLE, "
    "customer_id STRING, test_batch_id STRING"
)


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    return path


def put(folder, batch, numbers):
    for i in numbers:
        price, quantity = 29.99 + i, 5 + i % 10
        order = {
            "order_id": f"ORD-{i}",
            "product_id": f"PRD{i}",
            "quantity": quantity,
            "unit_price": price,
            "total_amount": price * quantity,
            "customer_id": f"CUST-CKPT-{i % 5}",
            "test_batch_id": batch,
        }
        (folder / f"{batch}-{i}.json").write_text(json.dumps(order, indent=1))


def source(spark, folder, max_files=None):
    return files.stream_json(spark, str(folder), ORDER, max_files=max_files)


def append(spark, folder, out, checkpoint, **options):
    query = streams.append_stream(
        source(spark, folder, options.pop("max_files", None)), checkpoint, path=out, interval=NOW, **options
    )
    query.awaitTermination()
    return query


def test_restart_loses_and_repeats_nothing(spark, folder):
    out, checkpoint = work_dir(spark, "t-out"), work_dir(spark, "t-cp")
    put(folder, "batch_1", range(5))
    append(spark, folder, out, checkpoint)
    assert spark.read.parquet(out).count() == 5
    put(folder, "batch_2", range(5, 8))
    append(spark, folder, out, checkpoint)
    append(spark, folder, out, checkpoint)
    found = spark.read.parquet(out)
    assert found.count() == 8 and found.select("order_id").distinct().count() == 8
    assert {(r["test_batch_id"], r["count"]) for r in found.groupBy("test_batch_id").count().collect()} == {
        ("batch_1", 5),
        ("batch_2", 3),
    }


def test_rate_limit_and_progress(spark, folder):
    put(folder, "b", range(6))
    query = append(spark, folder, work_dir(spark, "t-out"), work_dir(spark, "t-cp"), max_files=2)
    rows = progress.progress_rows(spark, query).filter("input_rows > 0").orderBy("batch_id").collect()
    assert [row["input_rows"] for row in rows] == [2, 2, 2]
    assert all(row["batch_duration_ms"] > 0 and row["processed_rows_per_second"] > 0 for row in rows)
    assert progress.progress_rows(spark, query, last=1).count() == 1


def test_progress_is_pushed(spark, folder):
    put(folder, "b", range(4))
    seen = []
    listener = progress.ProgressListener(seen.append)
    spark.streams.addListener(listener)
    try:
        append(spark, folder, work_dir(spark, "t-out"), work_dir(spark, "t-cp"), max_files=2)
        deadline = time.time() + 20
        while sum(row["input_rows"] for row in seen) < 4 and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert [row["input_rows"] for row in seen if row["input_rows"]] == [2, 2]


def test_state_survives_a_restart(spark, folder):
    out, checkpoint = work_dir(spark, "t-out"), work_dir(spark, "t-cp")

    def run():
        counts = streams.running_counts(source(spark, folder), "customer_id")
        streams.changelog(counts, out, checkpoint, interval=NOW).awaitTermination()
        changes = spark.read.parquet(out)
        return {
            r["customer_id"]: r["n"]
            for r in changes.groupBy("customer_id").agg(F.max_by("n", "batch_id").alias("n")).collect()
        }

    put(folder, "one", range(4))
    before = run()
    put(folder, "two", range(4, 7))
    after = run()
    assert all(after[key] >= n for key, n in before.items())
    batch = spark.read.schema(ORDER).option("multiLine", True).json(str(folder))
    assert after == {r["customer_id"]: r["count"] for r in batch.groupBy("customer_id").count().collect()}


def test_memory_sink_shows_updates(spark, folder):
    put(folder, "one", range(7))
    counts = streams.running_counts(source(spark, folder), "customer_id")
    query = (
        counts.writeStream.format("memory").queryName("t_counts").outputMode("update").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("t_counts").agg(F.sum("n")).first()[0] == 7


def test_bad_checkpoint_is_reported_and_nothing_is_lost(spark, folder, tmp_path):
    put(folder, "one", range(3))
    checkpoint = tmp_path / "cp"
    (checkpoint / "offsets").mkdir(parents=True)
    (checkpoint / "offsets" / "0").write_text("not an offset log")
    out = work_dir(spark, "t-out")
    with pytest.raises(Exception):
        append(spark, folder, out, str(checkpoint))
    append(spark, folder, out, work_dir(spark, "t-cp"))
    assert spark.read.parquet(out).count() == 3


def test_stray_file_in_checkpoint_is_harmless(spark, folder, tmp_path):
    put(folder, "one", range(3))
    checkpoint = tmp_path / "cp"
    checkpoint.mkdir()
    (checkpoint / "stray.txt").write_text("x")
    out = work_dir(spark, "t-out")
    append(spark, folder, out, str(checkpoint))
    assert spark.read.parquet(out).count() == 3


def test_silver_stream_equals_batch(spark):
    bronze = bronze_rows(spark, READING, '{"city":"Oslo"}', "{broken", '{"event_id":"e","city":"X","temperature":99}')
    path = work_dir(spark, "t-bronze")
    bronze.repartition(3).write.parquet(path)
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    rules = packs.weather_rules("2024-02-01 00:00:00")
    stream = files.stream_files(spark, path, bronze.schema, max_files=1)
    out = work_dir(spark, "t-silver")
    query = streams.append_stream(
        streams.weather_to_silver(stream, rules, at=at),
        work_dir(spark, "t-cp"),
        path=out,
        partitions=schemas.SILVER_PARTITIONS,
        interval=NOW,
    )
    query.awaitTermination()
    batch = streams.weather_to_silver(bronze, rules, at=at)
    assert batch.columns == schemas.names(schemas.SILVER_WEATHER_QUALITY)
    written = spark.read.parquet(out).select(*batch.columns)
    assert sorted(map(str, written.collect())) == sorted(map(str, batch.collect()))
    assert len(query.recentProgress) >= 3


def test_replayed_batch_replaces_itself(spark):
    path = work_dir(spark, "t-batches")
    batch = spark.createDataFrame([(1, "false"), (2, "true")], "n INT, is_valid STRING")
    flagged = F.col("is_valid") == "false"
    for _ in range(2):
        counts = streams.write_batch(batch, 7, path, quality_issues=flagged)
        assert counts == {"n": 2, "quality_issues": 1}
    streams.write_batch(batch, 8, path)
    written = spark.read.parquet(path)
    assert written.count() == 4 and {r["batch_id"] for r in written.collect()} == {7, 8}


def test_bronze_batches_keep_metrics(spark):
    log = spark.createDataFrame(
        [
            (None, bytearray(f'{{"order_id":"o{i}","is_valid":{"false" if i % 2 else "true"}}}', "utf-8"), 0, i, None)
            for i in range(6)
        ],
        schemas.LOG,
    )
    path = work_dir(spark, "t-log")
    log.repartition(3).write.parquet(path)
    stream = files.stream_files(spark, path, log.schema, max_files=1)
    from lakequality.operators.bronze import to_order_bronze

    out, metrics = work_dir(spark, "t-bronze"), work_dir(spark, "t-metrics")
    streams.bronze_batches(
        to_order_bronze(stream), out, metrics, work_dir(spark, "t-cp"), interval=NOW
    ).awaitTermination()
    totals = spark.read.parquet(metrics).agg(F.sum("n"), F.sum("quality_issues")).first()
    assert tuple(totals) == (6, 3)
    assert spark.read.parquet(out).select("order_id").distinct().count() == 6


def test_validated_batches_have_a_stable_lineage(spark):
    data = spark.createDataFrame([(1,), (-1,)], "quantity INT")
    path = work_dir(spark, "t-in")
    data.coalesce(1).write.parquet(path)
    from lakequality.operators.rules import Rule, RuleSet

    rules = RuleSet((Rule("positive", "quantity > 0"),))
    out = work_dir(spark, "t-out")
    streams.validated_batches(
        files.stream_files(spark, path, data.schema), rules, out, work_dir(spark, "t-cp"), pipeline="p", interval=NOW
    ).awaitTermination()
    found = spark.read.parquet(out)
    assert {r["quality_flag"] for r in found.collect()} == {"PASS", "FAIL"}
    expected = spark.range(1).select(quality.lineage("p", 0)).first()[0]
    assert {r["lineage_id"] for r in found.collect()} == {expected}


def test_table_stream(spark):
    path = work_dir(spark, "t-table")
    spark.range(5).write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS t_stream")
    spark.sql(f"CREATE TABLE t_stream (id BIGINT) USING parquet LOCATION '{path}'")
    try:
        out = work_dir(spark, "t-out")
        streams.append_stream(
            files.stream_table(spark, "t_stream"), work_dir(spark, "t-cp"), path=out, interval=NOW, name="copy"
        ).awaitTermination()
        assert spark.read.parquet(out).count() == 5
    finally:
        spark.sql("DROP TABLE t_stream")


def test_append_to_catalog_table(spark, folder):
    put(folder, "one", range(3))
    spark.sql("DROP TABLE IF EXISTS t_sink")
    path = work_dir(spark, "t-sink")
    spark.sql(f"CREATE TABLE t_sink ({ORDER}) USING parquet LOCATION '{path}'")
    try:
        streams.append_stream(
            source(spark, folder), work_dir(spark, "t-cp"), table="t_sink", interval=NOW
        ).awaitTermination()
        assert spark.table("t_sink").count() == 3
    finally:
        spark.sql("DROP TABLE t_sink")


def test_triggers():
    assert streams.trigger("10 seconds") == {"processingTime": "10 seconds"}
    assert streams.trigger("2 minutes") == {"processingTime": "2 minutes"}
    assert streams.trigger("soon") == {"processingTime": "5 seconds"}
    assert streams.trigger() == {"processingTime": "5 seconds"}
    assert streams.trigger(NOW) == {"availableNow": True}


def test_log_options():
    options = log_source.kafka_options("h:9093", "orders", starting="earliest", max_offsets=500, consumer_group="g")
    assert options["subscribe"] == "orders" and options["maxOffsetsPerTrigger"] == "500"
    assert options["startingOffsets"] == "earliest" and options["kafka.group.id"] == "g"
    with pytest.raises(ValueError):
        log_source.kafka_options("h", "t", starting="now")


def test_log_falls_back_to_the_next_options(spark, folder):
    put(folder, "one", range(2))
    good = {"path": str(folder)}
    spark.conf.set("spark.sql.streaming.schemaInference", "true")
    try:
        rows = log_source.read_log(spark, [{"path": os.path.join(str(folder), "none")}, good], format="json")
        assert rows.isStreaming
        with pytest.raises(Exception):
            log_source.read_log(spark, {"path": os.path.join(str(folder), "none")}, format="json")
    finally:
        spark.conf.unset("spark.sql.streaming.schemaInference")


def test_shaping_a_stream_needs_no_shuffle(spark):
    bronze = bronze_rows(spark, READING)
    plan = streams.weather_to_silver(bronze, packs.weather_rules())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("from_json(") == 1
    assert silver.weather_silver(bronze).columns


def test_json_documents_lie_in_one_folder_and_are_listed_by_few_tasks(spark):
    from pathlib import Path

    from lakequality.plans import catalogue
    from lakequality.session import LISTING_TASKS, shared_root

    root = Path(f"{shared_root(spark)}/lakequality")
    before = set(root.glob("json-in-*"))
    catalogue.QUERIES["stream_json_files"](spark, "/root/testdata/sf0.001")
    (made,) = set(root.glob("json-in-*")) - before
    assert not [path for path in made.iterdir() if path.is_dir()]
    assert len(list(made.glob("*.txt"))) == 10
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == LISTING_TASKS


def test_partitioned_batches_are_compressed_and_not_sorted_by_folder(spark, tmp_path):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    batch = spark.range(6).select((6 - F.col("id")).alias("n"), (F.col("id") % 3).alias("day")).coalesce(1)
    counts = streams.write_batch(batch, 0, str(tmp_path / "out"), partitions=["day"])
    files_made = list((tmp_path / "out" / "batch_id=0").rglob("*.parquet"))
    assert counts["n"] == 6 and len(files_made) == 3
    assert all(path.name.endswith(".zstd.parquet") for path in files_made)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    read = spark.read.parquet(str(tmp_path / "out")).select("n", "day").collect()
    assert sorted((row["n"], row["day"]) for row in read) == sorted((6 - i, i % 3) for i in range(6))


def test_file_streams_run_with_open_folders_and_small_tasks(spark, monkeypatch):
    from lakequality.plans import catalogue
    from lakequality.plans import streams as plans

    seen = {}
    before = {key: spark.conf.get(key, None) for key in streams.FILE_STREAM_SETTINGS}

    def finish(stream):
        seen.update({key: spark.conf.get(key) for key in streams.FILE_STREAM_SETTINGS})
        stream.awaitTermination()

    monkeypatch.setattr(plans, "finish", finish)
    sf_dir = "/root/testdata/sf0.001"
    written = catalogue.QUERIES["stream_orders_to_silver"](spark, sf_dir)
    assert written.count() == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert seen == streams.FILE_STREAM_SETTINGS
    assert seen["spark.sql.maxConcurrentOutputFileWriters"] == streams.OPEN_FOLDERS
    assert before == {key: spark.conf.get(key, None) for key in streams.FILE_STREAM_SETTINGS}


def test_landed_timestamps_are_numbers(spark):
    import glob

    import duckdb

    from lakequality.plans import streams as plans
    from lakequality.sources import samples

    moments = spark.range(3).select("id", samples.at(samples.ORDERS_AS_OF).alias("t"))
    plans.landed(moments, "moments")
    file = glob.glob(f"{os.path.dirname(work_dir(spark, 'moments'))}/moments-*/*.parquet")[0]
    kinds = dict(duckdb.sql(f"SELECT name, type FROM parquet_schema('{file}')").fetchall())
    assert kinds["t"] == "INT64"
