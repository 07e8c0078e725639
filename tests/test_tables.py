"""Dataset checks, reports, incremental operators, monitoring and sinks."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from lakequality import schemas, work_dir
from lakequality.functions import checks
from lakequality.operators import analytics, dataset, incremental, maintenance, monitor, packs, sinks
from lakequality.operators.rules import Rule, RuleSet

T0 = datetime.datetime(2024, 1, 31)


def hot_rows(count=6000, seed=7):
    """A third of the rows share one key."""
    pick = random.Random(seed)
    return [
        (0 if i % 3 == 0 else pick.randrange(400), pick.randrange(50), i, f"v{pick.randrange(9)}")
        for i in range(count)
    ]


HOT = "k INT, t INT, n INT, v STRING"


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), HOT).repartition(8).cache()


def test_duplicates_with_nulls(spark):
    data = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")], "x INT, y STRING")
    found = dataset.flag_duplicates(data, ["x", "y"])
    assert sorted((r.x, r.y or "", r.is_unique) for r in found.collect()) == [
        (1, "", False),
        (1, "", False),
        (1, "a", False),
        (1, "a", False),
        (2, "a", True),
    ]
    assert dataset.no_duplicates(data, ["x", "y"]).first()["value"] == 2


def test_duplicates_with_a_hot_key(spark, hot):
    counts = {}
    for k, t, *_ in hot_rows():
        counts[k, t] = counts.get((k, t), 0) + 1
    flagged = dataset.flag_duplicates(hot, ["k", "t"]).select("k", "t", "is_unique").collect()
    assert len(flagged) == 6000
    assert all(row.is_unique == (counts[row.k, row.t] == 1) for row in flagged)


def test_freshness_and_volume(spark):
    data = spark.createDataFrame([(T0 - datetime.timedelta(hours=5),)], "ts TIMESTAMP")
    as_of = "2024-01-31 00:00:00"
    assert dataset.freshness(data, "ts", 24, as_of).first()["passed"] is True
    assert dataset.freshness(data, "ts", 4, as_of).first()["passed"] is False
    assert dataset.freshness(data.limit(0), "ts", 4, as_of).first()["passed"] is False
    assert dataset.minimum_count(data, 1).first()["passed"] is True
    assert dataset.minimum_count(data, 2).first()["passed"] is False


def test_schema_diff(spark):
    data = spark.createDataFrame([(1, None, 2.0)], "a INT, b STRING, extra DOUBLE")
    expected = schemas.struct("a BIGINT, b STRING NOT NULL, gone DATE")
    found = {row["column"]: row["verdict"] for row in dataset.schema_diff(data, expected).collect()}
    assert found == {"a": "type differs", "b": "has nulls", "gone": "missing", "extra": "unexpected"}


def test_completeness_and_validations(spark):
    data = spark.createDataFrame([("a", 1), (None, -1), ("c", None)], "s STRING, n INT")
    found = {r["column"]: (r["filled"], r["nulls"]) for r in dataset.completeness(data, ["s", "n"]).collect()}
    assert found == {"s": (2, 1), "n": (2, 1)}
    listed = [
        {"column": "s", "check": "not_null"},
        {"column": "n", "check": "positive"},
        {"column": "s", "check": "valid_values", "values": ["a", "c"]},
    ]
    assert [r["violations"] for r in dataset.validation_list(data, listed).collect()] == [1, 2, 1]
    with pytest.raises(ValueError):
        dataset.validation_list(data, [{"column": "s", "check": "odd"}])


def test_bronze_validation(spark):
    day = datetime.date(2024, 1, 1)
    data = spark.createDataFrame(
        [("r1", "{}", day, "true"), (None, "", day, None)],
        "record_id STRING, raw_payload STRING, ingestion_date DATE, is_valid STRING",
    )
    found = {(r["check"], r["item"]): r["n"] for r in dataset.bronze_validation(data).collect()}
    assert found == {
        ("null_record_ids", ""): 1,
        ("empty_payloads", ""): 1,
        ("validity", "true"): 1,
        ("validity", ""): 1,
        ("date", "2024-01-01"): 2,
    }


def test_sample(spark):
    assert dataset.sample_rows(spark.range(100), 1000, "id").count() == 100
    assert 300 < dataset.sample_rows(spark.range(10000), 500, "id").count() < 700


FRAGMENTS = {
    "plain": (['{"response":"Hello "}', '{"response":"World"}', '{"response":"!"}'], "Hello World!"),
    "blank": (['{"response":"Hello"}', "", '{"response":" World"}'], "Hello World"),
    "broken": (['{"response":"Valid"}', "{oops", '{"response":" Response"}'], "Valid Response"),
    "empty": (['{"response":"Start"}', '{"response":""}', '{"response":"End"}'], "StartEnd"),
    "other": (['{"response":"Valid"}', '{"note":"x"}', '{"response":" Content"}'], "Valid Content"),
    "none": ([None, ""], ""),
}


@pytest.mark.parametrize("span", [1, 2, 10_000])
def test_fragments(spark, span):
    lines = [(k, i, line) for k, (listed, _) in FRAGMENTS.items() for i, line in enumerate(listed)]
    data = spark.createDataFrame(lines, "id STRING, seq INT, line STRING").repartition(5)
    found = analytics.concat_fragments(data, "id", "seq", "line", span=span).collect()
    assert {row["id"]: row["text"] for row in found} == {k: text for k, (_, text) in FRAGMENTS.items()}


def test_long_text_stays_in_pieces(spark):
    data = spark.range(1000).select(
        F.lit("a").alias("id"),
        F.col("id").alias("seq"),
        F.to_json(F.struct(F.concat("id", F.lit(",")).alias("response"))).alias("line"),
    )
    pieces = analytics.fragment_pieces(data, "id", "seq", "line", span=100).orderBy("piece").collect()
    assert len(pieces) == 10
    assert "".join(row["text"] for row in pieces) == "".join(f"{i}," for i in range(1000))


VALIDATED = "quality_flag STRING, quality_score DOUBLE, failure_reason STRING, day DATE, area STRING"


@pytest.fixture(scope="module")
def validated(spark):
    day = datetime.date(2024, 1, 31)
    back = [day - datetime.timedelta(days=n) for n in range(10)]
    data = [
        ("PASS" if n % 4 else "FAIL", 1.0 if n % 4 else 0.5, None if n % 4 else f"total_amount {n % 8}", d, "ab"[n % 2])
        for n, d in enumerate(back)
    ]
    return spark.createDataFrame(data, VALIDATED).cache()


def test_last_days_cover_both_ends(spark, validated):
    as_of = F.lit("2024-01-31").cast("date")
    trend = analytics.quality_trend(validated, F.col("day"), since=analytics.last_days(as_of, 7))
    assert trend.count() == 8
    summary = analytics.trend_summary(trend).first()
    assert summary["total_records"] == 8 and summary["max_rate"] == 100.0


def test_overview_and_reasons(validated):
    row = analytics.quality_overview(validated).first()
    assert (row["total_records"], row["pass_records"], row["fail_records"]) == (10, 7, 3)
    assert row["quality_rate"] == pytest.approx(0.7)
    assert analytics.quality_overview(validated.limit(0)).first()["quality_rate"] == 0.0
    top = analytics.top_failure_reasons(validated, 1).collect()
    assert [(r["failure_reason"], r["n"]) for r in top] == [("total_amount 0", 2)]
    assert analytics.financial_failures(validated).first()[0] == 3
    assert {(r["dimension"], r["value"], r["n"]) for r in analytics.failures_by(validated, ["area"]).collect()} == {("area", "a", 3)}


def test_unknown_aggregate(validated):
    with pytest.raises(ValueError):
        analytics.aggregate_by(validated, ["area"], {"day": "median"})


def test_share_by(validated):
    found = {r["area"]: (r["n"], r["share"]) for r in analytics.share_by(validated, "area", "quality_score").collect()}
    assert found == {"a": (5, 0.5), "b": (5, 0.5)}


# ---- incremental ---------------------------------------------------------------------------------


def test_newest_matches_brute_force_with_a_hot_key(hot):
    best = {}
    for k, t, n, v in hot_rows():
        best[k] = max(best.get(k, (-1,)), (t, n, v))
    found = {row["k"]: (row["t"], row["n"], row["v"]) for row in incremental.newest(hot, ["k"], "t").collect()}
    assert found == best


def test_upsert_matches_brute_force(spark, hot):
    target = spark.createDataFrame([(k, -1, -1, "old") for k in range(200, 600)], HOT)
    expected = {k: (-1, -1, "old") for k in range(200, 600)}
    best = {}
    for k, t, n, v in hot_rows():
        best[k] = max(best.get(k, (-1,)), (t, n, v))
    expected.update(best)
    found = incremental.upsert(target, hot, ["k"], "t").collect()
    assert len(found) == len(expected)
    assert {r["k"]: (r["t"], r["n"], r["v"]) for r in found} == expected


def test_upsert_keeps_null_keys(spark):
    target = spark.createDataFrame([(None, "t"), (1, "t")], "k INT, v STRING")
    source = spark.createDataFrame([(None, "s"), (1, "s")], "k INT, v STRING")
    found = sorted((r["k"] or 0, r["v"]) for r in incremental.upsert(target, source, ["k"]).collect())
    assert found == [(0, "s"), (0, "t"), (1, "s")]


def test_unprocessed(spark):
    bronze = spark.createDataFrame([(1,), (2,), (None,)], "id INT")
    silver = spark.createDataFrame([(2,), (None,)], "id INT")
    assert {r["id"] for r in incremental.unprocessed(bronze, silver, "id").collect()} == {1, None}


def test_pages_with_a_hot_value(hot):
    expected = {row: i for i, row in enumerate(sorted(hot_rows(), key=lambda r: (r[0], r[2])))}
    found = incremental.paged(hot, ["k", "n"], 100).collect()
    assert len(found) == 6000
    for row in found:
        place = expected[row["k"], row["t"], row["n"], row["v"]]
        assert (row["position"], row["page"]) == (place + 1, place // 100)


def test_unions(spark):
    left = spark.createDataFrame([(1, "a")], "n INT, s STRING")
    right = spark.createDataFrame([("b", 2)], "s STRING, n INT")
    assert {tuple(r) for r in incremental.union_all([left, right]).collect()} == {(1, "a"), (2, "b")}
    assert incremental.union_all([left, left, left], by_name=False).count() == 3


# ---- monitoring ----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "rate, status",
    [(0.95, "excellent"), (0.94, "good"), (0.8, "good"), (0.6, "needs_attention"), (0.5, "critical")],
)
def test_status_steps(spark, rate, status):
    data = spark.createDataFrame([(rate, 101, 0.6)], "quality_rate DOUBLE, fail_records INT, avg_score DOUBLE")
    row = monitor.quality_status(data).first()
    assert row["quality_status"] == status and row["meets_threshold"] == (rate >= 0.95)
    assert len(row["recommendations"].split("; ")) == (3 if rate < 0.8 else 2)


def test_metrics_and_alerts(validated):
    metrics = monitor.collect_metrics(
        validated, passed=F.col("quality_flag") == "PASS", low=F.col("quality_score") < 0.6
    )
    row = metrics.first()
    assert (row["passed_records"], row["failed_records"], row["pass_rate"]) == (7, 3, 0.7)
    assert "below threshold" in monitor.alerts(metrics).first()["alert"]
    assert monitor.alerts(metrics, threshold=0.5).count() == 0
    assert monitor.alerts(metrics, threshold=0.5, low_share=0.2).count() == 1


def test_anomalies(spark):
    ddl = "pass_rate DOUBLE, processing_time DOUBLE, failed_records DOUBLE"
    now = spark.createDataFrame([(0.70, 500.0, 300.0), (0.95, 100.0, 50.0)], ddl)
    before = spark.createDataFrame([(0.9, 80.0, 40.0), (1.0, 120.0, 60.0)], ddl)
    found = monitor.anomalies(
        now, before, falls={"pass_rate": 0.9}, rises={"processing_time": 2, "failed_records": 2}
    ).collect()
    assert len(found[0]["anomalies"].split("; ")) == 3 and found[1]["anomalies"] == ""


def test_sla(spark):
    data = spark.createDataFrame([(0.96, 90, 0.999), (0.9, 90, 0.999)], "pass_rate DOUBLE, processing_time INT, availability DOUBLE")
    found = monitor.sla_compliance(
        data, least={"pass_rate": 0.95, "availability": 0.99}, most={"processing_time": 100}
    ).collect()
    assert [row["overall_ok"] for row in found] == [True, False]


# ---- sinks and maintenance -------------------------------------------------------------------------

DAY_ROWS = "day DATE, hour INT, n INT"


def days(spark, count=4, per_day=50):
    return spark.range(count * per_day).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % count).cast("int")).alias("day"),
        (F.col("id") % 3).cast("int").alias("hour"),
        F.col("id").cast("int").alias("n"),
    )


def test_partitioned_write_counts_rows(spark):
    path = work_dir(spark, "t-write")
    assert sinks.write_partitioned(days(spark), path, partitions=["day", "hour"]) == 200
    assert sinks.write_partitioned(days(spark), path, partitions=["day", "hour"]) == 200
    written = spark.read.parquet(path)
    assert written.count() == 400
    assert sinks.write_report(written, ["day"]).agg(F.sum("n")).first()[0] == 400
    sinks.write_partitioned(days(spark), path, partitions=["day"], mode="overwrite", max_records_per_file=10)
    again = spark.read.parquet(path)
    assert again.count() == 200
    assert maintenance.files(again).agg(F.max("n")).first()[0] <= 10


def test_split_is_written_once(spark):
    rules = RuleSet((Rule("small", checks.at_most("n", 99)),))
    good, bad = sinks.write_split(days(spark), rules, work_dir(spark, "t-split"))
    assert (good.count(), bad.count()) == (100, 100)
    assert bad.agg(F.min("n")).first()[0] == 100


def test_report_export(spark):
    path = work_dir(spark, "t-report")
    sinks.export_report(spark.createDataFrame([(1, "PASSED")], "n INT, status STRING"), path)
    assert spark.read.json(path).first()["status"] == "PASSED"


@pytest.fixture
def table(spark):
    name = "t_days"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_table_life(spark, table):
    path = work_dir(spark, "t-table")
    days(spark).write.partitionBy("day").parquet(path)
    maintenance.create_table(
        spark,
        table,
        "n INT, hour INT, day DATE",
        partitions=["day"],
        path=path,
        properties={"made_by": "tests"},
        comment="days",
    )
    assert spark.table(table).count() == 0
    assert maintenance.repair(spark, table) == 4
    assert maintenance.repair(spark, table) == 0
    assert spark.table(table).count() == 200
    maintenance.drop_partitions(spark, table, [{"day": "2024-01-01"}])
    assert spark.table(table).count() == 150
    maintenance.add_partition(spark, table, {"day": "2024-01-01"}, f"{path}/day=2024-01-01")
    assert spark.table(table).count() == 200
    assert {str(r["day"]) for r in maintenance.partitions(spark, table).collect()} == {
        f"2024-01-0{d}" for d in range(1, 5)
    }
    maintenance.analyze(spark, table, ["n"])
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert "200 rows" in described["Statistics"]


def test_expire(spark, table):
    sinks.save_table(days(spark), table, partitions=["day"], path=work_dir(spark, "t-expire"))
    report = maintenance.expire(spark, table, "day", "2024-01-05", 2).collect()
    assert {(str(r["day"]), r["n"]) for r in report} == {("2024-01-01", 50), ("2024-01-02", 50)}
    assert all(r["bytes"] > 0 and r["files"] > 0 for r in report)
    assert spark.table(table).count() == 100
    assert maintenance.expire(spark, table, "day", "2024-01-05", 2).count() == 0


def test_compaction_and_repoint(spark, table):
    old = work_dir(spark, "t-old")
    days(spark).repartition(8).write.partitionBy("day").parquet(old)
    maintenance.create_table(spark, table, "hour INT, n INT, day DATE", partitions=["day"], path=old)
    maintenance.repair(spark, table)
    before = maintenance.storage_stats(spark.table(table)).first()
    new = work_dir(spark, "t-new")
    maintenance.compact(spark.table(table), new, partitions=["day"], cluster_by=["n"])
    maintenance.repoint(spark, table, new)
    after = maintenance.storage_stats(spark.table(table)).first()
    assert after["n"] == before["n"] == 200 and after["files"] < before["files"]
    expected = sorted(map(tuple, days(spark).select("n", "day").collect()))
    assert sorted(map(tuple, spark.table(table).select("n", "day").collect())) == expected
    with pytest.raises(ValueError):
        maintenance.compact(spark.table(table), new)


def test_plain_table_repoint(spark, table):
    first, second = work_dir(spark, "t-a"), work_dir(spark, "t-b")
    days(spark).write.parquet(first)
    days(spark).filter("n < 10").write.parquet(second)
    maintenance.create_table(spark, table, DAY_ROWS, path=first)
    assert spark.table(table).count() == 200
    maintenance.repoint(spark, table, second)
    assert spark.table(table).count() == 10


def test_external_table_append(spark, table):
    path = work_dir(spark, "t-ext")
    sinks.save_table(days(spark), table, partitions=["day"], path=path)
    sinks.save_table(days(spark), table, partitions=["day"], path=path)
    assert spark.table(table).count() == 400


class _Cluster:
    """Just enough of a session that runs on a cluster."""

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": "yarn"})


def test_shared_folder_is_required_on_a_cluster():
    from lakequality.session import shared_root

    assert shared_root(_Cluster("hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Cluster(None))


def test_sql_text_as_a_source(spark):
    from lakequality.sources.files import read_path, read_sql

    path = work_dir(spark, "t-sql")
    days(spark).write.json(path)
    rows = read_path(spark, path, "json", dateFormat="yyyy-MM-dd")
    assert read_sql(spark, "SELECT count(*) AS c FROM {t}", t=rows).first()["c"] == 200


def test_status_domains_are_parameters(spark):
    data = spark.createDataFrame([("CONFIRMED",)], "order_status STRING")
    usual = RuleSet((list(packs.order_high())[0],))
    wider = RuleSet((list(packs.order_high(packs.CATALOG_ORDER_STATUSES))[0],))
    from lakequality.operators import quality

    assert quality.validate(data, usual).first()["quality_flag"] == "WARNING"
    assert quality.validate(data, wider).first()["quality_flag"] == "PASS"


def test_expire_reports_what_is_gone(spark, table):
    rows = spark.sql("SELECT id, 'a:b' AS site, DATE'2024-01-01' AS day FROM range(10)")
    sinks.save_table(rows, table, partitions=["day", "site"], path=work_dir(spark, "t-escaped"))
    report = maintenance.expire(spark, table, "day", "2024-02-01", 2).collect()
    assert [row["n"] for row in report] == [10]
    assert spark.table(table).count() == 0


def test_repoint_keeps_partitions_that_the_new_version_lacks(spark, table):
    sinks.save_table(days(spark), table, partitions=["day"], path=work_dir(spark, "t-old"))
    before = spark.table(table).count()
    first = spark.table(table).agg({"day": "min"}).first()[0]
    new = work_dir(spark, "t-new")
    maintenance.compact(spark.table(table).filter(f"day = '{first}'"), new, partitions=["day"])
    maintenance.repoint(spark, table, new)
    assert spark.table(table).count() == before
    short = work_dir(spark, "t-short")
    maintenance.compact(spark.table(table).filter(f"day = '{first}'").limit(1), short, partitions=["day"])
    if spark.table(table).filter(f"day = '{first}'").count() > 1:
        with pytest.raises(ValueError):
            maintenance.repoint(spark, table, short)
