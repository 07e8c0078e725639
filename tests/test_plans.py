"""The shape of physical plans, and every registered query against its SQL."""

import pytest
from pyspark.sql import functions as F

from lakequality.operators import incremental, quality
from lakequality.plans import catalogue
from lakequality.plans.bronze import written_bronze
from lakequality.sources import files, samples

from . import compare

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_need_one_scan_and_no_shuffle(spark):
    orders = samples.table(spark, SF, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.lit(1).alias("quantity")
    )
    from lakequality.operators.rules import Rule, RuleSet

    rules = RuleSet((Rule("a", "quantity > 0"), Rule("b", "order_id <> ''")))
    text = plan(quality.validate(orders, rules))
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_latest_row_is_chosen_before_the_shuffle(spark):
    lines = samples.table(spark, SF, "lineitem")
    text = plan(incremental.newest(lines, ["l_orderkey"], "l_shipdate"))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text


def test_date_range_prunes_partitions(spark):
    rows = files.bronze_range(written_bronze(spark, SF), "2024-01-05", "2024-01-06", [1, 2])
    text = plan(rows.select("record_id"))
    assert "PartitionFilters: [isnotnull(ingestion_date" in text
    assert "ReadSchema: struct<record_id:string>" in text


def test_small_changes_do_not_shuffle_the_target(spark):
    target = spark.range(1000).withColumn("v", F.lit(1))
    source = spark.range(5).withColumn("v", F.lit(2))
    text = plan(incremental.upsert(target, source, ["id"]))
    assert "LeftAnti" in text and "Exchange hashpartitioning" not in text


def test_large_master_is_not_broadcast(spark):
    from lakequality.operators import silver

    left, master = spark.range(1000), spark.range(1000).withColumn("v", F.lit(1))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "SortMergeJoin" in plan(silver.enrich(left, master, ["id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_silver_reports_push_filters_down(spark):
    text = plan(catalogue.QUERIES["top_failure_reasons"](spark, SF))
    assert "EqualTo(quality_flag,FAIL)" in text
    assert "ReadSchema: struct<quality_flag:string,failure_reason:string>" in text


@pytest.mark.parametrize(
    "name",
    ["valid_rows", "flag_metrics", "quality_scores", "lineage_sample", "table_statistics", "quality_status", "sql_source", "batch_metrics"],
)
def test_order_reports_write_no_wide_table_first(spark, name):
    text = plan(catalogue.QUERIES[name](spark, SF))
    assert "lineitem.parquet" in text and "p_name" not in text and "failure_reason" not in text


@pytest.mark.parametrize("name", ["parse_order_payload", "default_fill"])
def test_orders_are_parsed_without_a_table_in_between(spark, name):
    assert "lineitem.parquet" in plan(catalogue.QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["quality_status", "sql_source"])
def test_reports_join_orders_by_hash_in_small_tasks(spark, name):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        report = catalogue.QUERIES[name](spark, SF)
        report.collect()
        final = plan(report).split("Initial Plan")[0]
    finally:
        spark.conf.set(setting, before)
    assert final.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in final
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_prices_and_dates_are_cast_before_the_joins(spark):
    text = plan(samples.order_items(spark, SF).select("unit_price", "order_date"))
    above = text[: text.index("Join")]
    assert "p_retailprice" not in above and "o_orderdate" not in above


def test_nested_json_is_parsed_once(spark):
    text = plan(catalogue.QUERIES["nested_json_paths"](spark, SF))
    assert text.count("from_json(") == 1 and "get_json_object" not in text


def test_messages_are_not_encoded_again(spark):
    assert "encode(" not in plan(samples.order_log(spark, SF).select("value"))


def test_wide_rows_with_many_rules_use_small_methods(spark):
    from lakequality.session import HOTSPOT_METHOD_LIMIT, prepare

    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    prepare(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == HOTSPOT_METHOD_LIMIT


def test_keys_are_the_same_on_both_sides():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == {"bronze_sample"}


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_matches_sql(spark, connection, name):
    verdict, _ = compare.compare(
        spark, connection, SF, catalogue.QUERIES[name], catalogue.ORACLES.get(name)
    )
    assert verdict == ""
