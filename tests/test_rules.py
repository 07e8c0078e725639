"""Rules, rule sets and the quality engine on small rows with known outcomes."""

import pytest
from pyspark.sql import functions as F

from lakequality.functions import checks
from lakequality.operators import analytics, dataset, packs, quality
from lakequality.operators.rules import ERROR, WARN, Rule, RuleSet, rule_from_config

FRAMEWORK_ROWS = [
    ("ORD001", "ITEM001", 10, 100.0, "2024-09-19 10:00:00"),
    ("ORD002", "ITEM002", -5, 50.0, "2024-09-19 11:00:00"),
    ("ORD003", None, 3, 30.0, "2024-09-19 12:00:00"),
    ("ORD004", "ITEM004", 0, 0.0, "2024-09-19 13:00:00"),
    ("ORD005", "ITEM005", 15, 150.0, None),
    ("ORD001", "ITEM001", 10, 100.0, "2024-09-19 14:00:00"),
]
FRAMEWORK = "order_id STRING, item_id STRING, quantity INT, amount DOUBLE, timestamp STRING"
ORDER = (
    "order_id STRING, product_id STRING, quantity INT, unit_price DOUBLE, total_amount DOUBLE, "
    "customer_id STRING"
)
SCENARIOS = [
    ("ORD-123456", "PRD001", 2, 100.0, 200.0, "CUST-1234"),
    ("ORD-123457", "PRD002", 2, 100.0, 150.0, "CUST-1235"),
    ("ORD-123458", "PRD003", 0, 100.0, 0.0, "CUST-1236"),
    ("ORD-123459", "PRD004", 1, -50.0, -50.0, "CUST-1237"),
]


@pytest.fixture
def framework(spark):
    return spark.createDataFrame(FRAMEWORK_ROWS, FRAMEWORK)


@pytest.fixture
def scenarios(spark):
    return spark.createDataFrame(SCENARIOS, ORDER)


def failures(df, rules):
    return {row["rule"]: row["failed"] for row in quality.rule_failures(df, rules).collect()}


def test_framework_counts(framework):
    found = failures(framework, packs.framework_rules())
    assert found == {"completeness": 1, "validity": 2, "consistency": 0, "timestamp_format": 1}
    assert dataset.duplicate_keys(framework, ["order_id", "item_id"]).count() == 1


def test_framework_mean_score(framework):
    rules = packs.framework_rules().without("timestamp_format")
    assert framework.withColumn("s", quality.mean_score(rules)).filter("s = 1.0").count() == 3


def test_quarantine(framework):
    rules = packs.framework_rules().without("timestamp_format")
    assert quality.free_name("A", ["a", "a_"]) == "A__"
    named = framework.withColumn("broken_rules_0", F.lit(7)).withColumn("quarantined", F.lit("mine"))
    kept = [side.select("broken_rules_0", "quarantined").distinct().collect() for side in quality.split(named, rules)]
    assert kept == [[(7, "mine")], [(7, "mine")]]
    passed, quarantined = quality.split(framework, rules)
    assert passed.count() == 3
    assert {row["order_id"] for row in quarantined.collect()} == {"ORD002", "ORD003", "ORD004"}


def test_report(framework, rows):
    dimensions = {rule.name: rule.passed() for rule in packs.framework_rules()}
    [report] = rows(analytics.quality_report(framework, dimensions, ["order_id", "item_id"]))
    assert report["total_records"] == 6 and report["rules_executed"] == 5
    assert report["uniqueness_failures"] == 1
    assert report["pass_rate"] == pytest.approx((6 - 5) * 100 / 6)


def test_scenarios(scenarios):
    rules = RuleSet(
        tuple(rule for rule in packs.order_critical() if rule.name not in ("tax_amount_valid", "order_date_not_null"))
    )
    checked = quality.validate(scenarios, rules).collect()
    broken = {row["order_id"]: set(row["rule_results"]) for row in checked}
    assert broken["ORD-123456"] == {quality.ALL_PASSED}
    assert broken["ORD-123457"] == {"total_amount_calculation_valid"}
    assert broken["ORD-123458"] == {"quantity_positive", "total_amount_positive"}
    assert broken["ORD-123459"] == {"unit_price_positive", "total_amount_positive"}


def test_flags_counts_and_reasons(spark, rows):
    rules = RuleSet(
        (
            Rule("id_there", checks.not_empty("id"), message="no id"),
            Rule("small", checks.at_most("n", 10), WARN, "low"),
            Rule("positive", "n > 0"),
        )
    )
    data = spark.createDataFrame(
        [("a", 5), ("b", 50), (" ", 50), ("d", None)], "id STRING, n INT"
    )
    checked = rows(quality.validate(data, rules), "id")
    by_id = {row["id"]: row for row in checked}
    assert by_id["a"]["quality_flag"] == "PASS" and by_id["a"]["failure_reason"] is None
    assert by_id["a"]["criticality"] is None and by_id["a"]["quality_score"] == 1.0
    assert by_id["b"]["quality_flag"] == "WARNING" and by_id["b"]["criticality"] == WARN
    assert by_id["b"]["quality_score"] == pytest.approx(2 / 3)
    assert by_id[" "]["failure_reason"] == "no id; small"
    assert by_id[" "]["criticality"] == ERROR and by_id[" "]["failed_rules"] == 2
    # A NULL makes a condition unknown, which counts as broken.
    assert by_id["d"]["rule_results"] == ["small", "positive"]
    assert all(row["failed_rules"] + row["passed_rules"] == 3 for row in checked)


def test_null_may_pass(spark):
    data = spark.createDataFrame([(None,)], "n INT")
    lenient = RuleSet((Rule("positive", "n > 0", on_null="pass"),))
    strict = RuleSet((Rule("positive", "n > 0"),))
    assert quality.validate(data, lenient).first()["quality_flag"] == "PASS"
    assert quality.validate(data, strict).first()["quality_flag"] == "FAIL"


def test_coarse_and_warn_as_pass(spark):
    rules = RuleSet((Rule("a", "n > 0"), Rule("b", "n > 5", WARN, "low")))
    data = spark.createDataFrame([(9,), (3,), (0,)], "n INT")
    found = {
        row["n"]: (row["quality_flag"], row["failed_rules"], row["quality_score"])
        for row in quality.validate(data, rules, warn_is_pass=True, coarse=True).collect()
    }
    assert found == {9: ("PASS", 0, 1.0), 3: ("PASS", 0, 1.0), 0: ("FAIL", 2, 0.0)}


def test_more_rules_than_bits(spark):
    rules = RuleSet(
        tuple(Rule(f"above_{i}", f"n > {i}", ERROR if i % 2 else WARN) for i in range(130))
    )
    data = spark.createDataFrame([(n,) for n in (-1, 0, 61, 64, 129, 130)], "n INT")
    for row in quality.validate(data, rules).collect():
        expected = [f"above_{i}" for i in range(130) if not row["n"] > i]
        assert row["failed_rules"] == len(expected)
        assert row["rule_results"] == (expected or [quality.ALL_PASSED])
        errors = any(int(name.split("_")[1]) % 2 for name in expected)
        assert row["quality_flag"] == ("FAIL" if errors else "WARNING" if expected else "PASS")


def test_score_modes(spark):
    row = spark.range(1).select(
        quality.score(F.lit(1), 4).alias("ratio"),
        quality.score(F.lit(1), 4, "binary").alias("binary"),
        quality.score(F.lit(0), 4, "basic").alias("basic"),
        quality.score(F.lit(3), 4, "penalty").alias("penalty"),
        quality.score(F.lit(9), 9, "penalty").alias("floor"),
    ).first()
    assert (row.ratio, row.binary, row.basic) == (0.75, 0.0, 0.8)
    assert row.penalty == pytest.approx(0.4) and row.floor == 0.0
    with pytest.raises(ValueError):
        quality.score(F.lit(1), 1, "other")


def test_basic_validation(spark):
    data = spark.createDataFrame(
        [
            ("o", "p", 1, 2.0, 2.0, "c", "SUCCESS"),
            ("o", "p", 0, 2.0, 2.0, "c", "FAILED"),
            ("o", None, 1, 2.0, 2.0, "c", "PARTIAL"),
        ],
        ORDER + ", parsing_status STRING",
    )
    good, bad, missing = quality.validate_basic(data, packs.order_basic_flag()).collect()
    assert (good["quality_flag"], good["quality_score"], good["failure_reason"]) == ("PASS", 0.8, None)
    assert bad["failure_reason"] == (
        "Validation failed: invalid quantity; total_amount calculation mismatch; JSON parsing failed"
    )
    assert (bad["failed_rules"], bad["passed_rules"], bad["quality_score"]) == (1, 0, 0.0)
    assert "product_id missing" in missing["failure_reason"]


NET = (
    "quantity INT, unit_price DOUBLE, discount_amount DOUBLE, tax_amount DOUBLE, "
    "shipping_cost DOUBLE, total_amount DOUBLE, order_status STRING, payment_status STRING"
)


def test_order_model(spark):
    data = spark.createDataFrame(
        [
            (3, 15.5, 0.0, 0.0, 0.0, 46.5, "NEW", "PENDING"),
            (2, 20.0, 0.0, 0.0, 0.0, 50.0, "NEW", "PENDING"),
            (2, 25.0, 5.0, 3.0, 0.0, 48.0, "NEW", "PENDING"),
            (1, 1.0, 0.0, 0.0, 0.0, 1.0, "CANCELLED", "PAID"),
            (1, 1.0, 0.0, 0.0, 0.0, 1.0, "DELIVERED", "PENDING"),
            (1, 1.0, 0.0, 0.0, 0.0, 1.0, None, "PAID"),
        ],
        NET,
    )
    checked = quality.validate(data, packs.order_model(), score_mode="penalty").collect()
    assert [row["quality_flag"] == "PASS" for row in checked] == [True, False, True, False, False, True]
    assert "Total amount mismatch" in checked[1]["failure_reason"]
    assert checked[1]["quality_score"] == pytest.approx(0.8)


def test_graded_scores(spark):
    data = spark.createDataFrame(
        [
            ("ORD-HQ-001", "PRD", 5, 20.0, 100.0, "CUST-001"),
            ("ORD-HQ-002", "PRD", 3, 25.0, 75.0, "CUST-002"),
            ("ORD-MQ-001", "PRD", 1, 30.0, 30.01, "CUST-003"),
            ("ORD-LQ-001", "PRD", -2, 40.0, -80.0, "CUST-004"),
            ("", "PRD", 1, 50.0, 50.0, ""),
        ],
        ORDER,
    )
    parts = quality.graded_components(
        "quantity", "unit_price", "total_amount", "order_id", "customer_id", "product_id"
    )
    scored = data.withColumns(parts).withColumn("score", sum(F.col(n) for n in parts) / 3)
    found = scored.withColumn("category", quality.category(F.col("score"))).collect()
    assert [round(row["score"], 3) for row in found] == [1.0, 1.0, 0.933, 0.667, 0.667]
    assert [row["category"] for row in found] == ["HIGH", "HIGH", "HIGH", "MEDIUM", "MEDIUM"]


def test_ten_invalid_rows_break_one_rule_each(spark):
    good = ("ORD", "ITEM", 10, 100.0, "test@example.com", "123-456-7890", "NEW")
    changes = [(0, None), (1, None), (2, -5), (2, 0), (4, "invalid-email"), (4, "test@")]
    changes += [(5, "invalid-phone"), (5, "123-45-6789"), (6, "INVALID_STATUS"), (3, -50.0)]
    data = [good] + [good[:i] + (value,) + good[i + 1 :] for i, value in changes]
    rules = RuleSet(
        (
            Rule("order_there", checks.not_null("order_id")),
            Rule("item_there", checks.not_null("item_id")),
            Rule("quantity_positive", checks.greater_than("quantity", 0)),
            Rule("amount_not_negative", checks.at_least("amount", 0)),
            Rule("email", checks.matches("email", checks.EMAIL)),
            Rule("phone", checks.matches("phone", checks.PHONE)),
            Rule("status", checks.one_of("status", packs.OPEN_STATUSES)),
        )
    )
    df = spark.createDataFrame(
        data,
        "order_id STRING, item_id STRING, quantity INT, amount DOUBLE, email STRING, phone STRING, status STRING",
    )
    assert [row["failed_rules"] for row in quality.validate(df, rules).collect()] == [0] + [1] * 10


def test_rule_sets(spark):
    rules = packs.order_rules()
    assert rules.counts() == {"critical": 9, "high": 4, "medium": 3, "low": 4}
    assert len(rules.critical()) == 9 and len(rules.warnings()) == 11
    assert len(packs.weather_rules()) == 14 and len(packs.order_catalog()) == 16
    assert len(packs.order_basic()) == 8 and len(packs.order_minimal()) == 7
    assert len(packs.order_rules(formats=False, ranges=False)) == 13
    custom = rules.add(Rule("extra", "quantity > 1", WARN, "low"), "medium")
    assert custom.counts()["medium"] == 4 and len(rules) == 20
    assert rules.usable() and not RuleSet(()).usable()


def test_rule_configuration_errors(spark):
    with pytest.raises(ValueError, match="lacks check"):
        rule_from_config({"name": "x"})
    with pytest.raises(ValueError, match="unknown entries"):
        rule_from_config({"name": "x", "check": "a > 1", "level": 3})
    with pytest.raises(ValueError, match="unique"):
        RuleSet((Rule("x", "a > 1"), Rule("x", "a > 2")))
    for bad in ({"name": "a b"}, {"criticality": "fatal"}, {"category": "none"}, {"on_null": "?"}):
        with pytest.raises(ValueError):
            rule_from_config({"name": "x", "check": "a > 1", **bad})
    assert rule_from_config({"name": "x", "check": "a > 1"}).text == "x"
    with pytest.raises(ValueError):
        quality.validate(spark.range(1), RuleSet(()))


def test_unknown_column_is_reported(framework):
    with pytest.raises(Exception, match="no_such_column"):
        quality.validate(framework, RuleSet((Rule("x", "no_such_column > 0"),)))


def test_schema_rules(spark):
    data = spark.createDataFrame(
        [
            ("ORD00000001", "LINE000001", "ITEM00001", "2", 1.0, 2.0, "STORE001", "NEW"),
            ("ORD1", None, None, "two", -1.0, None, "S", "LOST"),
        ],
        "order_id STRING, line_item_id STRING, item_id STRING, quantity STRING, unit_price DOUBLE, "
        "total_amount DOUBLE, store_id STRING, status STRING",
    )
    good, bad = quality.validate(data, packs.schema_rules(packs.LINE_ITEM_SCHEMA)).collect()
    assert good["failed_rules"] == 0
    assert set(bad["rule_results"]) == {
        "item_id_required",
        "order_id_pattern",
        "quantity_type",
        "unit_price_minimum",
        "store_id_pattern",
        "status_enum",
    }


def test_input_errors(spark):
    data = spark.createDataFrame(
        [
            ("ORD-123456", "PROD-1001", "3", "9.5"),
            (None, "PRD", "x", "-1"),
            ("ORD-1", "PROD-1001", "0", "cheap"),
        ],
        "order_id STRING, product_id STRING, quantity STRING, unit_price STRING",
    )
    found = [row["e"] for row in data.select(quality.order_input_errors().alias("e")).collect()]
    assert found[0] == {}
    assert found[1] == {
        "order_id": "order_id is required",
        "product_id": "Invalid product ID format",
        "quantity": "Quantity must be a valid integer",
        "unit_price": "Unit price must be positive",
    }
    assert found[2] == {
        "order_id": "Invalid order ID format",
        "quantity": "Quantity must be positive",
        "unit_price": "Unit price must be a valid number",
    }


def test_gross_and_net_totals_differ(spark):
    data = spark.createDataFrame([(2, 25.0, 5.0, 3.0, 0.0, 48.0, "NEW", "PAID")], NET)
    both = RuleSet((packs.gross_total_matches(), packs.net_total_matches()))
    assert quality.validate(data, both).first()["rule_results"] == ["total_amount_calculation_valid"]


def test_dataset_score_and_stamp(scenarios, rows):
    rules = RuleSet((Rule("positive", "quantity > 0"), Rule("exact", "total_amount = quantity * unit_price")))
    [record] = rows(quality.dashboard_record(scenarios, rules, pipeline="orders"))
    assert (record["total_records"], record["valid_records"], record["status"]) == (4, 2, "FAILED")
    stamped = rows(quality.stamp_dataset_score(scenarios, rules, threshold=0.5))
    assert {row["dataset_score"] for row in stamped} == {0.5}
    assert all(row["dataset_passed"] for row in stamped)
    [empty] = rows(quality.dashboard_record(scenarios.limit(0), rules, pipeline="orders"))
    assert empty["quality_score"] == 0.0


def test_lineage_is_stable(spark):
    first, again, other = spark.range(1).select(
        quality.lineage("p", 1).alias("a"), quality.lineage("p", 1).alias("b"), quality.lineage("p", 2).alias("c")
    ).first()
    assert first == again != other


def test_only_text_can_be_blank(spark):
    made = spark.sql(
        "SELECT * FROM VALUES ('a', X'41', TIMESTAMP '2024-01-01 00:00:00', 1.5), (' ', X'20', NULL, NULL)"
        " AS t(text, bytes, moment, amount)"
    )
    names = made.columns
    checked = made.select(*(checks.not_empty(name).alias(name) for name in names))
    assert [tuple(row) for row in checked.collect()] == [(True,) * 4, (False,) * 4]
    plan = made.select(checks.not_empty("moment").alias("there"))._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(" not in plan
