"""The quality engine: apply rules to every row in one pass, then split, score and count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakequality.functions import scalars
from lakequality.operators.rules import ERROR, WARN, GroupRule, Rule, RuleSet
from lakequality.session import materialize

# Flags, thresholds and texts of the quality columns.
PASS, WARNING, FAIL = "PASS", "WARNING", "FAIL"
THRESHOLD = 0.95
CATEGORY_STEPS = ((0.8, "HIGH"), (0.5, "MEDIUM"))
CATEGORY_DEFAULT = "LOW"
ALL_PASSED = "All rules passed"
BASIC_PASSED = "Basic validation passed"
BASIC_FAILED = "Basic validation failed"
BASIC_SCORE = 0.8
PASSING_SCORE = 0.8
REASON_SEPARATOR = "; "

# Broken rules of a row are kept as bits of BIGINT columns, this many per column.
_BITS = 60
_MASK = "broken_rules_"


def free_name(name: str, taken: Sequence[str]) -> str:
    """The name, with underscores behind it until no column has it."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name += "_"
    return name


class _Broken:
    """The bit columns of one rule set: which rules each row breaks."""

    def __init__(self, rules: RuleSet, taken: Sequence[str]):
        listed = list(rules)
        self.chunks = [listed[i : i + _BITS] for i in range(0, len(listed), _BITS)]
        self.names = [free_name(f"{_MASK}{i}", taken) for i in range(len(self.chunks))]

    def columns(self) -> dict[str, Column]:
        return {
            name: reduce(
                lambda left, right: left + right,
                [
                    F.when(rule.passed(), F.lit(0).cast("bigint")).otherwise(
                        F.lit(1 << bit).cast("bigint")
                    )
                    for bit, rule in enumerate(chunk)
                ],
            )
            for name, chunk in zip(self.names, self.chunks)
        }

    def bits(self):
        """Every rule with the condition that the row breaks it."""
        for name, chunk in zip(self.names, self.chunks):
            for bit, rule in enumerate(chunk):
                yield rule, F.col(name).bitwiseAND(F.lit(1 << bit).cast("bigint")) != 0

    def any(self, criticality: str | None = None) -> Column:
        hits = []
        for name, chunk in zip(self.names, self.chunks):
            mask = sum(
                1 << bit
                for bit, rule in enumerate(chunk)
                if criticality in (None, rule.criticality)
            )
            hits.append(F.col(name).bitwiseAND(F.lit(mask).cast("bigint")) != 0)
        return scalars.any_of(hits)

    def count(self) -> Column:
        return reduce(lambda left, right: left + right, [F.bit_count(name) for name in self.names])

    def listed(self, text) -> Column:
        """The texts of the broken rules, in rule order.

        A filter over a constant array keeps the generated code small however many rules there are.
        """

        def broken_in(name):
            return lambda _, bit: F.getbit(F.col(name), bit) == 1

        parts = [
            F.filter(F.array(*(F.lit(text(rule)) for rule in chunk)), broken_in(name))
            for name, chunk in zip(self.names, self.chunks)
        ]
        return parts[0] if len(parts) == 1 else F.concat(*parts)


def with_groups(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, RuleSet, list[str]]:
    """The rows with what their groups break, rules on these rows alone, and the columns added.

    Rules of the same keys share one aggregate and one join. Groups are counted map-side and only
    those that break a rule are joined back, so a hot key is one row before the join; that side is
    broadcast while it is small, and the adaptive skew join splits hot keys otherwise. Without rules
    on groups nothing is added. The table is read once more for each set of keys.
    """
    by_keys: dict[tuple[str, ...], list[GroupRule]] = {}
    for rule in rules:
        if isinstance(rule, GroupRule):
            by_keys.setdefault(rule.keys, []).append(rule)
    if not by_keys:
        return df, rules, []
    if df.isStreaming:
        raise ValueError("rules on groups need a whole table; apply them to the batches of a stream")
    rows, plain, added = df, {}, []
    chunks = [(keys, group[i : i + _BITS]) for keys, group in by_keys.items() for i in range(0, len(group), _BITS)]
    for k, (keys, members) in enumerate(chunks):
        mask = free_name(f"broken_groups_{k}", rows.columns)
        sides = [free_name(f"group_{k}_{i}", rows.columns) for i in range(len(keys))]
        checks = [F.expr(rule.check) if isinstance(rule.check, str) else rule.check for rule in members]
        bits = [
            F.when(F.coalesce(check, F.lit(rule.on_null == "pass")), 0).otherwise(1 << bit).cast("bigint")
            for bit, (rule, check) in enumerate(zip(members, checks, strict=True))
        ]
        bad = (
            df.groupBy(*(F.col(f"`{key}`") for key in keys))
            .agg(reduce(lambda left, right: left + right, bits).alias(mask))
            .filter(F.col(mask) != 0)
            .select(*(F.col(f"`{key}`").alias(side) for key, side in zip(keys, sides, strict=True)), mask)
        )
        same = [F.col(f"`{key}`").eqNullSafe(F.col(side)) for key, side in zip(keys, sides, strict=True)]
        rows = rows.join(bad, same, "left").drop(*sides)
        added.append(mask)
        lacking = scalars.any_of([F.col(f"`{key}`").isNull() for key in keys])
        for bit, rule in enumerate(members):
            good = F.coalesce(F.col(mask).bitwiseAND(F.lit(1 << bit).cast("bigint")), F.lit(0)) == 0
            if rule.on_null == "pass":
                good = good | lacking
            plain[rule.name] = Rule(rule.name, good, rule.criticality, rule.category, rule.message)
    return rows, RuleSet(tuple(plain.get(rule.name, rule) for rule in rules)), added


def mark_broken(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, _Broken]:
    """Evaluate every rule once; all quality columns derive from the resulting bits."""
    if not len(rules):
        raise ValueError("no rules to apply")
    rows, rules, added = with_groups(df, rules)
    broken = _Broken(rules, rows.columns)
    return rows.withColumns(broken.columns()).drop(*added), broken


def score(failed: Column, total: int, mode: str = "ratio", step: float = 0.2) -> Column:
    """Row score from the number of broken rules.

    ratio: passed / all; binary: 1 or 0; basic: 0.8 or 0; penalty: 1 - step per broken rule.
    """
    if mode == "ratio":
        return (F.lit(total) - failed) / F.lit(total)
    if mode == "binary":
        return F.when(failed == 0, 1.0).otherwise(0.0)
    if mode == "basic":
        return F.when(failed == 0, BASIC_SCORE).otherwise(0.0)
    if mode == "penalty":
        return F.greatest(F.lit(0.0), F.lit(1.0) - failed * F.lit(step))
    raise ValueError(f"unknown score mode: {mode}")


def score_flag(value: Column, least: float = PASSING_SCORE) -> Column:
    """PASS or FAIL by a score alone, however many rules are broken."""
    return F.when(value >= least, PASS).otherwise(FAIL)


def lineage(pipeline: str, batch_id: int | str) -> Column:
    """A lineage id that is the same whenever a batch is replayed."""
    return F.sha2(F.concat_ws(":", F.lit(pipeline), F.lit(str(batch_id))), 256)


def validate(
    df: DataFrame,
    rules: RuleSet,
    *,
    score_mode: str = "ratio",
    warn_is_pass: bool = False,
    coarse: bool = False,
    at: Column | None = None,
    lineage_id: Column | None = None,
) -> DataFrame:
    """Keep every row and add the nine quality columns, in one map-only pass.

    Rules on groups (`rules.unique`) add an aggregate and a join for each set of keys. A broken error rule gives FAIL, broken warn rules alone give WARNING (PASS with
    `warn_is_pass`). `coarse` counts all rules of a row as broken as soon as one of its error rules
    is, and scores 1 or 0.
    """
    total = len(rules)
    marked, broken = mark_broken(df, rules)
    fails, warns = broken.any(ERROR), broken.any(WARN)
    flag = F.when(fails, FAIL).when(warns, PASS if warn_is_pass else WARNING).otherwise(PASS)
    failed = broken.count()
    if coarse:
        failed = F.when(flag == PASS, 0).otherwise(total)
        score_mode = "binary"
    none_broken = ~broken.any()
    return marked.withColumns(
        {
            "quality_flag": flag,
            "failure_reason": F.when(
                ~none_broken,
                F.array_join(broken.listed(lambda rule: rule.text), REASON_SEPARATOR),
            ),
            "rule_results": F.when(none_broken, F.array(F.lit(ALL_PASSED))).otherwise(
                broken.listed(lambda rule: rule.name)
            ),
            "quality_score": score(failed, total, score_mode),
            "validated_at": F.current_timestamp() if at is None else at,
            "lineage_id": F.lit(None).cast("string") if lineage_id is None else lineage_id,
            "criticality": F.when(fails, ERROR).when(warns, WARN),
            "failed_rules": failed,
            "passed_rules": F.lit(total) - failed,
        }
    ).drop(*broken.names)


def validate_basic(df: DataFrame, rules: RuleSet, *, at: Column | None = None) -> DataFrame:
    """All conditions together decide: PASS with 0.8 or FAIL with 0, counted as one rule."""
    marked, broken = mark_broken(df, rules)
    bad = broken.any()
    return marked.withColumns(
        {
            "quality_flag": F.when(bad, FAIL).otherwise(PASS),
            "failure_reason": F.when(
                bad,
                F.concat(
                    F.lit("Validation failed: "),
                    F.array_join(broken.listed(lambda rule: rule.text), REASON_SEPARATOR),
                ),
            ),
            "rule_results": F.array(F.when(bad, BASIC_FAILED).otherwise(BASIC_PASSED)),
            "quality_score": score(bad.cast("int"), 1, "basic"),
            "validated_at": F.current_timestamp() if at is None else at,
            "lineage_id": F.lit(None).cast("string"),
            "criticality": F.lit("basic"),
            "failed_rules": bad.cast("int"),
            "passed_rules": F.lit(1) - bad.cast("int"),
        }
    ).drop(*broken.names)


def rule_flags(df: DataFrame, rules: RuleSet, keep: Sequence[str] = ()) -> DataFrame:
    """One 0/1 column per rule, beside the columns to keep."""
    df, rules, _ = with_groups(df, rules)
    return df.select(*keep, *(rule.passed().cast("int").alias(rule.name) for rule in rules))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("quality_flag") == PASS)


def failed_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("quality_flag") == FAIL)


def with_side(df: DataFrame, rules: RuleSet, name: str = "quarantined") -> DataFrame:
    """Every row with whether it breaks a rule: the partition column of a quarantine split."""
    marked, broken = mark_broken(df, rules)
    return marked.withColumn(name, broken.any()).drop(*broken.names)


def split(df: DataFrame, rules: RuleSet) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the quarantine for the rest.

    Each side reads and checks the input again; `sinks.write_split` checks it once for both.
    """
    side = free_name("quarantined", df.columns)
    sided = with_side(df, rules, side)
    return sided.filter(~F.col(side)).drop(side), sided.filter(F.col(side)).drop(side)


def mean_score(rules: RuleSet) -> Column:
    """The share of rules a row meets, as one expression."""
    return reduce(
        lambda left, right: left + right, [rule.passed().cast("int") for rule in rules]
    ) / F.lit(len(rules))


def graded_components(
    quantity: str, price: str, total: str, order_id: str, customer_id: str, product_id: str
) -> dict[str, Column]:
    """Graded scores: arithmetic of the total, presence of ids, and positive figures."""
    gap = F.abs(F.col(quantity) * F.col(price) - F.col(total))
    filled = [F.col(name) != "" for name in (order_id, customer_id, product_id)]
    return {
        "financial_score": F.when(gap <= 0.01, 1.0).when(gap <= 0.1, 0.8).otherwise(0.0),
        "completeness_score": F.when(scalars.all_of(filled), 1.0)
        .when(scalars.any_of(filled[:2]), 0.5)
        .otherwise(0.0),
        "business_score": F.when((F.col(quantity) > 0) & (F.col(price) > 0), 1.0).otherwise(0.0),
    }


def category(value: Column) -> Column:
    return scalars.ladder(value, CATEGORY_STEPS, CATEGORY_DEFAULT, inclusive=True)


def rule_failures(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Rows checked and failed per rule: one aggregate over the bits, turned into rows."""
    marked, broken = mark_broken(df, rules)
    listed = list(broken.bits())
    wide = marked.agg(
        F.count(F.lit(1)).alias("checked"),
        *(F.count_if(hit).alias(rule.name) for rule, hit in listed),
    )
    entries = F.array(
        *(
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.category).alias("category"),
                F.lit(rule.criticality).alias("criticality"),
                F.col(rule.name).alias("failed"),
            )
            for rule, _ in listed
        )
    )
    return wide.select("checked", F.inline(entries)).select(
        "rule", "category", "criticality", "checked", "failed"
    )


def rule_summary(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Per category and criticality: how many rules there are and how often they were broken."""
    return (
        rule_failures(df, rules)
        .groupBy("category", "criticality")
        .agg(
            F.count(F.lit(1)).alias("rules"),
            F.sum("checked").alias("checks"),
            F.sum("failed").alias("failures"),
        )
    )


def dataset_score(df: DataFrame, rules: RuleSet) -> DataFrame:
    """One row: how many rows meet all critical rules, as counts and as a share."""
    marked, broken = mark_broken(df, rules)
    valid = ~broken.any(ERROR)
    return marked.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(valid).alias("valid_records"),
    ).withColumns(
        {
            "invalid_records": F.col("total_records") - F.col("valid_records"),
            "quality_score": F.coalesce(
                F.try_divide("valid_records", "total_records"), F.lit(0.0)
            ),
        }
    )


def mark_valid(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Every row with whether it meets all critical rules, as `is_valid`."""
    marked, broken = mark_broken(df, rules)
    return marked.withColumn("is_valid", ~broken.any(ERROR)).drop(*broken.names)


def stamp_dataset_score(
    df: DataFrame, rules: RuleSet, *, threshold: float = THRESHOLD, at: Column | None = None
) -> DataFrame:
    """Per-row validity, with the score of the whole dataset beside it.

    The score needs all rows before the first can have it, so the marked rows are written down once.
    It is a scalar subquery over one stored column: one value handed to all tasks, no join.
    """
    marked = materialize(mark_valid(df, rules), "marked")
    score = F.try_divide(F.count_if("is_valid"), F.count(F.lit(1)))
    total = marked.agg(F.coalesce(score, F.lit(0.0)).alias("score")).scalar()
    return marked.withColumns(
        {"dataset_score": total, "validated_at": F.current_timestamp() if at is None else at}
    ).withColumn("dataset_passed", F.col("dataset_score") >= threshold)


def dashboard_record(
    df: DataFrame, rules: RuleSet, *, pipeline: str, threshold: float = THRESHOLD
) -> DataFrame:
    """The one-row record a dashboard shows: counts, share, threshold and PASSED or FAILED."""
    return dataset_score(df, rules).select(
        F.lit(pipeline).alias("pipeline"),
        "total_records",
        "valid_records",
        "invalid_records",
        "quality_score",
        (F.col("quality_score") * 100).alias("quality_percentage"),
        F.lit(threshold).alias("threshold"),
        F.lit(len(rules)).alias("rules_count"),
        F.when(F.col("quality_score") >= threshold, "PASSED").otherwise("FAILED").alias("status"),
    )


def error_map(checks: Mapping[str, Sequence[tuple[Column, str]]]) -> Column:
    """Field name to message, for the fields in error; the first broken check names the error."""

    def message(listed):
        return F.coalesce(
            *(F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for ok, text in listed)
        )

    messages = F.map_from_arrays(
        F.array(*(F.lit(name) for name in checks)),
        F.array(*(message(listed) for listed in checks.values())),
    )
    return F.map_filter(messages, lambda _, text: text.isNotNull())


# Formats and texts for orders that arrive as text.
INPUT_FORMATS = {
    "order_id": (r"^ORD-\d{6}$", "Invalid order ID format"),
    "product_id": (r"^PROD-\w{3,10}$", "Invalid product ID format"),
}
INPUT_NUMBERS = {
    "quantity": ("int", "Quantity must be a valid integer", "Quantity must be positive"),
    "unit_price": ("double", "Unit price must be a valid number", "Unit price must be positive"),
}


def order_input_errors() -> Column:
    """Errors of an order received as text: missing, wrongly formed or not positive."""

    def present(name):
        return F.col(name).isNotNull(), f"{name} is required"

    checks = {
        name: [present(name), (F.col(name).rlike(pattern), text)]
        for name, (pattern, text) in INPUT_FORMATS.items()
    }
    for name, (kind, unreadable, not_positive) in INPUT_NUMBERS.items():
        number = F.col(name).try_cast(kind)
        checks[name] = [
            present(name),
            (number.isNotNull(), unreadable),
            (number > 0, not_positive),
        ]
    return error_map(checks)
