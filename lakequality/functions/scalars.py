"""Row-level building blocks for shaping Bronze and Silver rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parsing states and the texts stored beside them.
PARSE_SUCCESS = "SUCCESS"
PARSE_PARTIAL = "PARTIAL"
PARSE_FAILED = "FAILED"
PARSE_FAILED_TEXT = "JSON parsing completely failed"
PARSE_PARTIAL_TEXT = "Some required fields missing from JSON"

# Quantity above which a discount applies, with the middle of its rate range.
DISCOUNT_TIERS = ((50, 0.125), (20, 0.075), (10, 0.035))
# Order value above which an order is urgent or of raised priority, or ships free.
PRIORITY_TIERS = ((5000, "HIGH"), (1000, "NORMAL"))
PRIORITY_DEFAULT = "LOW"
FREE_SHIPPING_ABOVE = 500


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left | right, conditions)


def ladder(value: Column, steps: Sequence[tuple], default, *, inclusive: bool = False) -> Column:
    """First step whose bound lies below `value` (or equals it), else `default`."""
    branch = F
    for bound, result in steps:
        branch = branch.when(value >= bound if inclusive else value > bound, F.lit(result))
    return branch.otherwise(F.lit(default))


def epoch_text(moment: Column) -> Column:
    return F.unix_timestamp(moment).cast("string")


def left_pad(column: Column, width: int) -> Column:
    """Zero padding that never cuts longer text."""
    text = column.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def date_parts(moment: Column) -> dict[str, Column]:
    """Zero-padded year, month, day and hour, as used in partition paths."""
    return {
        name: F.date_format(moment, pattern)
        for name, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))
    }


def parsing_status(required: Sequence[str], any_present: Sequence[str]) -> Column:
    present = lambda cols: [F.col(c).isNotNull() for c in cols]
    return (
        F.when(all_of(present(required)), PARSE_SUCCESS)
        .when(any_of(present(any_present)), PARSE_PARTIAL)
        .otherwise(PARSE_FAILED)
    )


def parsing_errors(status: Column) -> Column:
    return (
        F.when(status == PARSE_FAILED, F.array(F.lit(PARSE_FAILED_TEXT)))
        .when(status == PARSE_PARTIAL, F.array(F.lit(PARSE_PARTIAL_TEXT)))
        .otherwise(F.array().cast("array<string>"))
    )


def surrogate_event_id(event_id: Column, city: Column, moment: Column) -> Column:
    """Missing ids become `<city or unknown>-<epoch seconds>`."""
    generated = F.concat(F.coalesce(city, F.lit("unknown")), F.lit("-"), epoch_text(moment))
    return F.coalesce(event_id, generated)


def surrogate_order_id(order_id: Column, moment: Column, source_id: Column | None = None) -> Column:
    """Missing ids become `ORD-<epoch seconds>`.

    Rows of one second would collide, so a digest of the source record is added when given.
    """
    generated = F.concat(F.lit("ORD-"), epoch_text(moment))
    if source_id is not None:
        generated = F.concat(generated, F.lit("-"), F.substring(F.sha2(source_id, 256), 1, 12))
    return F.coalesce(order_id, generated)


def fiscal_quarter(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day), F.lit("-"), F.year(day))


def net_amount(
    quantity: Column, price: Column, discount: Column, tax: Column, shipping: Column
) -> Column:
    return F.round(quantity * price - discount + tax + shipping, 2)


def discount_rate(quantity: Column) -> Column:
    return ladder(quantity, DISCOUNT_TIERS, 0.0)


def priority(amount: Column) -> Column:
    return ladder(amount, PRIORITY_TIERS, PRIORITY_DEFAULT)


def sanitize(text: Column, max_length: int = 255) -> Column:
    """Drop characters usable for injection, cut, then trim."""
    return F.trim(F.left(F.regexp_replace(text, "[<>&\"'`]", ""), F.lit(max_length)))


def partition_key(text: Column) -> Column:
    return F.lower(F.replace(text, F.lit(" "), F.lit("")))


def on_day(time: Column, as_of: Column) -> Column:
    """Whether a time lies on the day of `as_of`, up to that moment."""
    return (time >= F.date_trunc("day", as_of)) & (time <= as_of)


def within_hours(time: Column, as_of: Column, hours: int = 1) -> Column:
    """Whether a time lies in the last hours before `as_of`, which counts."""
    return (time >= as_of - F.make_interval(hours=F.lit(hours))) & (time <= as_of)
