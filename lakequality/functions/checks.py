"""Checks: functions that return a boolean column saying whether a row is good."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats shared by the rule sets.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE = r"^\d{3}-\d{3}-\d{4}$"
TIMESTAMP_TEXT = r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"


def moment(as_of: datetime | str | None) -> Column:
    """The reference time of a run: now, unless given."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else F.lit(as_of)


def exact(number: float | int) -> Column:
    """A literal that compares exactly with decimal columns and cheaply with integer ones."""
    return F.lit(number if isinstance(number, int) else Decimal(str(number)))


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def not_empty(column: str) -> Column:
    """Neither null nor blank.

    Only text can be blank; the type is known when the query is planned, so numbers and times are not
    turned into text for each row.
    """
    value = F.col(column)
    is_text = F.typeof(value).rlike("^(string|binary|char|varchar|variant)")
    return value.isNotNull() & (~is_text | (F.trim(value.cast("string")) != ""))


def sql(condition: str) -> Column:
    return F.expr(condition)


def equals(column: str, expression: str, tolerance: float = 0.01) -> Column:
    return F.abs(F.col(column) - F.expr(expression)) <= exact(tolerance)


def greater_than(column: str, bound) -> Column:
    return F.col(column) > exact(bound)


def at_least(column: str, bound) -> Column:
    return F.col(column) >= exact(bound)


def at_most(column: str, bound) -> Column:
    return F.col(column) <= exact(bound)


def between(column: str, low, high) -> Column:
    return F.col(column).between(exact(low), exact(high))


def matches(column: str, pattern: str) -> Column:
    return F.col(column).rlike(pattern)


def one_of(column: str, values: Sequence) -> Column:
    return F.col(column).isin(list(values))


def not_after(column: str, as_of: datetime | str | None = None) -> Column:
    return F.col(column) <= moment(as_of)


def not_after_column(column: str, other: str) -> Column:
    return F.col(column) <= F.col(other)


def length_between(column: str, low: int, high: int | None = None) -> Column:
    size = F.length(F.col(column))
    return size >= low if high is None else size.between(low, high)


def share_of(column: str, whole: str, share: float) -> Column:
    """Not negative and at most `share` of another column."""
    return (F.col(column) >= 0) & (F.col(column) <= F.col(whole) * exact(share))


def allowed_pairs(column: str, other: str, pairs: Sequence[tuple[Sequence, Sequence]]) -> Column:
    """The two columns hold one of the allowed combinations."""
    allowed = F.lit(False)
    for left, right in pairs:
        allowed = allowed | (F.col(column).isin(list(left)) & F.col(other).isin(list(right)))
    return allowed


def forbidden_pairs(column: str, other: str, pairs: Sequence[tuple[str, str]]) -> Column:
    """None of the listed combinations; an unknown value cannot form one."""
    clash = F.lit(False)
    for left, right in pairs:
        both = (F.col(column) == left) & (F.col(other) == right)
        clash = clash | F.coalesce(both, F.lit(False))
    return ~clash
