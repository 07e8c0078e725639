"""Casts of payload text that yield NULL instead of failing under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column


def safe_cast(column: Column, type_name: str) -> Column:
    """Text to `type_name`, NULL where it does not fit.

    Whole numbers go through DOUBLE so that `5.0` counts as 5, as a lenient cast would have it.
    """
    if type_name in ("int", "bigint"):
        return column.try_cast("double").try_cast(type_name)
    return column if type_name == "string" else column.try_cast(type_name)
