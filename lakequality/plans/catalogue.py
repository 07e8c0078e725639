"""All registered queries; importing the modules registers them."""

from lakequality.plans import (  # noqa: F401
    bronze,
    incremental,
    layout,
    maintenance,
    monitoring,
    quality,
    reports,
    rules,
    silver,
    streams,
)
from lakequality.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
