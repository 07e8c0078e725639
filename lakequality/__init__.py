"""Event-to-lakehouse tables with data quality, written as plain DataFrame functions."""

from lakequality.session import get_session, materialize, work_dir

__all__ = ["get_session", "materialize", "work_dir"]
