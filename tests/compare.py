"""Run registered queries beside their SQL and compare all values.

python -m tests.compare [--sf FOLDER] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def compare(spark, connection, sf_dir: str, build, sql: str | None) -> tuple[str, int]:
    """An empty text when both sides agree, else what differs; and the number of rows."""
    frame = build(spark, sf_dir)
    rows = frame.collect()
    if sql is None:
        return ("" if rows else "no rows"), len(rows)
    cursor = connection.execute(sql)
    types = {column[0]: _KINDS.get(str(column[1]), str(column[1])) for column in cursor.description}
    expected_rows = cursor.fetchall()
    if not rows and not expected_rows:
        return "no rows on both sides", 0
    if set(frame.columns) != set(types):
        return f"columns differ: {sorted(frame.columns)} / {sorted(types)}", len(rows)
    spark_types = dict(frame.dtypes)
    different = {n: (spark_types[n], types[n]) for n in types if spark_types[n] != types[n]}
    names, actual = _rows(frame.columns, rows)
    _, expected = _rows(list(types), expected_rows)
    if actual != expected:
        only_here, only_there = actual - expected, expected - actual
        return (
            f"{len(rows)} / {len(expected_rows)} rows; {sum(only_here.values())} differ\n"
            f"  columns {names}\n  spark   {list(only_here)[:3]}\n  sql     {list(only_there)[:3]}"
        ), len(rows)
    return (f"types differ: {different}" if different else ""), len(rows)


def main() -> int:
    from lakequality import get_session
    import __spark_entry__

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.001")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark = get_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(options.sf)
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    bad = 0
    for name in options.names or queries:
        started = time.time()
        try:
            verdict, rows = compare(
                spark, connection, options.sf, queries[name], oracles.get(name)
            )
        except Exception as error:
            verdict, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += bool(verdict)
        kind = "ok" if not verdict else "DIFF"
        kind += "" if name in oracles else " (rows only)"
        print(f"{name:28s} {rows:7d} {time.time() - started:6.2f}s {kind} {verdict}", flush=True)
    print(f"{bad} differ")
    return bool(bad)


if __name__ == "__main__":
    sys.exit(main())
