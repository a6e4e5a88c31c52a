"""Runs a registered query on Spark and its SQL on DuckDB and compares whole results."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.9g}") + 0.0
    if isinstance(value, decimal.Decimal):
        return float(f"{float(value):.9g}") + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(found, key=repr)


SAME_KIND = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def compare(spark, con, sf_dir: str, query) -> list[str]:
    """Differences; empty if the results agree."""
    df = query.run(spark, sf_dir)
    names, got = rows_of(df.columns, df.collect())
    cursor = con.execute(query.sql)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    wanted_names, wanted = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    problems = []
    if names != wanted_names:
        return [f"columns {names} != {wanted_names}"]
    for name, kind in df.dtypes:
        expected = SAME_KIND.get(kind)
        if expected and kinds[name] != expected:
            problems.append(f"type of {name}: {kind} against {kinds[name]}")
    if len(got) != len(wanted):
        problems.append(f"rows {len(got)} != {len(wanted)}")
    if got != wanted:
        differing = [(a, b) for a, b in zip(got, wanted) if a != b][:3]
        problems.append(f"values differ, e.g. {differing}")
    return problems
