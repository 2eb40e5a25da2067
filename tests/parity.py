"""Compares registered queries with their SQL. Run: python tests/parity.py [names]"""

from __future__ import annotations

import collections
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _value(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
             "boolean": "BOOLEAN"}


def type_differences(df, connection, sql: str) -> list[str]:
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {row[0]: row[1] for row in described}
    ours = {f.name: SQL_TYPES.get(f.dataType.simpleString(), "?") for f in df.schema}
    return [f"{c}: {ours[c]} vs {theirs.get(c)}" for c in ours if ours[c] != theirs.get(c)]


def compare(df, connection, sql: str) -> str:
    """Empty if columns and the multiset of rows agree, else what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    order = sorted(names)
    expected = collections.Counter(
        tuple(_value(row[names.index(c)]) for c in order) for row in result.fetchall())
    found = collections.Counter(
        tuple(_value(v) for v in row) for row in df.select(*order).collect())
    if expected == found:
        return ""
    extra, lacking = found - expected, expected - found
    return (f"{sum(found.values())} rows vs {sum(expected.values())}; "
            f"extra {list(extra)[:3]}, lacking {list(lacking)[:3]}")


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = make_session()
    connection = connect(sf_dir)
    bad = 0
    wanted = sys.argv[1:] or list(entry.queries())
    for name in wanted:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            problem = compare(df, connection, entry.oracle_sql()[name])
            rows = df.schema.simpleString()
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += bool(problem)
        print(f"{name:24s} {'ok' if not problem else 'DIFF ' + problem} "
              f"{time.time() - start:.1f}s {rows[:150]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
