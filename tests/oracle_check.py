"""Compare registered queries with their SQL twins; used by the tests and runnable by hand."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{root}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark, root: str, build, statement: str) -> list[str]:
    """Differences between a query and its SQL twin; empty when equal."""
    frame = build(spark, root)
    left = [tuple(row) for row in frame.collect()]
    relation = connect(root).sql(statement)
    right = relation.fetchall()
    problems = []
    types = {name: TYPE_NAMES.get(kind, kind) for name, kind in frame.dtypes}
    other = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    if types != other:
        problems.append(f"schema {types} against {other}")
        if set(types) != set(other):
            return problems
    if len(left) != len(right):
        problems.append(f"rows {len(left)} against {len(right)}")
    a, b = _bag(frame.columns, left), _bag(relation.columns, right)
    if a != b:
        problems.append(f"only left {list((a - b).items())[:3]}, only right {list((b - a).items())[:3]}")
    return problems


def main(root: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from claimlode.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    statements, bad = entry.oracle_sql(), 0
    assert set(statements) <= set(entry.queries()), set(statements) - set(entry.queries())
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in statements:
                problems = compare(spark, root, build, statements[name])
            else:
                print(f"{name}: {build(spark, root).count()} rows, no SQL twin")
                problems = []
        except Exception as error:  # show all queries, not only the first failure
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '}{name} {time.time() - start:.2f}s {str(problems)[:900] if problems else ''}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
