"""Run registered queries beside their SQL and compare rows.

    python tests/compare.py [folder] [name-part ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return ("nan",)
    if value is None:
        return ("null",)
    return (type(value).__name__, value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def difference(frame, connection, sql: str) -> str | None:
    """None when both sides agree in names, types and values."""
    described = {row[0]: TYPES.get(row[1], row[1]) for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    if described != dict(frame.dtypes):
        return f"types {sorted(dict(frame.dtypes).items())} against {sorted(described.items())}"
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    theirs = _rows(names, result.fetchall())
    ours = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} against {b}"
    return None


def main(arguments: list[str]) -> int:
    import __spark_entry__ as entry
    from threatlens.session import build_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:]
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if wanted and not any(part in name for part in wanted):
            continue
        started = time.time()
        try:
            frame = build(spark, sf_dir)
            problem = difference(frame, connection, sql[name]) if name in sql else None
            rows = "" if name in sql else f" rows={frame.count()}"
        except Exception as error:  # report and go on
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", ""
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok ' if name in sql else 'run'} {time.time() - started:6.2f}s {name}{rows} {problem or ''}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
