"""Compare registered queries with their SQL: ``python tests/compare.py [folder] [name ...]``.

``COMPARE_CONF="key=value key=value"`` sets further session settings, such as
other partition counts or no broadcasts.
"""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import registered  # noqa: E402
from starloom import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return value
    if isinstance(value, (float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else int(number) if number == int(number) else number
    return str(value)


def canonical(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    frame = registered.QUERIES[name](spark, folder)
    rows = frame.collect()
    if name not in registered.SQL:
        return None if rows else "no rows"
    answer = connection.execute(registered.SQL[name])
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    mine, theirs = canonical(frame.columns, rows), canonical(names, answer.fetchall())
    if mine == theirs:
        return None
    odd = next(((a, b) for a, b in zip(mine, theirs) if a != b), None)
    return f"{len(mine)} rows against {len(theirs)}; first difference {odd}"


def main() -> int:
    registered.load_all()
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registered.QUERIES)
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    for setting in os.environ.get("COMPARE_CONF", "").split():
        spark.conf.set(*setting.split("=", 1))
    connection = database(folder)
    bad = 0
    for name in names:
        started = time.time()
        try:
            problem = difference(spark, connection, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - started:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
