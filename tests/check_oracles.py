"""Compare every registered query with its SQL on DuckDB.

    python tests/check_oracles.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tablewright.session import session_builder  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _comparable(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    return value


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(type(value)), value if value is not None else 0)
                 for value in row)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_comparable(row[i]) for i in order) for row in rows]
    return sorted(plain, key=_sortable)


def differences(spark, connection, folder: str, name: str) -> str:
    """Empty when names, values and Python types of all rows agree, bit for bit."""
    result = queries()[name](spark, folder)
    got = rows_of(result.columns, result.collect())
    answer = connection.execute(oracle_sql()[name])
    names = [item[0] for item in answer.description]
    want = rows_of(names, answer.fetchall())
    if sorted(result.columns) != sorted(names):
        return f"columns {sorted(result.columns)} against {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    wrong = [
        (g, w) for g, w in zip(got, want) if g != w or list(map(type, g)) != list(map(type, w))
    ]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        session_builder("check_oracles")
        .master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    failed = 0
    for name in sys.argv[2:] or queries():
        start = time.time()
        try:
            if name in oracle_sql():
                note = differences(spark, connection, folder, name)
                verdict = "differs: " + note if note else "same"
            else:
                note = ""
                verdict = f"{queries()[name](spark, folder).count()} rows, no SQL"
        except Exception as error:
            note = verdict = f"failed: {type(error).__name__}: {str(error)[:600]}"
        failed += bool(note)
        print(f"{name:32} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
