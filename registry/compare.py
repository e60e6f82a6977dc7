"""Run registered queries against their SQL in DuckDB and compare the rows.

    python -m registry.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(item) for item in value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(value) for value in row) for row in df.select(*names).collect())


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    return sorted(names), rows


def difference(spark, connection, folder: str, entry) -> str | None:
    """None if query and SQL agree, else what differs."""
    names, rows = spark_rows(entry.query(spark, folder))
    sql_names, expected = sql_rows(connection, entry.sql)
    if names != sql_names:
        return f"columns {sorted(set(names) ^ set(sql_names))}"
    if rows != expected:
        extra, missing = rows - expected, expected - rows
        sample = lambda c: [dict(zip(names, r)) for r in list(c)[:2]]
        return f"{extra.total()} extra {sample(extra)}; {missing.total()} missing {sample(missing)}"
    return None


def main() -> int:
    from registry import ENTRIES
    from touchline.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(ENTRIES)
    spark = local_session(8)
    connection = connect(folder)
    failures = 0
    for name in chosen:
        entry = ENTRIES[name]
        started = time.time()
        try:
            if entry.sql is None:
                found = None if entry.query(spark, folder).count() >= 0 else "?"
                note = "rows only"
            else:
                found, note = difference(spark, connection, folder, entry), "same"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += found is not None
        print(f"{name:32} {time.time() - started:6.2f}s  {found or note}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
