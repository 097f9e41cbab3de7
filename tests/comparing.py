"""Compare a query with its SQL, value by value."""

import math
from collections import Counter
from pathlib import Path

import duckdb


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value + 0.0
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = tuple(columns[i] for i in order)
    return names, Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df):
    return _bag(df.columns, [tuple(row) for row in df.collect()])


def sql_bag(connection, sql):
    cursor = connection.execute(sql)
    return _bag([d[0] for d in cursor.description], cursor.fetchall())


def difference(ours, theirs, show=3):
    """None if equal, otherwise a short description."""
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    extra, missing = ours[1] - theirs[1], theirs[1] - ours[1]
    if not extra and not missing:
        return None
    return (
        f"{sum(ours[1].values())} rows against {sum(theirs[1].values())};"
        f" {sum(extra.values())} extra: {list(extra)[:show]};"
        f" {sum(missing.values())} missing: {list(missing)[:show]}"
    )
