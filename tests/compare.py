"""Row-by-row comparison of a Spark result with the SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (float, Decimal)):
        number = float(value)
        if math.isnan(number):
            return "NaN"
        return int(number) if number.is_integer() and abs(number) < 2**53 else repr(number)
    return value


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None where columns and rows (as multisets) are equal, else what differs."""
    result = con.execute(sql)
    theirs = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(theirs):
        return f"columns {sorted(df.columns)} against {sorted(theirs)}"
    order = sorted(theirs)
    expected = Counter(tuple(_plain(row[theirs.index(c)]) for c in order) for row in result.fetchall())
    found = Counter(tuple(_plain(row[c]) for c in order) for row in df.collect())
    if found == expected:
        return None
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows against {sum(expected.values())}; {sum(extra.values())} unexpected, e.g. "
        f"{[str(x)[:300] for x in list(extra)[:3]]}; missing e.g. {[str(x)[:300] for x in list(missing)[:3]]} (columns {order})"
    )
