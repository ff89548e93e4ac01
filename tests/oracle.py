"""Side-by-side comparison of a Spark result with the SQL oracle."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

from branchledger.trial.inputs import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(x):
    if x is None:
        return None
    if isinstance(x, float):
        return "nan" if x != x else x + 0.0
    if isinstance(x, bool):
        return int(x)
    if isinstance(x, (int, Decimal)):
        return float(x) if isinstance(x, Decimal) else x
    return x


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str):
    """(columns equal?, rows only in Spark, rows only in the oracle, row count)."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    same = sorted(names) == sorted(spark_df.columns)
    return same, got - expected, expected - got, sum(got.values())
