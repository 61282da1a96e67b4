"""Run a registered query and its SQL on the same tables and compare the rows as multisets."""

import datetime
import decimal
from collections import Counter

import duckdb

from queries.fixtures import BASE_TABLES


def _plain(value):
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def oracle_rows(sf_dir, sql):
    con = duck(sf_dir)
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def difference(got, want):
    """Empty if equal, else a short description."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] == want[1]:
        return ""
    extra, lacking = got[1] - want[1], want[1] - got[1]
    return f"{sum(got[1].values())} rows, want {sum(want[1].values())}; extra {list(extra)[:2]}; lacking {list(lacking)[:2]}"
