"""Runs a query and its SQL over the same tables."""

import datetime
import os

import duckdb


def shown(x):
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return repr(round(x, 9)) if isinstance(x, float) else str(x)


def compare(spark, directory, query, sql):
    df = query(spark, directory)
    columns = sorted(df.columns)
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in os.listdir(directory):
        con.sql(f"create view {t.removesuffix('.parquet')} as select * from '{directory}/{t}'")
    relation = con.sql(sql)
    assert sorted(relation.columns) == columns
    wanted = con.sql(f"select {', '.join(f'"{c}"' for c in columns)} from ({sql})").fetchall()
    got = df.select(*columns).collect()
    assert sorted(tuple(map(shown, r)) for r in got) == sorted(tuple(map(shown, r)) for r in wanted)
