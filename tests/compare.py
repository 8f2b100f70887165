"""Registered query against its SQL: same columns, same rows in any order."""

from __future__ import annotations

import math

import duckdb

from annexport.plans.oracles import ORACLES
from annexport.plans.queries import QUERIES, TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return round(value, 9) if not math.isnan(value) else "nan"
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(repr(tuple(_cell(r[i]) for i in order)) for r in rows)


def spark_result(spark, name, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def oracle_result(con, name):
    cur = con.execute(ORACLES[name])
    return canonical([d[0] for d in cur.description], cur.fetchall())
