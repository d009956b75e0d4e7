"""Runs a registered query and its SQL over one data folder, for comparison."""

import math
import os

import duckdb

DATA = os.environ.get("DOCFLUX_TESTDATA", "/root/testdata")


def connect(sf_dir):
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for name in os.listdir(sf_dir):
        db.execute(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    return db


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(map(plain, r)) for r in df.select(*cols).collect()), key=repr)


def sql_rows(db, sql):
    done = db.execute(sql)
    names = [x[0] for x in done.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in done.fetchall()), key=repr)
