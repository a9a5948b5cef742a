"""Run a registered query and its SQL over one data folder and compare all rows."""

import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    columns = sorted(df.columns)
    return sorted(map(tuple, df[columns].astype(object).where(df[columns].notna(), None).values.tolist()), key=repr)


def compare(spark, query, sql, sf=SF):
    db = duckdb.connect()
    for t in TABLES:
        at = f"{sf}/{t}.parquet"
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at + '/*.parquet' if os.path.isdir(at) else at}'")
    got, want = query(spark, sf).toPandas(), db.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
