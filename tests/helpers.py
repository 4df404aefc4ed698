"""Comparing a query with its SQL, and making tables that hold the awkward cases."""

import os
from collections import Counter

import duckdb


def connect(d):
    c = duckdb.connect()
    for n in sorted(os.listdir(d)):
        p = f"{d}/{n}"
        c.execute(f"create view {n[:-8]} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def bag(df):
    def text(x):
        if x is None or x != x:
            return "null"
        return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

    cols = sorted(df.columns)
    return cols, Counter(tuple(text(v) for v in r) for r in df[cols].astype(object).values.tolist())


def same(spark_df, sql_df):
    a, b = bag(spark_df.toPandas()), bag(sql_df)
    assert a[0] == b[0]
    assert a[1] == b[1], (list((a[1] - b[1]).items())[:3], list((b[1] - a[1]).items())[:3])


def clashing(df):
    """The table with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = "t k part row fps vals stretch own level factor stated rank bucket vertex label group_id tokens copies __ep pos".split()
    return df.select("*", *(F.lit("x").alias(n) for n in names if n not in df.columns))
