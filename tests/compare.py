"""Hold a Spark result against DuckDB's."""

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if pd.isna(v):
        return "null"
    if isinstance(v, str) or type(v).__name__.startswith("bool"):
        return str(v)
    return f"{round(float(v), 6) + 0.0:.6f}"


def rows(df: pd.DataFrame, columns) -> list:
    return sorted(map(tuple, df[columns].astype(object).map(_plain).itertuples(index=False)))


def assert_same(spark_df, con, sql):
    a, b = spark_df.toPandas(), con.execute(sql).fetchdf()
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert rows(a, columns) == rows(b, columns)
