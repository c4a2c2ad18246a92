import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def rows_of(rows, names):
    """Rows as sorted tuples of text, by column name."""
    order = sorted(range(len(names)), key=names.__getitem__)
    show = lambda x: "NULL" if x is None else f"{x:.5f}" if isinstance(x, float) else str(x)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def same(spark, duck):
    def check(df, sql):
        got = duck.sql(sql)
        assert sorted(df.columns) == sorted(got.columns)
        assert rows_of(df.collect(), df.columns) == rows_of(got.fetchall(), got.columns)

    return check
