import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[2]").appName("tests").config("spark.sql.shuffle.partitions", "3").config("spark.driver.memory", "3g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


def plain(v):
    """A value as both engines give it."""
    import decimal

    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list) else v


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())


def duck(sf_dir, tables=None):
    """DuckDB with the driver's tables, or with the given pandas frames in their place."""
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        if tables is None:
            con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def duck_rows(con, sql):
    r = con.sql(sql)
    cols = sorted(r.columns)
    at = [r.columns.index(c) for c in cols]
    return cols, sorted(repr(tuple(plain(x[i]) for i in at)) for x in r.fetchall())
