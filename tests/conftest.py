import os
import sys
import tempfile

import pytest

from places import DATA, ROOT

sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    work = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.local.dir", f"{work}/local").config("spark.checkpoint.dir", f"{work}/shared").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for name in os.listdir(DATA):
        c.execute(f"create view {name.split('.')[0]} as select * from '{DATA}/{name}'")
    return c


@pytest.fixture(scope="session")
def same(duck):
    """Compares a DataFrame with a SQL twin: columns, rows, values."""

    def check(df, sql):
        got, want = df.toPandas(), duck.execute(sql).df()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns)
        got, want = (x[cols].sort_values(cols, ignore_index=True) for x in (got, want))
        assert len(got) == len(want)
        for c in cols:
            equal = (got[c] == want[c]) | (got[c].isna() & want[c].isna())
            assert equal.all(), (c, got[c][~equal].head().tolist(), want[c][~equal].head().tolist())

    return check
