import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def same_as_sql(spark, data):
    """A check that a query's rows are those of its SQL in DuckDB."""
    import glob

    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")

    def plain(frame):
        columns = sorted(frame.columns)
        value = lambda v: "null" if v is None or v != v else repr(round(v, 9)) if isinstance(v, float) else str(v)
        return columns, sorted(map(tuple, frame[columns].map(value).values.tolist()))

    def check(query, sql):
        assert plain(query(spark, data).toPandas()) == plain(con.execute(sql).df())

    return check
