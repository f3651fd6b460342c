import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(small):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{small}/{t}.parquet')")
    return con


def canonical(df):
    """A pandas table's rows, columns by name, in an order of their own."""
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or (isinstance(v, float) and v != v) or str(v) in ("<NA>", "NaT"):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float):
            return round(v, 8)
        return tuple(map(cell, v)) if isinstance(v, (list, tuple)) else v

    return sorted((tuple(map(cell, r)) for r in df.itertuples(index=False, name=None)), key=repr)
