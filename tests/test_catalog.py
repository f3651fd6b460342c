"""Every query of the library against its SQL twin, on the smallest tables."""

import pytest

from conftest import canonical
from corpusmill.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, small, name):
    got = catalog.queries()[name](spark, small).toPandas()
    assert len(got)
    if name in catalog.oracle_sql():
        want = duck.execute(catalog.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canonical(got) == canonical(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_identifiers_at_the_ends(spark, tmp_path):
    """Texts that end in numbers; the query's SQL knows no ISBN, and its $ is the very end."""
    import duckdb

    texts = ["call 1210290012", "ISBN 9781234567897", "2401.10001", "10.1234/ab", "10.1234/aſK end", "doi:\x0b10.1234/ab", None]
    spark.createDataFrame([(i * 4 + 2, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = catalog.queries()["identifiers"](spark, str(tmp_path)).toPandas()
    assert canonical(got) == canonical(con.execute(catalog.oracle_sql()["identifiers"]).df())
