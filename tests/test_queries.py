"""Every query with SQL gives the rows that DuckDB gives for it."""

import duckdb
import pytest

from docloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    pdf = pdf.where(pdf.notna(), None)
    return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else repr(v) for v in r) for r in pdf.values.tolist())


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, duck, name):
    assert rows(registry.queries()[name](spark, SF).toPandas()) == rows(duck.execute(registry.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
