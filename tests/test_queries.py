"""Every registered query outside larder.llm against its oracle SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from larder.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def shown(value):
    if isinstance(value, (list, tuple)) or hasattr(value, "tolist") and getattr(value, "ndim", 0):
        return str(list(value))
    if pd.isna(value):
        return "null"
    if isinstance(value, bool) or type(value).__name__ == "bool":
        return str(bool(value))
    try:
        return f"{float(value):.9g}"
    except (TypeError, ValueError):
        return str(value)


def rows(frame, columns):
    return sorted(tuple(map(shown, r)) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name in registry.ORACLE_SQL:
        want = duck.execute(registry.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got, sorted(got.columns)) == rows(want, sorted(got.columns))
    else:
        assert len(got.columns) > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
