"""The registered operators that SQL can state, against their oracle SQL on the smallest tables."""

import duckdb
import pytest

from larder.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = c.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    shown = lambda r: tuple(f"{x:.6g}" if isinstance(x, float) else str(x) for x in r)
    assert sorted(shown(r) for r in got.select(*columns).collect()) == sorted(map(shown, want.fetchall()))


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 11))
