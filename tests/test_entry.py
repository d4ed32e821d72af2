"""Driver contract: entry() smoke, registry/oracle consistency, and every registered query
against its DuckDB oracle on sf0.001 (same comparison as the driver: names, rows, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return "None" if v is None else str(v)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["src_table", "user_id", "amount", "doc", "note"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    """All but the training-data operators, which their own tests hold against plain versions."""
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert not [n for n in set(q) - set(o) if n != "pipeline" and not n.startswith("op")]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(norm(r[c]) for c in cols) for r in sdf.collect())
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = {c: i for i, c in enumerate(dcols)}
    drows = sorted(tuple(norm(r[idx[c]]) for c in cols) for r in res.fetchall())
    assert srows == drows
