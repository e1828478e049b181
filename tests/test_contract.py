import math

import duckdb
import pytest

import __spark_entry__ as E
from stormlake.catalog import REGISTRY
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["city_id", "year", "count", "count_moving_average_sma",
                          "count_moving_average_ema"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    if isinstance(v, float):
        return repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_norm, v)) + "]"
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def _rows(rows):
    return sorted("|".join(map(_norm, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REGISTRY.items() if sql))
def test_query_equals_its_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _rows(tuple(r) for r in df.select(*cols).collect())
    cur = duck.execute(REGISTRY[name][1])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == _rows(tuple(r[i] for i in order) for r in cur.fetchall())
