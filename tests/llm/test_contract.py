import __spark_entry__ as E
import duckdb
import pytest

SF = "/root/testdata/sf0.001"


def test_one_query_an_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if n.startswith("op")))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = E.queries()[name](spark, SF)
    sql = con.sql(E.oracle_sql()[name])
    assert sorted(got.columns) == sorted(sql.columns)
    cols = sorted(got.columns)
    rows = lambda it: sorted(map(repr, it))
    assert rows(tuple(r) for r in got.select(*cols).collect()) == rows(con.sql(f"SELECT {', '.join(cols)} FROM ({E.oracle_sql()[name]})").fetchall())
