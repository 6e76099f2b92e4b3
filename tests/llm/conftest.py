import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.fixture()
def rows_like():
    """Compares a Spark result with a DuckDB query by named columns, order aside."""

    def same(df, con, sql):
        got = sorted(tuple(r) for r in df.collect())
        cur = con.execute(f"SELECT {', '.join(df.columns)} FROM ({sql})")
        assert got == sorted(cur.fetchall())
        return got

    return same
