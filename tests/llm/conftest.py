import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"


def text(v):
    return "~" if v is None else f"{v:.12g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="session")
def agrees(spark):
    """Checks that a frame has the rows of a DuckDB query over named views."""

    def check(df, sql, folder=SF_DIR, **views):
        con = duckdb.connect()
        for t in ("documents", "embeddings", "labels", "conversations"):
            if t in views:
                frame = views[t].toPandas()
                con.register(f"{t}_frame", frame)
                con.execute(f"create view {t} as select * from {t}_frame")
            else:
                con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
        result = con.execute(sql)
        names = [c[0] for c in result.description]
        assert sorted(names) == sorted(df.columns)
        theirs = sorted(tuple(map(text, r)) for r in result.fetchall())
        mine = sorted(tuple(text(r[c]) for c in names) for r in df.collect())
        assert len(mine) == len(theirs)
        for a, b in zip(mine, theirs):
            assert a == b
        return mine

    return check
