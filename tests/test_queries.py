"""Every query that has SQL gives the rows that DuckDB gives, on the smallest tables."""

import os

import duckdb
import pytest

from folioframe.plans import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows(names, data):
    def plain(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        return round(v, 6) if isinstance(v, float) else v

    return sorted((tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())
