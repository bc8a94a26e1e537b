"""Every registered query against its SQL, over whole tables."""

import duckdb
import pytest

from quillgraph import registry

from .conftest import same_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in "nation customer supplier part orders lineitem documents".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows(spark, db, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), db.execute(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert same_rows(got, want, sorted(got.columns))
