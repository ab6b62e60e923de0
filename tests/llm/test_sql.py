"""The queries that SQL can express give the rows of their SQL."""

import duckdb
import pytest

from tickspark.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_sql(spark, sf_dir, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want, got = c.sql(oracle.SQL[name]).df(), queries.QUERIES[name](spark, sf_dir).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(got[columns].itertuples(index=False, name=None)) == sorted(want[columns].itertuples(index=False, name=None))
