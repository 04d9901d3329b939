"""Every registered query of the dataflow operators against its SQL."""

import os

import duckdb
import pytest

from braidflow.plans import catalogue


def canonical(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    plain = lambda x: str(int(x)) if isinstance(x, float) and x == int(x) else str(x)
    return sorted(tuple(map(plain, row)) for row in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf_dir, oracle, name):
    got = catalogue.QUERIES[name](spark, sf_dir).toPandas()
    if name not in catalogue.ORACLES:
        assert len(got)
        return
    want = oracle.sql(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
