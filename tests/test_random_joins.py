"""Joins and groups over random small tables against plain Python."""

import itertools

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from braidflow.operators import joins
from braidflow.operators.grouping import group_by

KEYS = st.one_of(st.none(), st.integers(0, 3))
TABLE = st.lists(st.tuples(KEYS, st.integers(0, 9)), max_size=6)
RANDOM = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def plain_full(tables):
    out = []
    keys = {k for t in tables for k, _ in t}
    for k in keys:
        sides = [[r for r in t if r[0] == k] or [None] for t in tables]
        out += [(k, *row) for row in itertools.product(*sides)]
    return out


@RANDOM
@given(tables=st.lists(TABLE, min_size=2, max_size=4), flags=st.lists(st.booleans(), min_size=4, max_size=4))
def test_cogroup(spark, tables, flags):
    must = flags[: len(tables)]
    inputs = {chr(97 + i): spark.createDataFrame(t, "k int, v int") for i, t in enumerate(tables)}
    got = joins.cogroup(inputs, "k", must, flags=True)
    rows = []
    for r in got.collect():
        sides = [((r[f"{n}_k"], r[f"{n}_v"]) if r[f"{n}_present"] else None) for n in inputs]
        rows.append((r["_key_0"], *sides))
    want = [x for x in plain_full(tables) if all(s is not None or not m for s, m in zip(x[1:], must, strict=True))]
    assert sorted(rows, key=str) == sorted(want, key=str)


@RANDOM
@given(tables=st.lists(TABLE, min_size=2, max_size=3), left=st.booleans())
def test_hash_join(spark, tables, left):
    inputs = {chr(97 + i): spark.createDataFrame(t, "k int, v int") for i, t in enumerate(tables)}
    got = [tuple(r) for r in joins.hash_join(inputs, "k", "left" if left else "inner").select(*[f"{n}_v" for n in inputs]).collect()]
    want = [tuple(None if s is None else s[1] for s in x[1:]) for x in plain_full(tables) if x[1] is not None and (left or None not in x[2:])]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.fixture
def tiny_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@RANDOM
@given(rows=TABLE)
def test_buffer_over_many_batches(spark, tiny_batches, rows):
    def f(key, frames):
        whole = [v for x in frames for v in x.v]
        yield pd.DataFrame({"k": [key[0]], "vs": [",".join(map(str, whole))]})

    got = {r.k: r.vs for r in group_by(spark.createDataFrame(rows, "k int, v int"), "k", ["v"]).buffer(f, "k int, vs string").collect()}
    want = {k: ",".join(str(v) for _, v in sorted(r for r in rows if r[0] == k)) for k in {k for k, _ in rows}}
    assert got == want


@RANDOM
@given(tables=st.lists(TABLE, min_size=2, max_size=3))
def test_buffer_join_over_many_batches(spark, tiny_batches, tables):
    def f(key, first, others):
        sides = [sorted(v for x in first for v in x.v), *[sorted(x.v) for x in others]]
        yield pd.DataFrame({"k": [key[0]], "vs": ["|".join(",".join(map(str, s)) for s in sides)]})

    inputs = {chr(97 + i): spark.createDataFrame(t, "k int, v int") for i, t in enumerate(tables)}
    got = {r.k: r.vs for r in joins.buffer_join(inputs, "k", f, "k int, vs string").collect()}
    want = {k: "|".join(",".join(str(v) for v in sorted(v for x, v in t if x == k)) for t in tables) for k in {k for t in tables for k, _ in t}}
    assert got == want
