import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from braidflow import functions as fn
from braidflow.fields import ALL, NONE, RESULTS, FieldError, at_load, resolve, same_shape, typed
from braidflow.operators import joins, rows, sets
from braidflow.operators.grouping import aggregate_by, count_by, group_by, total_sort
from braidflow.operators.traps import trap, trapped_map


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def abc(spark):
    a = spark.sql("select * from values (1, 'a1'), (2, 'a2'), (null, 'an') as t(k, a)")
    b = spark.sql("select * from values (1, 'b1'), (1, 'b1x'), (3, 'b3'), (null, 'bn') as t(k, b)")
    c = spark.sql("select * from values (1, 'c1'), (3, 'c3'), (4, 'c4'), (null, 'cn') as t(k, c)")
    return {"a": a, "b": b, "c": c}


def test_selectors():
    names = ["x", "y", "z"]
    assert resolve(ALL, names) == names and resolve(NONE, names) == [] and resolve(-1, names) == ["z"] and resolve(["z", 0], names) == ["z", "x"]
    for bad in (RESULTS, "w", 3, -4, ["x", "x"], ["x", 0], 1.5):
        with pytest.raises(FieldError):
            resolve(bad, names)


def test_types(spark):
    df = spark.createDataFrame([("1", 2)], "a string, b int")
    assert typed(df, a="int", b="bigint").dtypes == [("a", "int"), ("b", "bigint")]
    with pytest.raises(FieldError):
        typed(df, b="date")
    with pytest.raises(FieldError):
        same_shape(df.schema, spark.createDataFrame([(True, 2)], "a boolean, b int").schema)


def test_unknown_fields_reject_other_lengths(spark):
    lines = spark.createDataFrame([("1\t2",), ("3",)], "line string")
    with pytest.raises(PySparkException, match="expected 2 fields"):
        at_load(lines, ["a", "b"]).collect()


def test_each_output(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows.each(df, c="a + b").columns == ["a", "b", "c"]
    assert rows.each(df, RESULTS, c="a + b").columns == ["c"]
    assert rows.each(df, ["c", 0], c="a + b").columns == ["c", "a"]
    with pytest.raises(FieldError):
        rows.each(df, a="b")
    assert values(rows.replace(df, a="b * 2")) == [(4, 2)]
    with pytest.raises(FieldError):
        rows.rename(df, a="b")
    with pytest.raises(FieldError):
        rows.project(df, NONE)


def test_filters_and_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    assert values(rows.keep(df, "a > 1")) == [(3,)]
    assert values(rows.discard(df, "a > 1")) == [(1,), (None,)]


def test_assertions(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    checked = rows.assert_that(df, "a > 0", "positive")
    for use in (checked.collect, checked.count):
        with pytest.raises(PySparkException, match="positive"):
            use()
    assert rows.assert_that(df, "false", level=rows.Level.STRICT, configured=rows.Level.VALID) is df


def test_debug_only_on_its_level(spark):
    said = []
    df = spark.createDataFrame([(1,)], "a int")
    assert rows.debug(df, "x", show=said.append) is df and not said
    rows.debug(df, "x", configured=rows.Level.STRICT, show=said.append)
    assert "'a': 1" in said[0]


def test_functions(spark):
    df = spark.createDataFrame([("k=12",), ("none",)], "s string")
    assert values(df.select(fn.regex_parser("s", r"k=(\d+)"))) == [("12",), (None,)]
    assert df.where(fn.regex_filter("s", "^k")).count() == 1


def test_merge_is_positional_and_checked(abc, spark):
    assert sets.merge(abc["a"], abc["b"]).columns == ["k", "a"] and sets.merge(abc["a"], abc["b"]).count() == 7
    with pytest.raises(FieldError):
        sets.merge(abc["a"])
    with pytest.raises(FieldError):
        sets.merge(abc["a"], spark.createDataFrame([(True, "x")], "k boolean, a string"))


def test_cogroup_golden(abc):
    ab = {n: abc[n] for n in "ab"}
    inner = values(joins.cogroup(ab, "k").select("a_a", "b_b"))
    assert inner == [("a1", "b1"), ("a1", "b1x"), ("an", "bn")]
    assert joins.cogroup(ab, "k", keys_not_null=True).count() == 2
    full = values(joins.cogroup(abc, "k", "full").select("_key_0", "a_a", "b_b", "c_c"))
    assert full == sorted([(None, "an", "bn", "cn"), (1, "a1", "b1", "c1"), (1, "a1", "b1x", "c1"), (2, "a2", None, None), (3, None, "b3", "c3"), (4, None, None, "c4")], key=str)


@pytest.mark.parametrize("must", [[x & 1 > 0, x & 2 > 0, x & 4 > 0] for x in range(8)])
def test_policies_filter_the_full_join(abc, must):
    full = joins.cogroup(abc, "k", "full", flags=True)
    for n, m in zip("abc", must, strict=True):
        full = full.where(f"{n}_present") if m else full
    assert values(joins.cogroup(abc, "k", must, flags=True)) == values(full)


def test_cogroup_rejects(abc):
    with pytest.raises(FieldError):
        joins.cogroup(abc, NONE, "left")
    with pytest.raises(FieldError):
        joins.cogroup({"a": abc["a"], "b": abc["b"]}, {"a": ["k"], "b": ["k", "b"]})
    with pytest.raises(FieldError):
        joins.cogroup(abc, "k", "outer")
    with pytest.raises(FieldError):
        joins.hash_join(abc, "k", "full")


def test_hash_join_left_is_left_for_all(abc):
    got = values(joins.hash_join(abc, "k", "left").select("a_a", "b_b", "c_c"))
    assert got == sorted([("a1", "b1", "c1"), ("a1", "b1x", "c1"), ("a2", None, None), ("an", "bn", "cn")], key=str)


def test_join_plans(abc):
    ab = {n: abc[n] for n in "ab"}
    assert "BroadcastHashJoin" in plan(joins.hash_join(ab, "k")) and "BroadcastHashJoin" in plan(joins.hash_join(ab, "k", "left"))
    assert "BroadcastExchange" not in plan(joins.hash_join({n: x.hint("merge") for n, x in ab.items()}, "k", limit=0))
    assert "BroadcastNestedLoopJoin" in plan(joins.cross(ab))
    assert joins.cross(ab, limit=0).count() == 12 and "Broadcast" not in plan(joins.cross({n: x.hint("shuffle_replicate_nl") for n, x in ab.items()}, limit=0))


def test_chained_joins_and_groups_share_a_partitioning(abc):
    merge = {n: x.hint("merge") for n, x in abc.items()}
    chain = joins.cogroup(merge, "k", keys_not_null=True)
    assert plan(count_by(chain, "_key_0")).count("Exchange hashpartitioning") == 3
    assert plan(joins.cogroup(merge, "k", "left", keys_not_null=True)).count("Exchange hashpartitioning") == 3


def test_semi_and_anti_match_nulls(abc):
    assert values(joins.semi(abc["a"], abc["b"], "k")) == [(1, "a1"), (None, "an")]
    assert values(joins.semi(abc["a"], abc["b"], "k", anti=True)) == [(2, "a2")]


def test_buffer_join(abc):
    def f(key, first, others):
        yield pd.DataFrame({"k": [key[0]], "n": ["/".join(str(n) for n in [sum(map(len, first)), *map(len, others)])]})

    got = values(joins.buffer_join(abc, "k", f, "k int, n string"))
    assert got == sorted([(None, "1/1/1"), (1, "1/2/1"), (2, "1/0/0"), (3, "0/1/1"), (4, "0/0/1")], key=str)


def test_buffer_join_streams_a_large_first_side(spark):
    left = spark.range(30000).select(F.lit(1).alias("k"), "id")
    right = spark.createDataFrame([(1, "x")], "k int, v string")

    def f(key, first, others):
        sizes = [len(x) for x in first]
        yield pd.DataFrame({"n": [sum(sizes)], "slices": [len(sizes)], "v": [others[0].v.iloc[0]]})

    n, slices, v = joins.buffer_join({"l": left, "r": right}, "k", f, "n long, slices long, v string").first()
    assert (n, v) == (30000, "x") and slices > 1


def test_unread_group_rows_are_skipped(spark):
    df = spark.createDataFrame([(k, i) for k in range(5) for i in range(4)], "k int, i int")
    got = values(group_by(df, "k", ["i"]).buffer(lambda key, frames: pd.DataFrame({"k": [key[0]]}), "k int"))
    assert got == [(k,) for k in range(5)]


def test_groups_and_nulls(abc):
    assert values(count_by(abc["b"], "k")) == sorted([(None, 1), (1, 2), (3, 1)], key=str)
    assert group_by(abc["a"].where("false"), NONE).every(n="count(*)").count() == 0
    with pytest.raises(FieldError):
        group_by(abc["a"], "k").every(k="max(a)")
    with pytest.raises(FieldError):
        group_by(abc["a"], "k").every()


def test_partial_aggregation(abc):
    assert plan(aggregate_by(abc["b"], "k", n="count(*)")).count("HashAggregate") == 2


def test_sort_directions_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (1, 3), (2, 1)], "k int, v int")
    assert values(group_by(df, "k", ["v"]).top(1)) == [(1, None), (2, 1)]
    assert values(group_by(df, "k", [("v", True)]).top(1)) == [(1, 3), (2, 1)]
    assert values(group_by(df, "k", ["v"], reverse=True).top(1)) == [(1, 3), (2, 1)]
    assert values(group_by(df, "k", [("v", True)], reverse=True).top(1)) == [(1, None), (2, 1)]
    assert [r.v for r in total_sort(df, "v").collect()] == [None, 1, 2, 3]
    assert [r.v for r in group_by(df, NONE, ["v"], reverse=True).ordered().collect()] == [3, 2, 1, None]
    assert group_by(df, "k", ["v"]).analytic(n=lambda w: F.row_number().over(w)).where("n = 1").count() == 2


def test_comparator_groups(spark):
    df = spark.createDataFrame([("A", 1), ("a", 2), (None, 3)], "k string, v int")
    assert values(group_by(df, "k", comparators={"k": fn.ignoring_case}).every(s="sum(v)")) == [("A", 3), (None, 3)]
    got = values(group_by(df, "k", ["v"], comparators={"k": fn.ignoring_case}).buffer(lambda key, f: pd.DataFrame({"n": [sum(map(len, f))]}), "n long"))
    assert got == [(1,), (2,)]


def test_traps(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "s string")
    split = trap(df, number="try_cast(s as int) is not null", small="try_cast(s as int) < 5")
    assert values(split.good) == [("1",)] and values(split.bad) == [("x", "number"), (None, "number")]

    def f(row):
        return [{"n": int(row["s"])}] * 2

    split = trapped_map(df, f, "n int")
    assert values(split.good) == [(1,), (1,)]
    assert {(r.s, r.trap_reason.split(":")[0]) for r in split.bad.collect()} == {("x", "ValueError"), (None, "TypeError")}


BIG = 2**60 + 1


def test_whole_numbers_stay_exact_beside_nulls(spark):
    df = spark.createDataFrame([(1, BIG, True), (1, None, None), (2, -BIG, False)], "k int, v long, b boolean")
    same = sorted([(1, BIG, True), (1, None, None), (2, -BIG, False)], key=str)
    schema = "k int, v long, b boolean"
    assert values(rows.opaque(df, lambda frames: frames, schema)) == same
    assert values(group_by(df, "k", ["v"]).buffer(lambda key, frames: frames, schema)) == same
    assert values(trapped_map(df, lambda row: [row], schema).good) == same

    def both(key, first, others):
        yield from first
        yield from others[0]

    for spill in (1, 100):
        assert values(joins.buffer_join({"a": df, "b": df}, "v", both, schema, spill_rows=spill)) == sorted(same * 2, key=str)
    one = joins.custom_join({"a": df, "b": df}, "v", lambda frames: (x[["a_v"]].rename(columns={"a_v": "v"}) for x in frames), "v long")
    assert values(one) == sorted([(BIG,), (None,), (-BIG,)], key=str)


def test_a_side_is_read_as_often_as_asked_for(spark):
    left, right = spark.createDataFrame([(1,)], "k int"), spark.range(1000).select(F.lit(1).alias("k"), "id")

    def f(key, first, others):
        twice = [sum(int(x.id.sum()) for x in others[0]) for _ in range(2)]
        yield pd.DataFrame({"n": [len(others[0])], "a": [twice[0]], "b": [twice[1]], "most": [int(others[0].whole().id.max())]})

    for spill in (10, 10_000):
        assert values(joins.buffer_join({"l": left, "r": right}, "k", f, "n long, a long, b long, most long", spill_rows=spill)) == [(1000, 499500, 499500, 999)]


def test_values_of_other_types_are_trapped(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    split = trapped_map(df, lambda row: [{"n": "x" if row["a"] == 1 else 5}], "n int")
    assert values(split.good) == [(5,)] and [r.a for r in split.bad.collect()] == [1]


def test_names_of_all_kinds(spark):
    df = spark.createDataFrame([(1, 2, 3, 4), (1, 5, 6, 7)], "`a.b` int, `_key_0` int, `_rank` int, `c``d` int")
    assert values(count_by(df, "a.b")) == [(1, 2)] and count_by(df, ["a.b", "c`d"]).columns == ["a.b", "c`d", "count"]
    assert values(group_by(df, "_key_0", comparators={"_key_0": fn.rounded_to(10)}).every(n="count(*)")) == [(2, 2)]
    assert group_by(df, "a.b", [("_rank", True)]).top(1).collect()[0] == (1, 5, 6, 7)
    assert values(group_by(df, "a.b", ["c`d"]).buffer(lambda key, frames: frames, "`a.b` int, `_key_0` int, `_rank` int, `c``d` int")) == [(1, 2, 3, 4), (1, 5, 6, 7)]
    assert values(group_by(df, NONE).every(_all="count(*)")) == [(2,)]
    assert rows.rename(df, **{"a.b": "x"}).columns[0] == "x" and rows.project(df, ["c`d"]).columns == ["c`d"]
    with pytest.raises(FieldError):
        rows.each(df.select(F.lit(1).alias("v")), V="2")
    with pytest.raises(FieldError):
        trap(df, reason="_RANK", x="true")
    with pytest.raises(FieldError):
        group_by(df, "a.b").analytic(_Rank=lambda w: F.row_number().over(w))


def test_join_names(spark):
    left, right = spark.createDataFrame([(1, 2)], "b_c int, present int"), spark.createDataFrame([(1, 2)], "c int, `x.y` int")
    got = joins.cogroup({"a": left, "q": right}, {"a": "b_c", "q": "c"}, "full")
    assert got.columns == ["_key_0", "a_b_c", "a_present", "q_c", "q_x.y"] and values(got) == [(1, 1, 2, 1, 2)]
    for inputs, flags in (({"a": left, "a_b": right}, False), ({"a": left, "q": right}, True)):
        with pytest.raises(FieldError):
            joins.cogroup(inputs, {n: 0 for n in inputs}, flags=flags)
    assert values(joins.semi(right, right, "x.y")) == [(1, 2)]
    one = spark.createDataFrame([(1,)], "`__run_key_0` int")
    assert joins.cogroup({"_": one, "z": one}, 0).count() == 1


def test_comparators_of_joins(spark):
    a, b = spark.createDataFrame([("X", 1), (None, 2), ("q", 3)], "k string, v int"), spark.createDataFrame([("x", 5), (None, 6), ("Y", 7)], "k string, w int")
    want = [("X", 1, 5), (None, 2, 6), ("q", 3, None), ("Y", None, 7)]
    how = {"comparators": [fn.ignoring_case]}
    assert values(joins.cogroup({"a": a, "b": b}, "k", "full", **how).select("_key_0", "a_v", "b_w")) == sorted(want, key=str)
    assert values(joins.cogroup({"a": a, "b": b}, "k", "right", **how).select("_key_0", "a_v", "b_w")) == sorted([("x", 1, 5), (None, 2, 6), ("Y", None, 7)], key=str)
    assert values(joins.hash_join({"a": a, "b": b}, "k", "left", **how).select("_key_0", "a_v", "b_w")) == sorted(want[:3], key=str)
    with pytest.raises(FieldError):
        joins.cogroup({"a": a, "b": b}, "k", comparators=[])
    got = joins.buffer_join({"a": a, "b": b}, "k", lambda key, first, others: pd.DataFrame({"k": [key[0]], "n": [sum(map(len, first)) + len(others[0])]}), "k string, n int", **how)
    assert values(got) == sorted([("x", 2), (None, 2), ("q", 1), ("y", 1)], key=str)
    assert [r.k for r in total_sort(a, ("k", True, fn.ignoring_case)).collect()] == ["X", "q", None]
