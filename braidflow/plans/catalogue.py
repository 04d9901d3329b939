"""The registered queries of the dataflow operators, each with the DuckDB SQL that must give the same rows.

Amounts are summed as whole hundredths, so that results do not depend on the
order of addition. Orders have a unique last field.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidflow import functions as fn
from braidflow.fields import ALL, NONE, RESULTS, at_load, typed
from braidflow.operators import joins, rows, sets
from braidflow.operators.grouping import aggregate_by, count_by, group_by, total_sort
from braidflow.operators.traps import trap, trapped_map
from braidflow.plans.counters import Counters
from braidflow.sources import taps
from braidflow.sources.scratch import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the decorated function under its own name."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return taps.parquet(f"{sf_dir}/{name}.parquet").read(spark)


# --- sources and sinks ---


@query("select l_orderkey, l_linenumber, l_quantity from lineitem")
def scan_project(spark, sf_dir):
    return rows.project(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])


@query("select c_custkey, c_mktsegment from customer")
def select_negative_positions(spark, sf_dir):
    return rows.project(table(spark, sf_dir, "customer"), [0, -1])


@query("select * from nation")
def delimited_roundtrip(spark, sf_dir):
    tap = taps.TextDelimited(scratch(spark, "csv"), schema="n_nationkey int, n_name string, n_regionkey int", delimiter="\t", skip_header=True, write_header=True)
    tap.write(table(spark, sf_dir, "nation"))
    return tap.read(spark)


@query("select n_nationkey, n_name, n_regionkey from nation")
def delimited_by_header(spark, sf_dir):
    at = scratch(spark, "csv")
    taps.TextDelimited(at, write_header=True).write(table(spark, sf_dir, "nation"))
    return taps.TextDelimited(at, resolver={"n_nationkey": "int", "n_regionkey": "int"}).read(spark)


@query("select r_regionkey::varchar || chr(9) || r_name as line from region")
def text_line_roundtrip(spark, sf_dir):
    tap = taps.TextLine(scratch(spark, "text"))
    tap.write(table(spark, sf_dir, "region"))
    return tap.read(spark)


@query("select r_regionkey::varchar as r_regionkey, r_name from region")
def unknown_fields_at_load(spark, sf_dir):
    tap = taps.TextLine(scratch(spark, "text"))
    tap.write(table(spark, sf_dir, "region"))
    return at_load(tap.read(spark), ["r_regionkey", "r_name"])


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def partitioned_roundtrip(spark, sf_dir):
    tap = taps.Partitioned(scratch(spark, "parts"), partition_by=["c_mktsegment"])
    tap.write(table(spark, sf_dir, "customer"))
    return tap.read(spark).select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("select p_partkey, p_name, p_size from part")
def orc_roundtrip(spark, sf_dir):
    tap = taps.orc(scratch(spark, "orc"), parts=2)
    tap.write(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"))
    return tap.read(spark)


@query("select o_custkey, o_orderkey from orders")
def ordered_sink(spark, sf_dir):
    tap = taps.parquet(scratch(spark, "ordered"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    tap.write(group_by(orders, "o_custkey", ["o_orderkey"]).ordered(parts=4), ordered=True)
    return tap.read(spark)


@query("select event_id from events where event_type != 'error'")
def source_trap_good(spark, sf_dir):
    at = scratch(spark, "bad")
    mixed = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", F.concat(F.lit("bad"), F.col("event_id"))).otherwise(F.col("event_id").cast("string")).alias("event_id"))
    taps.TextDelimited(at).write(mixed)
    return taps.TextDelimited(at, schema="event_id bigint").read_trapped(spark).good


@query("select event_id, 'bad' || event_id as trap_record from (select event_id from events where event_type = 'error')")
def source_trap_bad(spark, sf_dir):
    at = scratch(spark, "bad")
    mixed = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "error", F.concat(F.lit("bad"), F.col("event_id"))).otherwise(F.col("event_id").cast("string")).alias("event_id"))
    taps.TextDelimited(at).write(mixed)
    bad = taps.TextDelimited(at, schema="n bigint").read_trapped(spark).bad
    return bad.select(F.substring("trap_record", 4, 20).cast("long").alias("event_id"), "trap_record")


@query("select c_custkey, c_custkey % 4 as bucket from customer")
def partitioned_by_expression(spark, sf_dir):
    tap = taps.Partitioned(scratch(spark, "buckets"), partition_by=["bucket"], expressions={"bucket": "c_custkey % 4"}, spread=3, open_files=8)
    tap.write(table(spark, sf_dir, "customer").select("c_custkey"))
    return tap.read(spark).select("c_custkey", F.col("bucket").cast("long").alias("bucket"))


@query("select i as n, i * i as square from range(20) t(i)")
def custom_source(spark, sf_dir):
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Squares(DataSource):
        @classmethod
        def name(cls):
            return "braidflow_squares"

        def schema(self):
            return "n bigint, square bigint"

        def reader(self, schema):
            upto = int(self.options["path"])

            class Reader(DataSourceReader):
                def partitions(self):
                    return [InputPartition(i) for i in range(4)]

                def read(self, partition):
                    yield from ((n, n * n) for n in range(partition.value, upto, 4))

            return Reader()

    return taps.Tap("20", source=Squares).read(spark)


# --- row operations ---


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem where l_shipdate >= timestamp '1997-01-01' and l_discount between 0.02 and 0.06 and l_quantity < 24")
def filter_predicate(spark, sf_dir):
    kept = rows.keep(table(spark, sf_dir, "lineitem"), "l_shipdate >= timestamp_ntz '1997-01-01' and l_discount between 0.02 and 0.06 and l_quantity < 24")
    return rows.project(kept, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("select o_orderkey from orders where o_orderstatus != 'F' or o_orderstatus is null")
def filter_discard(spark, sf_dir):
    return rows.discard(table(spark, sf_dir, "orders"), "o_orderstatus = 'F'").select("o_orderkey")


@query("select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * (1 - l_discount) * 100) as bigint) as revenue from lineitem")
def derive_function(spark, sf_dir):
    return rows.each(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "revenue"], revenue=fn.cents(F.col("l_extendedprice") * (1 - F.col("l_discount"))))


@query("select o_orderkey * 2 as twice, upper(o_orderpriority) as priority from orders")
def results_only(spark, sf_dir):
    return rows.each(table(spark, sf_dir, "orders"), RESULTS, twice="o_orderkey * 2", priority="upper(o_orderpriority)")


@query("select c_custkey as id, c_name as name from customer")
def rename_fields(spark, sf_dir):
    return rows.rename(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), c_custkey="id", c_name="name")


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def generator_json(spark, sf_dir):
    return rows.each(table(spark, sf_dir, "events"), ["event_id", "k"], k="cast(get_json_object(props, '$.k') as bigint)")


@query(r"""select token, count(*) as n from (select unnest(string_split_regex(text, '\s+')) as token from documents)
           group by token""")
def wordcount(spark, sf_dir):
    words = rows.generate(table(spark, sf_dir, "documents"), RESULTS, token=fn.regex_split_generator("text", r"\s+"))
    return count_by(words, "token", "n")


@query("select conv_id, turn, unnest(string_split(text, ' ')) as token from conversations")
def udtf_tokens(spark, sf_dir):
    @F.udtf(returnType="token string")
    class Tokens:
        def eval(self, text: str):
            for token in (text or "").split(" "):
                yield (token,)

    spark.udtf.register("braidflow_tokens", Tokens)
    turns = table(spark, sf_dir, "conversations")
    return spark.sql("select c.conv_id, c.turn, t.token from {turns} c, lateral braidflow_tokens(c.text) t", turns=turns)


@query("select event_id, length(event_type) as n from events where value > 50")
def opaque_map(spark, sf_dir):
    def f(frames):
        for x in frames:
            x = x[x.value > 50]
            yield pd.DataFrame({"event_id": x.event_id, "n": x.event_type.str.len()})

    return rows.opaque(table(spark, sf_dir, "events"), f, "event_id long, n long", ["event_id", "event_type", "value"])


@query("select o_orderkey, o_totalprice from orders")
def assert_level(spark, sf_dir):
    checked = rows.assert_that(table(spark, sf_dir, "orders"), "o_totalprice > 0", "prices are positive")
    return rows.assert_that(checked, "false", level=rows.Level.STRICT, configured=rows.Level.VALID).select("o_orderkey", "o_totalprice")


@query("select event_id from events where event_type != 'error'")
def trap_good(spark, sf_dir):
    return _trapped(spark, sf_dir).good.select("event_id")


@query("select event_id, 'numeric' as trap_reason from events where event_type = 'error'")
def trap_bad(spark, sf_dir):
    return _trapped(spark, sf_dir).bad.select("event_id", "trap_reason")


def _trapped(spark, sf_dir):
    events = rows.each(table(spark, sf_dir, "events"), k="case when event_type = 'error' then 'bad' else get_json_object(props, '$.k') end")
    return trap(events, numeric="try_cast(k as bigint) is not null")


@query("select event_id, 'ValueError: error' as trap_reason from events where event_type = 'error'")
def trap_opaque(spark, sf_dir):
    def f(row):
        if row["event_type"] == "error":
            raise ValueError("error")
        return [row]

    return trapped_map(table(spark, sf_dir, "events").select("event_id", "event_type"), f, "event_id long, event_type string").bad.select("event_id", "trap_reason")


@query("select r_regionkey::bigint as r_regionkey, r_name from region")
def typed_fields(spark, sf_dir):
    return typed(table(spark, sf_dir, "region"), r_regionkey="bigint")


_WIDE = "select o_orderkey as k, o_custkey as c, case when o_orderkey % 3 = 0 then null else 1152921504606846977 + o_orderkey // 8 end as v from orders"


_SHOWN = f"select k, c, v::varchar as v from ({_WIDE})"  # as text, so that no reader of the result can round them


def _shown(df):
    return df.withColumn("v", F.col("v").cast("string"))


def _wide(spark, sf_dir):
    """Whole numbers that a double can't hold, beside nulls."""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "o_custkey as c", "if(o_orderkey % 3 = 0, null, 1152921504606846977 + o_orderkey div 8) as v")


@query(_SHOWN)
def opaque_wide(spark, sf_dir):
    return _shown(rows.opaque(_wide(spark, sf_dir), lambda frames: frames, "k long, c long, v long"))


@query(_SHOWN)
def trap_wide(spark, sf_dir):
    return _shown(trapped_map(_wide(spark, sf_dir), lambda row: [row], "k long, c long, v long").good)


@query("select o_orderkey % 10 as part, count(*) as n from orders group by 1")
def slice_numbers(spark, sf_dir):
    dealt = table(spark, sf_dir, "orders").selectExpr("o_orderkey % 10 as part").repartition(5, "part")
    by_slice = aggregate_by(rows.slices(dealt), ["slice", "part"], n="count(*)")
    return aggregate_by(by_slice, "part", slices="count(*)", n="sum(n)").where("slices = 1").select("part", "n")


# --- merges and splits ---


@query("select c_custkey as id, c_nationkey as nation from customer union all select s_suppkey, s_nationkey from supplier")
def merge_bag(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"))
    return sets.merge(a, table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))


@query("""select o_orderkey from orders where o_totalprice > 100000 union all select o_orderkey from orders where o_orderstatus = 'F'
          union all select o_orderkey from orders where o_orderpriority = '1-URGENT'""")
def merge_three_dups(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    branches = sets.split(o, dear="o_totalprice > 100000", finished="o_orderstatus = 'F'", urgent="o_orderpriority = '1-URGENT'")
    return sets.merge(*[b.select("o_orderkey") for b in branches.values()])


@query("select event_id, 'click' as path from events where event_type = 'click' union all select event_id, 'dear' from events where value > 50")
def split_two_paths(spark, sf_dir):
    branches = sets.split(table(spark, sf_dir, "events"), click="event_type = 'click'", dear="value > 50")
    return sets.merge(*[b.select("event_id", F.lit(n).alias("path")) for n, b in branches.items()])


# --- groups ---

_SUMS = {"n": "count(*)", "qty": "sum(cast(l_quantity as bigint))", "cents": "sum(cast(round(l_extendedprice * 100) as bigint))", "least": "min(l_discount)", "most": "max(l_tax)"}


@query("select l_returnflag, l_linestatus, count(*) as n from lineitem group by all")
def group_count(spark, sf_dir):
    return count_by(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "n")


@query("""select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity::bigint)::bigint as qty,
          sum(round(l_extendedprice * 100)::bigint)::bigint as cents, min(l_discount) as least, max(l_tax) as most from lineitem group by all""")
def group_multi_agg(spark, sf_dir):
    return group_by(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"]).every(**_SUMS)


@query("select nullif(o_orderpriority, '1-URGENT') as priority, count(*) as n from orders group by 1")
def group_null_key(spark, sf_dir):
    return count_by(rows.each(table(spark, sf_dir, "orders"), priority="nullif(o_orderpriority, '1-URGENT')"), "priority", "n")


@query("select count(*) as n, sum(round(c_acctbal * 100)::bigint)::bigint as cents from customer")
def group_global(spark, sf_dir):
    return group_by(table(spark, sf_dir, "customer"), NONE).every(n="count(*)", cents=F.sum(fn.cents("c_acctbal")))


@query("select count(*) as n from customer where false group by 1 = 1")
def group_global_empty(spark, sf_dir):
    return group_by(rows.keep(table(spark, sf_dir, "customer"), "false"), NONE).every(n="count(*)")


@query("select nation, count(*) as n from (select c_nationkey as nation from customer union all select s_nationkey from supplier) group by nation")
def group_after_merge(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return group_by([a, table(spark, sf_dir, "supplier").select("s_nationkey")], "nation").every(n="count(*)")


@query("""select o_custkey, o_orderkey, o_orderdate from orders
          qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1""")
def group_sorted_first(spark, sf_dir):
    return group_by(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"]).top(1)


@query("""select o_custkey, o_orderstatus, o_orderkey from orders
          qualify row_number() over (partition by o_custkey order by o_orderstatus, o_orderkey desc) = 1""")
def group_sorted_mixed(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderkey")
    return group_by(orders, "o_custkey", ["o_orderstatus", ("o_orderkey", True)]).top(1)


@query("""select user_id, event_id, event_type from events
          qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def group_reversed(spark, sf_dir):
    return group_by(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], reverse=True).top(1).select("user_id", "event_id", "event_type")


@query("select max(role) as role, count(*) as n from (select case when turn = 1 then upper(role) else role end as role from conversations) t group by lower(role)")
def group_comparator(spark, sf_dir):
    mixed = table(spark, sf_dir, "conversations").select(F.expr("case when turn = 1 then upper(role) else role end").alias("role"))
    return group_by(mixed, "role", comparators={"role": fn.ignoring_case}).every(n="count(*)", shown="max(role)").select(F.col("shown").alias("role"), "n")


@query("select o_custkey, o_orderkey, sum(round(o_totalprice * 100)::bigint) over (partition by o_custkey order by o_orderdate, o_orderkey)::bigint as running from orders")
def buffer_running_total(spark, sf_dir):
    def f(key, frames):
        total = 0
        for x in frames:
            sums = x.cents.cumsum() + total
            total = int(sums.iloc[-1])
            yield pd.DataFrame({"o_custkey": x.o_custkey, "o_orderkey": x.o_orderkey, "running": sums})

    orders = rows.each(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey", "o_orderdate", "cents"], cents=fn.cents("o_totalprice"))
    return group_by(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).buffer(f, "o_custkey long, o_orderkey long, running long")


@query("select o_custkey, o_orderkey, sum(round(o_totalprice * 100)::bigint) over (partition by o_custkey order by o_orderdate, o_orderkey)::bigint as running from orders")
def analytic_running_total(spark, sf_dir):
    orders = rows.each(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey", "o_orderdate", "cents"], cents=fn.cents("o_totalprice"))
    return group_by(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).analytic(running=lambda w: F.sum("cents").over(w)).select("o_custkey", "o_orderkey", "running")


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem
          qualify row_number() over (partition by l_suppkey order by l_quantity desc, l_orderkey, l_linenumber, l_partkey) <= 3""")
def topk_per_group(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return group_by(lines, "l_suppkey", [("l_quantity", True), "l_orderkey", "l_linenumber", "l_partkey"]).top(3).drop("l_quantity")


@query("select user_id, string_agg(event_type, ',' order by event_id) as path from events group by user_id")
def group_collected(spark, sf_dir):
    paths = group_by(table(spark, sf_dir, "events"), "user_id", ["event_id"]).collected("found", "event_type")
    return paths.select("user_id", F.array_join("found.event_type", ",").alias("path"))


@query(_SHOWN)
def buffer_wide(spark, sf_dir):
    return _shown(group_by(_wide(spark, sf_dir), "c", ["k"]).buffer(lambda key, frames: frames, "k long, c long, v long"))


@query("select o_orderstatus as \"o.status\", count(*) as \"n.rows\" from orders group by 1")
def group_dotted(spark, sf_dir):
    renamed = rows.rename(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), o_orderstatus="o.status")
    return group_by(renamed, "o.status").every(**{"n.rows": "count(*)"})


@query("""select conv_id, turn from (select *, case when turn % 2 = 1 then upper(role) else role end as shown from conversations)
          qualify row_number() over (partition by conv_id order by lower(shown) desc, turn) = 1""")
def group_sort_comparator(spark, sf_dir):
    mixed = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "case when turn % 2 = 1 then upper(role) else role end as role")
    return group_by(mixed, "conv_id", [("role", True, fn.ignoring_case), "turn"]).top(1).select("conv_id", "turn")


@query("select p_partkey, p_retailprice from part order by p_retailprice, p_partkey")
def total_sort_parts(spark, sf_dir):
    return total_sort(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), "p_retailprice", "p_partkey")


# --- co-groups ---

_ORDERS = "(select o_orderkey as k, o_custkey as cust from orders where o_orderpriority != '1-URGENT')"
_LINES = "(select l_orderkey as k, count(*) as n from lineitem where l_returnflag = 'R' group by 1)"


def _sides(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_orderpriority != '1-URGENT'").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("cust"))
    lines = count_by(table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k")), "k", "n")
    return {"o": orders, "l": lines}


def _cogroup(policy: str):
    how = {"inner": "join", "left": "left join", "right": "right join", "full": "full join"}[policy]

    def run(spark, sf_dir):
        return joins.cogroup(_sides(spark, sf_dir), "k", policy)

    run.__name__ = f"cogroup_{policy}"
    return query(f"select coalesce(o.k, l.k) as _key_0, o.k as o_k, o.cust as o_cust, l.k as l_k, l.n as l_n from {_ORDERS} o {how} {_LINES} l on o.k is not distinct from l.k")(run)


cogroup_inner, cogroup_left, cogroup_right, cogroup_full = map(_cogroup, ("inner", "left", "right", "full"))

_THREE = """
with a as (select nullif(c_custkey, 7) as k, c_nationkey as v from customer where c_mktsegment != 'BUILDING' or c_custkey = 7),
b as (select nullif(c_custkey, 7) as k, c_custkey as v from customer where c_acctbal > 2000 or c_custkey = 7),
c as (select nullif(c_custkey, 7) as k, c_custkey + 1 as v from customer where c_acctbal < 6000),
ab as (select case when a.p then a.k else b.k end as k, true as p, a.p as ap, b.p as bp, a.k as a_k, a.v as a_v, b.k as b_k, b.v as b_v
  from (select *, true as p from a) a full join (select *, true as p from b) b on a.k is not distinct from b.k),
abc as (select case when ab.p then ab.k else c.k end as _key_0, a_k, a_v, b_k, b_v, c.k as c_k, c.v as c_v,
  coalesce(ap, false) as a_present, coalesce(bp, false) as b_present, coalesce(c.p, false) as c_present
  from ab full join (select *, true as p from c) c on ab.k is not distinct from c.k)
select * from abc """


def _three(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("k", F.expr("nullif(c_custkey, 7)"))
    return {
        "a": c.where("c_mktsegment != 'BUILDING' or c_custkey = 7").select("k", F.col("c_nationkey").alias("v")),
        "b": c.where("c_acctbal > 2000 or c_custkey = 7").select("k", F.col("c_custkey").alias("v")),
        "c": c.where("c_acctbal < 6000").select("k", (F.col("c_custkey") + 1).alias("v")),
    }


@query(_THREE)
def cogroup_three_full(spark, sf_dir):
    return joins.cogroup(_three(spark, sf_dir), "k", "full", flags=True)


@query(_THREE + "where b_present")
def cogroup_mixed(spark, sf_dir):
    return joins.cogroup(_three(spark, sf_dir), "k", [False, True, False], flags=True)


@query(_THREE + "where a_present and c_present")
def cogroup_mixed_ends(spark, sf_dir):
    return joins.cogroup(_three(spark, sf_dir), "k", [True, False, True], flags=True)


@query("""select a.n_regionkey as _key_0, a.n_nationkey as a_n_nationkey, a.n_name as a_n_name, a.n_regionkey as a_n_regionkey,
          b.n_nationkey as b_n_nationkey, b.n_name as b_n_name, b.n_regionkey as b_n_regionkey from nation a join nation b on a.n_regionkey = b.n_regionkey""")
def cogroup_self(spark, sf_dir):
    return joins.self_join(table(spark, sf_dir, "nation"), 2, "n_regionkey")


@query("""with o as (select o_orderkey, nullif(o_custkey, 3) as k from orders), c as (select c_name, nullif(c_custkey, 3) as k from customer)
          select o.k as _key_0, o.o_orderkey as o_o_orderkey, o.k as o_k, c.c_name as c_c_name, c.k as c_k from o join c on o.k is not distinct from c.k""")
def cogroup_null_keys(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("nullif(o_custkey, 3)").alias("k"))
    return joins.cogroup({"o": o, "c": table(spark, sf_dir, "customer").select("c_name", F.expr("nullif(c_custkey, 3)").alias("k"))}, "k")


@query("select r_regionkey as r_r_regionkey, r_name as r_r_name, n_nationkey as n_n_nationkey, n_name as n_n_name, n_regionkey as n_n_regionkey from region, nation")
def cogroup_cross(spark, sf_dir):
    return joins.cogroup({"r": table(spark, sf_dir, "region"), "n": table(spark, sf_dir, "nation")}, NONE)


@query("""select o_orderkey as k, count(*) as n, sum(round(l_extendedprice * 100)::bigint)::bigint as cents
          from orders join lineitem on o_orderkey = l_orderkey group by 1""")
def cogroup_every(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), fn.cents("l_extendedprice").alias("cents"))
    both = joins.cogroup({"o": orders, "l": lines}, "k", keys_not_null=True)
    return aggregate_by(both, "_key_0", n="count(*)", cents="sum(l_cents)").withColumnRenamed("_key_0", "k")


@query("""select o.k, l.n, coalesce(o.k, -1) * 10 + coalesce(l.n, 0) as mixed, case when o.k is null then 'l' when l.k is null then 'o' else 'ol' end as sides
          from (select o_orderkey as k from orders where o_orderpriority != '1-URGENT') o full join (select l_orderkey as k, count(*) as n from lineitem where l_returnflag = 'R' group by 1) l on o.k = l.k""")
def custom_joiner(spark, sf_dir):
    def f(frames):
        for x in frames:
            k, n = x.o_k.astype("Int64"), x.l_n.astype("Int64")
            sides = x.o_present.map({True: "o", False: ""}) + x.l_present.map({True: "l", False: ""})
            yield pd.DataFrame({"k": k, "n": n, "mixed": k.fillna(-1) * 10 + n.fillna(0), "sides": sides})

    return joins.custom_join(_sides(spark, sf_dir), "k", f, "k long, n long, mixed long, sides string")


@query("""with a as (select v, count(*) as n from (WIDE) where k % 2 = 0 group by 1), b as (select v, count(*) as n from (WIDE) where k % 5 = 0 group by 1)
          select coalesce(a.v, b.v)::varchar as v, a.n as left_n, b.n as right_n from a full join b on a.v is not distinct from b.v""".replace("WIDE", _WIDE))
def custom_joiner_wide(spark, sf_dir):
    def f(frames):
        for x in frames:
            yield pd.DataFrame({"v": x.a_v.where(x.a_present, x.b_v), "left_n": x.a_n, "right_n": x.b_n})

    wide = _wide(spark, sf_dir)
    inputs = {"a": count_by(wide.where("k % 2 = 0"), "v", "n"), "b": count_by(wide.where("k % 5 = 0"), "v", "n")}
    return _shown(joins.custom_join(inputs, "v", f, "v long, left_n long, right_n long"))


@query("""select k, n from (select o_orderkey as k from orders where o_orderpriority != '1-URGENT') o
          full join (select l_orderkey as k, count(*) as n from lineitem where l_returnflag = 'R' group by 1) l using (k)""")
def cogroup_buffer(spark, sf_dir):
    def f(key, frames):
        for x in frames:
            yield pd.DataFrame({"k": [key[0]] * len(x), "n": x.l_n})

    return group_by(joins.cogroup(_sides(spark, sf_dir), "k", "full"), "_key_0", ["l_n"]).buffer(f, "k long, n long")


@query("""select a.role as _key_0, a.role as a_role, a.n as a_n, b.role as b_role, b.n as b_n
          from (select upper(role) as role, count(*) as n from conversations where turn = 1 group by 1) a
          left join (select role, count(*) as n from conversations where role != 'system' group by 1) b on lower(a.role) = lower(b.role)""")
def cogroup_comparator(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    first = count_by(turns.where("turn = 1").selectExpr("upper(role) as role"), "role", "n")
    return joins.cogroup({"a": first, "b": count_by(turns.where("role != 'system'").select("role"), "role", "n")}, "role", "left", comparators=[fn.ignoring_case])


@query("select s_suppkey as s_s_suppkey, n_nationkey as n_n_nationkey from supplier, nation")
def cogroup_cross_unsent(spark, sf_dir):
    return joins.cross({"s": table(spark, sf_dir, "supplier").select("s_suppkey"), "n": table(spark, sf_dir, "nation").select("n_nationkey")}, limit=0)


# --- broadcast joins ---


@query("select l_partkey as _key_0, l_orderkey as l_l_orderkey, l_linenumber as l_l_linenumber, l_partkey as l_l_partkey, p_partkey as p_p_partkey, p_brand as p_p_brand from lineitem join part on l_partkey = p_partkey")
def hashjoin_inner(spark, sf_dir):
    inputs = {"l": table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "p": table(spark, sf_dir, "part").select("p_partkey", "p_brand")}
    return joins.hash_join(inputs, {"l": "l_partkey", "p": "p_partkey"}, keys_not_null=True)


@query("select d.doc_id as _key_0, d.doc_id as d_doc_id, d.lang as d_lang, b.doc_id as b_doc_id, b.quality as b_quality from documents d left join labels b on d.doc_id = b.doc_id")
def hashjoin_left(spark, sf_dir):
    inputs = {"d": table(spark, sf_dir, "documents").select("doc_id", "lang"), "b": table(spark, sf_dir, "labels").select("doc_id", "quality")}
    return joins.hash_join(inputs, "doc_id", "left")


_BY_NATION = """with c as (select c_nationkey as k, count(*) as n from customer where c_acctbal > 9000 group by 1),
s as (select s_nationkey as k, count(*) as n from supplier where s_acctbal < 5000 group by 1)
select n.n_nationkey as _key_0, n.n_nationkey as n_k, n.n_name as n_n_name, c.k as c_k, c.n as c_n, s.k as s_k, s.n as s_n from nation n """


def _by_nation(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    c = count_by(table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")), "k", "n")
    s = count_by(table(spark, sf_dir, "supplier").where("s_acctbal < 5000").select(F.col("s_nationkey").alias("k")), "k", "n")
    return {"n": n, "c": c, "s": s}


@query(_BY_NATION + "join c on c.k = n.n_nationkey join s on s.k = n.n_nationkey")
def hashjoin_nary_inner(spark, sf_dir):
    return joins.hash_join(_by_nation(spark, sf_dir), "k")


@query(_BY_NATION + "left join c on c.k = n.n_nationkey left join s on s.k = n.n_nationkey")
def hashjoin_nary_left(spark, sf_dir):
    return joins.hash_join(_by_nation(spark, sf_dir), "k", "left")


@query("select a.n_regionkey as _key_0, a.n_name as a_n_name, a.n_regionkey as a_n_regionkey, b.n_name as b_n_name, b.n_regionkey as b_n_regionkey from nation a join nation b on a.n_regionkey = b.n_regionkey")
def hashjoin_self(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_name", "n_regionkey")
    return joins.hash_join({"a": nation, "b": nation}, "n_regionkey")


@query("select c_custkey as c_c_custkey, r_name as r_r_name from customer, region")
def hashjoin_cross(spark, sf_dir):
    return joins.hash_join({"c": table(spark, sf_dir, "customer").select("c_custkey"), "r": table(spark, sf_dir, "region").select("r_name")}, NONE)


# --- buffer joins ---


@query("""select coalesce(c.k, o.k) as k, coalesce(c.n, 0) as n_left, coalesce(o.n, 0) as n_right
          from (select c_custkey as k, count(*) as n from customer where c_mktsegment != 'BUILDING' group by 1) c
          full join (select o_custkey as k, count(*) as n from orders where o_orderstatus = 'F' group by 1) o on c.k = o.k""")
def bufferjoin_counts(spark, sf_dir):
    def f(key, first, others):
        return pd.DataFrame({"k": [key[0]], "n_left": [sum(map(len, first))], "n_right": [len(others[0])]})

    c = table(spark, sf_dir, "customer").where("c_mktsegment != 'BUILDING'").select(F.col("c_custkey").alias("k"))
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    return joins.buffer_join({"c": c, "o": o}, "k", f, "k long, n_left long, n_right long")


@query("""select n.n_nationkey::bigint as k, (select count(*) from customer where c_nationkey = n.n_nationkey) as customers,
          (select count(*) from supplier where s_nationkey = n.n_nationkey) as suppliers from nation n""")
def bufferjoin_three(spark, sf_dir):
    def f(key, first, others):
        n = sum(map(len, first))
        if len(others[0]):
            yield pd.DataFrame({"k": [key[0]], "customers": [n], "suppliers": [len(others[1])]})

    inputs = {"c": table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), "n": table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")), "s": table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))}
    return joins.buffer_join(inputs, "k", f, "k long, customers long, suppliers long")


@query("select (select count(*) from region) as regions, (select count(*) from nation) as nations")
def bufferjoin_nokey(spark, sf_dir):
    def f(key, first, others):
        return pd.DataFrame({"regions": [len(others[0])], "nations": [sum(map(len, first))]})

    return joins.buffer_join({"n": table(spark, sf_dir, "nation"), "r": table(spark, sf_dir, "region")}, NONE, f, "regions long, nations long")


@query(f"select k, v from ({_SHOWN}) where k % 2 = 0 union all select k, v from ({_SHOWN}) where k % 5 = 0")
def bufferjoin_wide(spark, sf_dir):
    def f(key, first, others):  # a third of all rows has the null key, far more than are held in memory
        yield from first
        yield from others[0]

    wide = _wide(spark, sf_dir).select("k", "v")
    return _shown(joins.buffer_join({"a": wide.where("k % 2 = 0"), "b": wide.where("k % 5 = 0")}, "v", f, "k long, v long", spill_rows=50))


# --- flows ---


@query("select count(*) as seen, count(*) filter (where l_discount > 0.05) as discounted, 0::bigint as missing from lineitem")
def counters(spark, sf_dir):
    own = Counters()
    own.count(table(spark, sf_dir, "lineitem"), "lines", seen="*", discounted="l_discount > 0.05").write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(own.value("lines", "seen"), own.value("lines", "discounted"), own.value("lines", "missing"))], "seen long, discounted long, missing long")


@query(r"select token, count(*) as count from (select unnest(string_split_regex(text, '\s+')) as token from conversations) group by token")
def flow_wordcount(spark, sf_dir):
    from braidflow.plans.flow import Flow

    def assembly(inputs, context):
        words = rows.generate(inputs["text"], RESULTS, token=fn.regex_split_generator("text", r"\s+"))
        return {"counts": count_by(context.counters.count(words, "words", read="*"), "token")}

    sink = taps.TextDelimited(scratch(spark, "counts"), schema="token string, count bigint", delimiter="\t", mode=taps.SinkMode.REPLACE)
    Flow("word count", {"text": taps.parquet(f"{sf_dir}/conversations.parquet")}, {"counts": sink}, assembly).run(spark)
    return sink.read(spark)


@query("""select 'dear' as sink, count(*) as n from orders where o_totalprice > 100000 union all select 'urgent', count(*) from orders where o_orderpriority = '1-URGENT'
          union all select 'checkpoint', count(*) from orders where o_orderstatus != 'P'""")
def flow_two_sinks(spark, sf_dir):
    from braidflow.plans.flow import Flow

    def assembly(inputs, context):
        shared = context.checkpoint(rows.discard(inputs["orders"], "o_orderstatus = 'P'"), "open")
        both = sets.split(sets.merge(shared, rows.keep(inputs["orders"], "o_orderstatus = 'P'")), dear="o_totalprice > 100000", urgent="o_orderpriority = '1-URGENT'")
        return {n: b.select("o_orderkey") for n, b in both.items()}

    sinks = {n: taps.parquet(scratch(spark, n)) for n in ("dear", "urgent")}
    kept = taps.parquet(scratch(spark, "open"))
    Flow("two sinks", {"orders": taps.parquet(f"{sf_dir}/orders.parquet")}, sinks, assembly, checkpoints={"open": kept}).run(spark)
    return sets.merge(*[count_by(tap.read(spark).select(F.lit(n).alias("sink")), "sink", "n") for n, tap in {**sinks, "checkpoint": kept}.items()])


@query("select count(*) as read, 0::bigint as unread from region")
def flow_counters(spark, sf_dir):
    from braidflow.plans.flow import Flow

    def assembly(inputs, context):
        context.counters.count(inputs["region"], "loose", unread="*")  # a branch that leads nowhere is never run
        return {"out": context.counters.count(inputs["region"], "rows", read="*")}

    stats = Flow("counters", {"region": taps.parquet(f"{sf_dir}/region.parquet")}, {"out": taps.parquet(scratch(spark, "out"))}, assembly).run(spark)
    return spark.createDataFrame([(stats.counter("rows", "read"), stats.counter("loose", "unread"))], "read long, unread long")


# --- what Spark has beyond ---


@query("select distinct o_orderstatus, o_orderpriority from orders")
def superset_distinct(spark, sf_dir):
    return sets.unique(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("select o_orderstatus, o_orderpriority, count(*) as n from orders group by cube (o_orderstatus, o_orderpriority)")
def superset_cube(spark, sf_dir):
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("select o_orderstatus, o_orderpriority, count(*) as n from orders group by rollup (o_orderstatus, o_orderpriority)")
def superset_rollup(spark, sf_dir):
    return table(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')")
def superset_semi(spark, sf_dir):
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi(table(spark, sf_dir, "customer").select("c_custkey"), finished, "c_custkey")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')")
def superset_anti(spark, sf_dir):
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.semi(table(spark, sf_dir, "customer").select("c_custkey"), finished, "c_custkey", anti=True)


@query("select c_nationkey as k from customer intersect select s_nationkey from supplier")
def superset_intersect(spark, sf_dir):
    return sets.intersect(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select("s_nationkey"))


@query("select c_custkey as k from customer except select o_custkey from orders")
def superset_subtract(spark, sf_dir):
    return sets.subtract(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select("o_custkey"))


@query()
def superset_approx(spark, sf_dir):
    return group_by(table(spark, sf_dir, "lineitem"), "l_returnflag").every(parts="approx_count_distinct(l_partkey)")


__all__ = ["ALL", "ORACLES", "QUERIES"]
