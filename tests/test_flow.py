import threading
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from braidflow.fields import FieldError
from braidflow.operators import rows
from braidflow.operators.grouping import count_by, group_by
from braidflow.operators.traps import trap
from braidflow.plans.config import Config, Layer
from braidflow.plans.counters import Counters
from braidflow.plans.flow import Flow, FlowError
from braidflow.sources import taps
from braidflow.streaming import run_on_arrival


@pytest.fixture
def numbers(spark, tmp_path):
    tap = taps.parquet(str(tmp_path / "in"))
    tap.write(spark.range(20).select("id", (F.col("id") % 3).alias("k")))
    return tap


def test_flow_with_trap_counters_and_modes(spark, numbers, tmp_path):
    def assembly(inputs, context):
        shared = context.share(context.counters.count(inputs["n"], "in", rows="*", odd="id % 2 = 1"))
        split = trap(shared, small="id < 15")
        return {"counts": count_by(context.checkpoint(split.good, "good"), "k"), "bad": split.bad}

    sink = taps.parquet(str(tmp_path / "out"), mode=taps.SinkMode.REPLACE, parts=1)
    flow = Flow("f", {"n": numbers}, {"counts": sink}, assembly, traps={"bad": taps.parquet(str(tmp_path / "bad"), mode=taps.SinkMode.REPLACE)}, checkpoints={"good": taps.parquet(str(tmp_path / "cp"), mode=taps.SinkMode.REPLACE)})
    for _ in range(2):  # replacing: the second run finds the sinks there
        stats = flow.run(spark)
        assert stats.counter("in", "rows") == 20 and stats.counter("in", "odd") == 10 and stats.counter("in", "none") == 0
        assert sorted(tuple(r) for r in sink.read(spark).collect()) == [(0, 5), (1, 5), (2, 5)]
        assert spark.read.parquet(str(tmp_path / "bad")).count() == 5
    assert stats.sinks["counts"]["files"] >= 1 and stats.sinks["counts"]["bytes"] > 0


def test_preview_runs_nothing(spark, numbers, tmp_path):
    said = []

    def assembly(inputs, context):
        rows.debug(inputs["n"], "n", configured=context.debugging, show=said.append)
        return {"o": context.checkpoint(inputs["n"].where("id > 3"), "cp")}

    flow = Flow("f", {"n": numbers}, {"o": taps.parquet(str(tmp_path / "o"))}, assembly, checkpoints={"cp": taps.parquet(str(tmp_path / "cp"))}, debugging=rows.Level.STRICT)
    assert "PushedFilters" in flow.preview(spark)["o"] and not (tmp_path / "o").exists() and not (tmp_path / "cp").exists() and not said


def test_keep_and_update(spark, numbers, tmp_path):
    at = str(tmp_path / "o")
    make = lambda mode: Flow("f", {"n": numbers}, {"o": taps.parquet(at, mode=mode)}, lambda i, c: {"o": i["n"]})
    make(taps.SinkMode.KEEP).run(spark)
    with pytest.raises(PySparkException):
        make(taps.SinkMode.KEEP).run(spark)
    make(taps.SinkMode.UPDATE).run(spark)
    assert spark.read.parquet(at).count() == 40


def test_validation(spark, numbers, tmp_path):
    out = taps.parquet(str(tmp_path / "o"))
    with pytest.raises(FlowError):
        Flow("f", {}, {"o": out}, lambda i, c: {}).validate()
    with pytest.raises(FlowError):
        Flow("f", {"n": numbers}, {"o": numbers}, lambda i, c: {}).validate()
    with pytest.raises(FlowError):
        Flow("f", {"n": numbers}, {"o": out, "p": out}, lambda i, c: {}).validate()
    with pytest.raises(FlowError):
        Flow("f", {"n": numbers}, {"o": out}, lambda i, c: {}).run(spark)
    with pytest.raises(FlowError):
        Flow("f", {"n": numbers}, {"o": out}, lambda i, c: {"o": i["n"], "p": i["n"]}).run(spark)


def test_one_place_written_in_several_ways(spark, numbers, tmp_path):
    at = numbers.path
    for other in (at + "/", "file://" + at, at + "/./", at.replace("/in", "//in"), at + "/deeper", at + "/*.parquet"):
        flow = Flow("f", {"n": taps.parquet(other)}, {"o": taps.parquet(at, mode=taps.SinkMode.REPLACE)}, lambda i, c: {"o": i["n"]})
        with pytest.raises(FlowError):
            flow.validate()
        with pytest.raises(FlowError):
            flow.run(spark)
    with pytest.raises(FlowError):
        Flow("f", {"n": numbers}, {"o": taps.parquet(str(tmp_path), mode=taps.SinkMode.REPLACE)}, lambda i, c: {"o": i["n"]}).run(spark)
    assert numbers.read(spark).count() == 20
    Flow("f", {"n": numbers}, {"o": taps.parquet(at + "2")}, lambda i, c: {"o": i["n"]}).run(spark)


def test_counters_of_branches_that_did_not_run(spark, numbers, tmp_path):
    def assembly(inputs, context):
        context.counters.count(inputs["n"], "loose", rows="*")
        return {"o": inputs["n"]}

    stats = Flow("f", {"n": numbers}, {"o": taps.parquet(str(tmp_path / "o"))}, assembly).run(spark)
    assert stats.counters == {"loose->rows": 0}


def test_settings_of_a_tap(spark, numbers, tmp_path):
    tap = taps.parquet(str(tmp_path / "o"), layer=Layer(replaces={"spark.sql.parquet.compression.codec": "gzip"}))
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    Flow("f", {"n": numbers}, {"o": tap}, lambda i, c: {"o": i["n"]}).run(spark)
    assert list((tmp_path / "o").glob("*.gz.parquet")) and spark.conf.get("spark.sql.parquet.compression.codec") == before


def test_a_group_alone_is_no_result(spark, numbers, tmp_path):
    flow = Flow("f", {"n": numbers}, {"o": taps.parquet(str(tmp_path / "o"))}, lambda i, c: {"o": group_by(i["n"], "k")})
    with pytest.raises(FlowError, match="without an aggregator"):
        flow.run(spark)


def test_cancel_from_another_thread(spark, numbers, tmp_path):
    started = threading.Event()

    def assembly(inputs, context):
        def slow(frames):
            for x in frames:
                time.sleep(60)
                yield x

        started.set()
        return {"o": inputs["n"].mapInPandas(slow, inputs["n"].schema)}

    flow = Flow("f", {"n": numbers}, {"o": taps.parquet(str(tmp_path / "o"))}, assembly)

    def stop():
        started.wait()
        for _ in range(40):
            time.sleep(0.5)
            flow.cancel(spark)

    threading.Thread(target=stop, daemon=True).start()
    began = time.time()
    with pytest.raises(Exception):  # noqa: B017  whatever Spark raises for a cancelled job
        flow.run(spark)
    assert time.time() - began < 50


def test_source_parts_and_settings(spark, numbers, tmp_path):
    seen = {}

    def assembly(inputs, context):
        seen["parts"] = inputs["n"].rdd.getNumPartitions()
        seen["shuffle"] = spark.conf.get("spark.sql.shuffle.partitions")
        return {"o": inputs["n"]}

    before = spark.conf.get("spark.sql.shuffle.partitions")
    config = Config.of({"source.parts": 7, "spark.sql.shuffle.partitions": 3, "loader": object})
    Flow("f", {"n": numbers}, {"o": taps.parquet(str(tmp_path / "o"))}, assembly, config=config).run(spark)
    assert seen == {"parts": 7, "shuffle": "3"} and spark.conf.get("spark.sql.shuffle.partitions") == before and config.get("loader") is None


def test_config_layers():
    base = Config.of({"default": "flow", "replace": "flow"})
    step = base.with_layer(Layer({"default": "step", "step-default": "step"}, {"replace": "step"}))
    node = step.with_layer(Layer({"step-default": "node", "node-default": "node"}, {"replace": "node"}))
    assert step.values() == {"default": "flow", "replace": "step", "step-default": "step"}
    assert node.values() == {"default": "flow", "replace": "node", "step-default": "step", "node-default": "node"}
    assert node.changed(step) == {"replace": "node", "node-default": "node"}
    assert base.merged({"x": True}).get("x") == "true"


def test_ordered_sink_keeps_order(spark, numbers, tmp_path):
    tap = taps.parquet(str(tmp_path / "o"), parts=1)
    tap.write(group_by(numbers.read(spark), "k", [("id", True)]).ordered(parts=3), ordered=True)
    for part in tmp_path.joinpath("o").glob("*.parquet"):
        found = [tuple(r) for r in spark.read.parquet(str(part)).select("k", "id").collect()]
        assert found == sorted(found, key=lambda r: (r[0], -r[1]))


def test_delimited(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a"b,c'), (2, None), (3, "")], "n int, s string")
    tap = taps.TextDelimited(str(tmp_path / "d"), schema="n int, s string", write_header=True, skip_header=True, null_value="\\N")
    tap.write(df)
    assert sorted(map(tuple, tap.read(spark).collect())) == [(1, 'a"b,c'), (2, None), (3, "")]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv").write_text("1,a\nx,b\n3,c\n")
    split = taps.TextDelimited(str(tmp_path / "bad"), schema="n int, s string").read_trapped(spark)
    assert sorted(map(tuple, split.good.collect())) == [(1, "a"), (3, "c")] and [(r.trap_record, r.s) for r in split.bad.collect()] == [("x,b", "b")]


def test_partitioned_and_parts(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("k"))
    tap = taps.Partitioned(str(tmp_path / "p"), partition_by=["k"], spread=2)
    tap.write(df)
    assert sorted(x.name for x in (tmp_path / "p").glob("k=*")) == ["k=0", "k=1"] and tap.read(spark).where("k = 1").count() == 50
    taps.parquet(str(tmp_path / "three"), parts=3).write(df.repartition(8))
    assert len(list((tmp_path / "three").glob("*.parquet"))) == 3
    with pytest.raises(FieldError):
        taps.Partitioned(str(tmp_path / "q")).write(df)
    with pytest.raises(FieldError):
        taps.parquet(str(tmp_path / "q"), parts=0).write(df)


def test_counters_add_up(spark):
    own = Counters()
    for _ in range(2):
        own.total(own.count(spark.range(5), "g", n="*"), "g", s="id").collect()
    assert own.values() == {"g->n": 10, "g->s": 20} and own.value("g", "none") == 0


def test_arriving_files(spark, tmp_path):
    source = taps.Tap(str(tmp_path / "in"), schema="id bigint")
    sink = taps.parquet(str(tmp_path / "out"))
    for n in (3, 4):
        spark.range(n).write.mode("append").parquet(source.path)
        run_on_arrival(spark, source, lambda df: df.where("id > 0"), sink, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(sink.path).count() == 5
