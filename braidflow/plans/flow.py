"""A flow: named sources, an assembly of operators, named sinks and traps, checked before it runs as one lazy plan."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from braidflow.operators.grouping import Grouped
from braidflow.operators.rows import Level
from braidflow.plans.config import Config
from braidflow.plans.counters import Counters
from braidflow.sources.taps import SinkMode, Tap


class FlowError(ValueError):
    """An assembly that does not hold together."""


def _overlap(a: str, b: str) -> bool:
    return a == b or a.startswith(b + "/") or b.startswith(a + "/")


Assembly = Callable[[dict[str, DataFrame], "Context"], dict[str, DataFrame]]


@dataclass
class Context:
    """What an assembly may ask for: settings, counters, levels, and a way to keep a shared branch."""

    spark: SparkSession
    config: Config
    counters: Counters
    assertions: Level
    debugging: Level
    kept: list[DataFrame] = field(default_factory=list)
    checkpoints: dict[str, Tap] = field(default_factory=dict)
    #: A preview plans everything and writes nothing.
    preview: bool = False

    def share(self, df: DataFrame) -> DataFrame:
        """Keep a branch that several sinks use, on disk where memory is short."""
        self.kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self.kept[-1]

    def checkpoint(self, df: DataFrame, name: str) -> DataFrame:
        """Write a branch to the flow's checkpoint of that name, if it has one, and go on from what is read back."""
        if name not in self.checkpoints or self.preview:
            return df
        self.checkpoints[name].write(df)
        return self.checkpoints[name].read(self.spark)


@dataclass(frozen=True)
class Stats:
    seconds: float
    counters: dict[str, int]
    sinks: dict[str, dict[str, int]]

    def counter(self, group: str, name: str) -> int:
        return self.counters.get(f"{group}->{name}", 0)


@dataclass
class Flow:
    """``assembly`` maps the sources' datasets to one for each sink and trap, by name."""

    name: str
    sources: dict[str, Tap]
    sinks: dict[str, Tap]
    assembly: Assembly
    traps: dict[str, Tap] = field(default_factory=dict)
    checkpoints: dict[str, Tap] = field(default_factory=dict)
    config: Config = field(default_factory=Config)
    assertions: Level = Level.STRICT
    debugging: Level = Level.NONE
    #: Sinks whose rows come in an order to be kept.
    ordered: frozenset[str] = frozenset()

    def __post_init__(self):
        self.tag = f"{self.name}-{uuid.uuid4().hex}"

    def validate(self, spark: SparkSession | None = None) -> None:
        """What can be seen without running: names, and places that would be read and written at once.

        A place inside another counts as that one. With a session, places are compared as its file systems see them.
        """
        if not self.sources or not self.sinks:
            raise FlowError(f"flow {self.name} needs a source and a sink")
        if clash := set(self.sinks) & set(self.traps):
            raise FlowError(f"{sorted(clash)} are both sinks and traps")
        written: dict[str, str] = {}
        for n, tap in [*self.sinks.items(), *self.traps.items(), *self.checkpoints.items()]:
            own = tap.place(spark)
            if other := next((m for at, m in written.items() if _overlap(own, at)), None):
                raise FlowError(f"{n} and {other} write to {tap.path}")
            written[own] = n
        for n, tap in self.sources.items():
            if other := next((m for at, m in written.items() if _overlap(tap.place(spark), at)), None):
                raise FlowError(f"source {n} reads what {other} writes: {tap.path}")
        if unknown := self.ordered - set(self.sinks):
            raise FlowError(f"no sinks {sorted(unknown)}")

    def _plan(self, spark: SparkSession, preview: bool = False) -> tuple[dict[str, DataFrame], Context]:
        self.validate(spark)
        context = Context(spark, self.config, Counters(), self.assertions, Level.NONE if preview else self.debugging, checkpoints=self.checkpoints, preview=preview)
        inputs = {}
        for n, tap in self.sources.items():
            with self._config_of(tap).held(spark):
                inputs[n] = tap.read(spark)
        if (n := self.config.get("source.parts")) is not None:
            inputs = {k: df.repartition(int(n)) for k, df in inputs.items()}
        out = self.assembly(inputs, context)
        wanted = {*self.sinks, *self.traps}
        if missing := wanted - set(out):
            raise FlowError(f"the assembly has nothing for {sorted(missing)}")
        if loose := set(out) - wanted:
            raise FlowError(f"{sorted(loose)} lead nowhere")
        for n, df in out.items():
            if isinstance(df, Grouped):
                raise FlowError(f"{n} gets a group without an aggregator or a buffer")
            if not isinstance(df, DataFrame):
                raise FlowError(f"{n} gets a {type(df).__name__}, not a dataset")
        return out, context

    def _config_of(self, tap: Tap) -> Config:
        """The flow's settings under those of a tap."""
        return self.config if tap.layer is None else self.config.with_layer(tap.layer)

    def preview(self, spark: SparkSession, mode: str = "formatted") -> dict[str, str]:
        """Every sink's plan as text. Nothing is run and nothing written: checkpoints and debug levels are left out."""
        with self.config.held(spark):
            out, context = self._plan(spark, preview=True)
            plans = {n: df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode) for n, df in out.items()}
            for df in context.kept:
                df.unpersist()
        return plans

    def run(self, spark: SparkSession) -> Stats:
        """Delete what is to be replaced, write all sinks and traps, and tell what was counted."""
        began = time.time()
        self.validate(spark)
        for tap in [*self.sinks.values(), *self.traps.values(), *self.checkpoints.values()]:
            if tap.mode is SinkMode.REPLACE:
                tap.delete(spark)
        with self.config.held(spark):
            spark.sparkContext.addJobTag(self.tag)
            spark.sparkContext.setInterruptOnCancel(True)
            context = None
            try:
                out, context = self._plan(spark)
                for n, tap in [*self.sinks.items(), *self.traps.items()]:
                    with self._config_of(tap).held(spark):
                        tap.write(out[n], ordered=n in self.ordered)
            finally:
                spark.sparkContext.removeJobTag(self.tag)
                spark.sparkContext.setInterruptOnCancel(False)
                for df in context.kept if context else ():
                    df.unpersist()
        return Stats(time.time() - began, context.counters.values(), {n: tap.statistics(spark) for n, tap in self.sinks.items()})

    def cancel(self, spark: SparkSession) -> None:
        """Stop this flow's jobs, from another thread."""
        spark.sparkContext.cancelJobsWithTag(self.tag)
