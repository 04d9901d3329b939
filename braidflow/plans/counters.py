"""Counters: numbers that a flow gathers while it runs, without a pass of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from braidflow.functions import expression


class Counters:
    """Counters by group and name. A counter that nothing counted is 0."""

    def __init__(self):
        self._observed: list[tuple[str, Observation, SparkSession, list[str]]] = []

    def count(self, df: DataFrame, group: str, **names: str | Column) -> DataFrame:
        """Count rows as they pass. A name without an expression's worth, ``name="*"``, counts all of them, a condition those it holds for."""
        own = Observation()
        made = [(F.count(F.lit(1)) if e is None or (isinstance(e, str) and e == "*") else F.count_if(F.coalesce(expression(e), F.lit(False)))).alias(n) for n, e in names.items()]
        self._observed.append((group, own, df.sparkSession, list(names)))
        return df.observe(own, *made)

    def total(self, df: DataFrame, group: str, **sums: str | Column) -> DataFrame:
        """Add up whole numbers as rows pass."""
        own = Observation()
        self._observed.append((group, own, df.sparkSession, list(sums)))
        return df.observe(own, *[F.sum(expression(e)).cast("long").alias(n) for n, e in sums.items()])

    def values(self) -> dict[str, int]:
        """All counters as ``group->name``, as far as what counts them has run; 0 where it has not."""
        out: dict[str, int] = {}
        for spark in {id(x[2]): x[2] for x in self._observed}.values():
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # numbers of runs that have ended are on their way
        for group, own, _, names in self._observed:
            counted = own.get if own._jo is not None and own._jo.future().isCompleted() else {}
            for name in names:
                key = f"{group}->{name}"
                out[key] = out.get(key, 0) + (counted.get(name) or 0)
        return out

    def value(self, group: str, name: str) -> int:
        return self.values().get(f"{group}->{name}", 0)
