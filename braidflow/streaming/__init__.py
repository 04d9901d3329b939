"""A flow's assembly over arriving files: each micro-batch is a run of the same operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from braidflow.sources.taps import SinkMode, Tap


def run_on_arrival(spark: SparkSession, source: Tap, assembly: Callable[[DataFrame], DataFrame], sink: Tap, checkpoint: str) -> StreamingQuery:
    """Apply ``assembly`` to all files that arrived since the last call, then stop.

    Each micro-batch has a folder of its own below the sink and overwrites it, so a batch that runs again after a
    failure does not add its rows twice.
    """

    def write(df: DataFrame, batch: int) -> None:
        Tap(f"{sink.path}/batch={batch}", sink.format, sink.options, mode=SinkMode.REPLACE).write(assembly(df))

    return source.stream(spark).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
