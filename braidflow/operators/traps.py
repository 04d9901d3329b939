"""Traps: rows that an operation cannot take go to a side output with the reason; the others go on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from braidflow.fields import distinct
from braidflow.functions import expression
from braidflow.operators.streams import map_batches


@dataclass(frozen=True)
class Trapped:
    good: DataFrame
    bad: DataFrame


def trap(df: DataFrame, reason: str = "trap_reason", **checks: str | Column) -> Trapped:
    """Split by named conditions: a row is bad under the first one that is not true for it. Conditions must not raise: use ``try_`` functions.

    ``reason`` must be no field of the rows: bad rows have all their fields and that one.
    """
    distinct([*df.columns, reason])
    failed = F.coalesce(*[F.when(~F.coalesce(expression(c), F.lit(False)), F.lit(n)) for n, c in checks.items()])
    marked = df.withColumn(reason, failed)
    return Trapped(marked.where(F.col(reason).isNull()).drop(reason), marked.where(F.col(reason).isNotNull()))


def trapped_map(df: DataFrame, f: Callable[[dict], list[dict] | None], schema: str | StructType, reason: str = "trap_reason") -> Trapped:
    """User code row by row that may raise. Both outputs come from the same operation; persist ``df`` or settle the result if both are used.

    ``f`` gets a row as a dictionary of plain Python values and returns rows; a row that gives values of other types than
    the schema's is trapped too. Running out of memory is never trapped.
    """
    distinct([*df.columns, reason])
    target = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    both = StructType([StructField("row", df.schema), StructField("out", target), StructField("reason", StringType())])
    arrow = to_arrow_schema(both)
    one = arrow.field("out").type

    def checked(row: dict) -> tuple[list, str | None]:
        try:
            made = list(f(row) or ())
            pa.array(made, one)
            return made, None
        except MemoryError:
            raise
        except Exception as e:
            return [], f"{type(e).__name__}: {e}"

    def run(batches):
        for b in batches:
            rows, made, reasons = [], [], []
            for row in b.to_pylist():
                out, why = checked(row)
                rows += [None] * len(out) if why is None else [row]
                made += out if why is None else [None]
                reasons += [why] * (len(out) if why is None else 1)
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip((rows, made, reasons), arrow, strict=True)], schema=arrow)

    out = map_batches(df, run, both)
    good, bad = F.col("reason").isNull(), F.col("reason").isNotNull()
    return Trapped(out.where(good).select("out.*"), out.where(bad).select("row.*", F.col("reason").alias(reason)))
