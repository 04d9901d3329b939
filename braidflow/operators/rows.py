"""Row operations: each row gives any number of rows, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from enum import IntEnum

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from braidflow.fields import ALL, NONE, RESULTS, FieldError, col, distinct, resolve
from braidflow.functions import expression
from braidflow.operators.streams import over_frames


class Level(IntEnum):
    """How strict a flow is: operations above its level are left out of the plan."""

    NONE = 0
    VALID = 1
    STRICT = 2


def each(df: DataFrame, output=ALL, **results: str | Column) -> DataFrame:
    """Apply functions: ``results`` are the new fields, ``output`` which fields survive.

    ALL keeps the inputs and adds the results, which must be new; RESULTS keeps the results alone; a list of names or
    positions picks from both.
    """
    made = {n: expression(e).alias(n) for n, e in results.items()}
    if output is RESULTS:
        return df.select(*made.values())
    have = {c.lower() for c in df.columns}
    if clash := [n for n in made if n.lower() in have]:
        raise FieldError(f"the results {clash} are fields already; select RESULTS or use replace()")
    distinct(list(made))
    wide = df.select("*", *made.values())
    return wide if output is ALL else project(wide, output)


def replace(df: DataFrame, **results: str | Column) -> DataFrame:
    """Fields given a new value in place."""
    resolve(list(results), df.columns)
    made = {n: expression(e).alias(n) for n, e in results.items()}
    return df.select(*[made.get(c, col(c)) for c in df.columns])


def keep(df: DataFrame, condition: str | Column) -> DataFrame:
    """The rows for which the condition is true."""
    return df.where(expression(condition))


def discard(df: DataFrame, condition: str | Column) -> DataFrame:
    """The rows for which the condition is not true; rows where it is null stay."""
    return df.where(~F.coalesce(expression(condition), F.lit(False)))


def project(df: DataFrame, selector) -> DataFrame:
    if selector is NONE:
        raise FieldError("a projection needs a field")
    return df.select(*map(col, resolve(selector, df.columns)))


def rename(df: DataFrame, **names: str) -> DataFrame:
    """``old=new``; no two fields may end up with one name."""
    resolve(list(names), df.columns)
    after = [names.get(c, c) for c in df.columns]
    distinct(after)
    return df.toDF(*after)


def generate(df: DataFrame, output=ALL, **generator: Column) -> DataFrame:
    """One generator (a function from one row to many, such as an explode) as a new field."""
    if len(generator) != 1:
        raise FieldError("exactly one generator for an operation")
    return each(df, output, **generator)


def opaque(df: DataFrame, f: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | StructType, arguments=ALL) -> DataFrame:
    """User code over batches of rows. Nothing is pushed through it, so it gets only its ``arguments``.

    Whole numbers and truth values come in pandas' nullable types, so that they are exact beside nulls.
    """
    return over_frames(df.select(*map(col, resolve(arguments, df.columns))), f, schema)


def assert_that(df: DataFrame, condition: str | Column, message: str = "assertion failed", *, level: Level = Level.VALID, configured: Level = Level.STRICT) -> DataFrame:
    """Fail the flow on a row for which the condition is not true, unless ``level`` is stricter than what is configured.

    The check guards a field of the row, so that no later projection of all fields can drop it.
    """
    if level > configured or not df.columns:
        return df
    good, c = F.coalesce(expression(condition), F.lit(False)), df.columns[0]
    return df.where(F.when(good, True).otherwise(F.raise_error(F.lit(message)).cast("boolean"))).withColumn(c, col(c))


def debug(df: DataFrame, name: str, *, level: Level = Level.STRICT, configured: Level = Level.NONE, show: Callable[[str], None] = print, rows: int = 20) -> DataFrame:
    """Show some rows while a flow is built, if its level asks for it; otherwise nothing is planned or run.

    Showing takes a job of its own. A flow's preview asks for no level.
    """
    if level <= configured:
        show(f"{name}: " + "; ".join(str(r.asDict()) for r in df.take(rows)))
    return df


def slices(df: DataFrame, column: str = "slice") -> DataFrame:
    """The number of the partition that holds each row, as a field."""
    return df.withColumn(column, F.spark_partition_id())
