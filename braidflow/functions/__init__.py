"""Expressions for row operations and groupings. Any Spark function or SQL expression string is as welcome."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def expression(e: str | Column) -> Column:
    """A column from SQL text, or the column itself."""
    return F.expr(e) if isinstance(e, str) else e


def regex_split_generator(column: str | Column, pattern: str) -> Column:
    """One row for each part of a text between matches of ``pattern``."""
    return F.explode(F.split(column if isinstance(column, Column) else F.col(column), pattern))


def regex_filter(column: str, pattern: str) -> Column:
    return F.col(column).rlike(pattern)


def regex_parser(column: str, pattern: str, group: int = 1) -> Column:
    """The part of the first match that ``group`` captured, null without a match."""
    found = F.regexp_extract(column, pattern, group)
    return F.when(F.col(column).rlike(pattern), found)


def cents(column: str | Column) -> Column:
    """An amount in whole hundredths, so that sums do not depend on their order."""
    return F.round((F.col(column) if isinstance(column, str) else column) * 100).cast("long")


# Comparators as canonical keys: values that compare as equal have equal keys.


def ignoring_case(column: str) -> Column:
    return F.lower(F.col(column))


def rounded_to(step: float) -> Callable[[str], Column]:
    return lambda column: F.floor(F.col(column) / step)
