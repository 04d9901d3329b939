"""Merges and other operations on whole datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame

from braidflow.fields import FieldError, col, same_shape
from braidflow.functions import expression


def merge(*inputs: DataFrame) -> DataFrame:
    """All rows of two or more inputs, duplicates kept; fields match by position and are named as in the first."""
    if len(inputs) < 2:
        raise FieldError("a merge needs two inputs")
    for x in inputs[1:]:
        same_shape(inputs[0].schema, x.schema)
    return reduce(DataFrame.unionAll, inputs)


def split(df: DataFrame, **conditions: str | Column) -> dict[str, DataFrame]:
    """One branch for each condition over the same rows; a row may go to several or none. Nothing is copied or shuffled."""
    return {n: df.where(expression(c)) for n, c in conditions.items()}


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of some fields, or of all."""
    return (df.select(*map(col, columns)) if columns else df).distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    same_shape(a.schema, b.schema)
    return a.intersect(b)


def subtract(a: DataFrame, b: DataFrame, *, bag: bool = False) -> DataFrame:
    same_shape(a.schema, b.schema)
    return a.exceptAll(b) if bag else a.subtract(b)
