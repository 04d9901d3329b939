"""Grouping: keyed or global, merged inputs, secondary sort, aggregators, buffers and windows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from braidflow.fields import NONE, FieldError, col, distinct, fresh, quoted, resolve
from braidflow.functions import expression
from braidflow.operators.sets import merge
from braidflow.operators.streams import as_batches, by_group, frame_of, frames_of, map_batches


#: A field (ascending), ``(field, descending)`` or ``(field, descending, comparator)``, whose canonical form gives the order.
Sort = str | tuple[str, bool] | tuple[str, bool, Callable[[str], Column]]


def _field(spec: Sort) -> str:
    return spec if isinstance(spec, str) else spec[0]


def _order(spec: Sort, reverse: bool) -> Column:
    """Ascending with nulls first, descending with nulls last; ``reverse`` turns all directions."""
    name, down, *how = (spec, False) if isinstance(spec, str) else spec
    value = how[0](quoted(name)) if how else col(name)
    return value.desc_nulls_last() if down != reverse else value.asc_nulls_first()


@dataclass(frozen=True)
class Grouped:
    """A grouping that is not yet reduced. Null keys form one group. A global group of no rows is no group."""

    df: DataFrame
    keys: list[str]
    sort: list = field(default_factory=list)
    reverse: bool = False
    canonical: dict[str, Column] = field(default_factory=dict)

    def _key(self, name: str) -> Column:
        return self.canonical.get(name, col(name))

    def every(self, **aggregators: str | Column) -> DataFrame:
        """One row for each group: its keys and the aggregators' values, computed before the shuffle as far as they can be.

        Keys with a comparator are shown by their smallest original value.
        """
        if not aggregators:
            raise FieldError("a group needs an aggregator or a buffer")
        distinct([*self.keys, *aggregators])
        made = [expression(e).alias(n) for n, e in aggregators.items()]
        names = [fresh(f"_key_{i}", [*self.keys, *aggregators]) for i in range(len(self.keys) or 1)]
        if not self.keys:
            return self.df.groupBy(F.lit(1).alias(names[0])).agg(*made).drop(names[0])
        if not self.canonical:
            return self.df.groupBy(*map(col, self.keys)).agg(*made)
        shown = [F.min(col(k)).alias(k) for k in self.keys]
        return self.df.groupBy(*[self._key(k).alias(n) for k, n in zip(self.keys, names, strict=True)]).agg(*shown, *made).drop(*names)

    def window(self) -> WindowSpec:
        """The group in its order, for analytic functions."""
        spec = Window.partitionBy(*[self._key(k) for k in self.keys])
        return spec.orderBy(*[_order(s, self.reverse) for s in self.sort]) if self.sort else spec

    def analytic(self, **functions: Callable[[WindowSpec], Column]) -> DataFrame:
        """All rows with new fields computed over their group: what most buffers do, without leaving Spark's own operators."""
        spec = self.window()
        distinct([*self.df.columns, *functions])
        return self.df.select("*", *[f(spec).alias(n) for n, f in functions.items()])

    def top(self, n: int, rank: str | None = None) -> DataFrame:
        """The first ``n`` rows of each group in its order; partitions are cut to ``n`` before the shuffle."""
        if not self.sort:
            raise FieldError("an order is needed")
        if rank:
            distinct([*self.df.columns, rank])
        name = rank or fresh("_rank", self.df.columns)
        out = self.df.withColumn(name, F.row_number().over(self.window()).cast("long")).where(F.col(name) <= n)
        return out if rank else out.drop(name)

    def collected(self, name: str, *columns: str) -> DataFrame:
        """Each group's rows as an ordered array of structs."""
        if any(not isinstance(s, str) and (s[1] or len(s) > 2) for s in self.sort):
            raise FieldError("arrays are ordered ascending, or by reverse descending")
        lead = list(map(_field, self.sort))
        one = F.struct(*map(col, [*lead, *[c for c in columns if c not in lead]]))
        return self.every(**{name: F.sort_array(F.collect_list(one), asc=not self.reverse)})

    def ordered(self, parts: int | None = None) -> DataFrame:
        """The rows with each group together and in order, ready for a sink that must keep the order."""
        keys = [self._key(k) for k in self.keys]
        if not keys:
            return self.df.orderBy(*[_order(s, self.reverse) for s in self.sort])
        df = self.df.repartition(parts, *keys) if parts else self.df.repartition(*keys)
        lead = [k.desc_nulls_last() if self.reverse else k.asc_nulls_first() for k in keys]
        return df.sortWithinPartitions(*lead, *[_order(s, self.reverse) for s in self.sort])

    def buffer(self, f: Callable[[tuple, Iterator[pd.DataFrame]], Iterable[pd.DataFrame] | pd.DataFrame | None], schema: str | StructType) -> DataFrame:
        """User code over each whole group: ``f(key, frames)`` reads the rows in order and gives any rows.

        Groups come as streams out of a sort that spills, so a large group is never held by this operator. A global
        buffer sees all rows in one task. Whole numbers and truth values come in pandas' nullable types. A key with a
        comparator is given in its canonical form.
        """
        target = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)
        names = [fresh(f"_key_{i}", self.df.columns) for i in range(len(self.keys))]
        marked = self.df.select("*", *[self._key(k).alias(n) for k, n in zip(self.keys, names, strict=True)])
        dealt = marked.repartition(*map(col, names)) if names else marked.repartition(1)
        lead = [col(n).desc_nulls_last() if self.reverse else col(n).asc_nulls_first() for n in names]
        order = lead + [_order(s, self.reverse) for s in self.sort]
        rows = dealt.sortWithinPartitions(*order) if order else dealt

        def prepare(b):
            frame = frame_of(b.drop_columns(names) if names else b)
            return lambda a, z: frame.iloc[a:z]

        def run(batches):
            return as_batches(by_group(batches, names, prepare, lambda key, frames: frames_of(f(key, frames))), target)

        return map_batches(rows, run, schema)


def group_by(inputs: DataFrame | Sequence[DataFrame], keys=NONE, sort: Sequence = (), *, reverse: bool = False, comparators: dict[str, Callable[[str], Column]] | None = None) -> Grouped:
    """Group one input, or several merged by position, by ``keys`` (NONE: one global group).

    ``sort`` orders the rows of a group: field names (ascending), ``(field, descending)``, or both with a comparator. ``reverse`` turns
    keys and order around. ``comparators`` gives a key's canonical form; rows are together if those are equal.
    """
    df = inputs if isinstance(inputs, DataFrame) else inputs[0] if len(inputs) == 1 else merge(*inputs)
    names = resolve(keys, df.columns)
    resolve(list(map(_field, sort)), df.columns)
    if unknown := set(comparators or ()) - set(names):
        raise FieldError(f"comparators for {sorted(unknown)}, which are no keys")
    return Grouped(df, names, list(sort), reverse, {k: c(quoted(k)) for k, c in (comparators or {}).items()})


def aggregate_by(df: DataFrame, keys, **aggregators: str | Column) -> DataFrame:
    """Aggregators with partial results on the map side."""
    return group_by(df, keys).every(**aggregators)


def count_by(df: DataFrame, keys, name: str = "count") -> DataFrame:
    return aggregate_by(df, keys, **{name: F.count("*")})


def total_sort(df: DataFrame, *sort, reverse: bool = False) -> DataFrame:
    """All rows in one order over all partitions, dealt by ranges."""
    return df.orderBy(*[_order(s, reverse) for s in sort])
