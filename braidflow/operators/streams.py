"""Groups as streams: rows sorted by key within partitions, handed to user code group by group without holding a group."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: User frames are gathered up to so many rows or frames before they are converted.
ROWS, FRAMES = 20_000, 2_000


_NULLABLE = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype(), pa.bool_(): pd.BooleanDtype()}


def frame_of(batch: pa.RecordBatch | pa.Table) -> pd.DataFrame:
    """The rows as pandas has them, whole numbers and truth values in types that hold nulls beside exact values."""
    return batch.to_pandas(types_mapper=_NULLABLE.get)


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``f`` over each partition's batches, whatever the fields' names hold: on the way they are numbered."""
    names = df.columns
    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(lambda batches: f(b.rename_columns(names) for b in batches), schema)


def over_frames(df: DataFrame, f: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | StructType) -> DataFrame:
    """User code from frames to frames, over each partition's batches."""
    target = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)
    return map_batches(df, lambda batches: as_batches(f(frame_of(b) for b in batches), target), schema)


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; null equals null and NaN equals NaN."""
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    if pa.types.is_nested(column.type):
        x = column.to_pylist()
        return np.array([p != q for p, q in zip(x, x[1:], strict=False)], bool)
    differ = pc.fill_null(pc.not_equal(a, b), True).to_numpy(zero_copy_only=False)
    same = pc.and_(a.is_null(), b.is_null())
    if pa.types.is_floating(column.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return differ & ~same.to_numpy(zero_copy_only=False)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], prepare: Callable[[pa.RecordBatch], Callable[[int, int], Any]]) -> Iterator[tuple[tuple, Any]]:
    """Consecutive slices of equal keys; a group over several batches comes as several slices."""
    for b in batches:
        if not b.num_rows:
            continue
        cut = np.zeros(b.num_rows - 1, bool)
        for k in keys:
            cut |= _changes(b.column(k))
        starts = [0, *(np.flatnonzero(cut) + 1).tolist()]
        values = [b.column(k).take(pa.array(starts)).to_pylist() for k in keys]
        part = prepare(b)
        for i, (a, z) in enumerate(zip(starts, [*starts[1:], b.num_rows], strict=True)):
            yield tuple(v[i] for v in values), part(a, z)


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str], prepare: Callable[[pa.RecordBatch], Callable[[int, int], Any]], f: Callable[[tuple, Iterator], Iterable]) -> Iterator:
    """Call ``f(key, slices)`` for each group in order. What ``f`` leaves unread of a group is skipped.

    ``prepare`` turns a batch into a function that gives its rows from one place to another, so that a batch is
    converted once, however many groups it holds.
    """
    runs = _runs(batches, keys, prepare)
    ahead = next(runs, None)
    plain = lambda key: tuple("nan" if x != x else x for x in key)
    while ahead is not None:
        key, here = ahead[0], plain(ahead[0])

        def group(here=here):
            nonlocal ahead
            while ahead is not None and plain(ahead[0]) == here:
                now = ahead[1]
                ahead = next(runs, None)
                yield now

        own = group()
        yield from f(key, own)
        for _ in own:
            pass


def frames_of(out: Iterable[pd.DataFrame] | pd.DataFrame | None) -> Iterable[pd.DataFrame]:
    return () if out is None else (out,) if isinstance(out, pd.DataFrame) else out


def as_batches(frames: Iterable[pd.DataFrame], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """User frames as record batches of the declared schema, fields by name; small frames are converted together."""
    held, rows = [], 0

    def flush():
        whole = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        return pa.Table.from_pandas(whole[schema.names], schema=schema, preserve_index=False).to_batches()

    for x in frames:
        if len(x):
            held.append(x)
            rows += len(x)
            if rows >= ROWS or len(held) >= FRAMES:
                yield from flush()
                held, rows = [], 0
    if held:
        yield from flush()
