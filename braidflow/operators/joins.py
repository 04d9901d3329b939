"""Joins on equal keys: co-groups of any number of inputs, broadcast joins, cross products, buffer joins, custom joiners.

Null keys are equal to each other unless ``keys_not_null`` says that there are
none, which lets Spark reuse a partitioning by the key. ``comparators`` gives,
for each place of the key, a canonical form that decides whether keys are equal
(None: the key itself). Fields of the result are ``<input>_<field>`` for named
inputs; ``_key_<i>`` is the key of whichever input has the row;
``<input>_present`` tells an absent side from one full of nulls. Inputs and
fields whose names would make two such names equal are rejected.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from braidflow.fields import FieldError, col, distinct, fresh, quoted, resolve
from braidflow.operators.streams import as_batches, by_group, frame_of, frames_of, over_frames
from braidflow.sources.scratch import scratch

#: Bytes of an input up to which it may be sent whole to every executor. Spark's estimate counts files as they are
#: compressed; in memory an input may be ten times as large.
BROADCAST_LIMIT = 16 << 20


def estimated_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The input marked for broadcast if it is known to be small; otherwise as it is, for a shuffled join."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


Comparators = Sequence[Callable[[str], Column] | None]


class _Names:
    """The names of a join's result, checked, and a prefix for its own fields that none of them begins with."""

    def __init__(self, inputs: dict[str, DataFrame], n_keys: int, flags: bool):
        self.keys = [f"_key_{i}" for i in range(n_keys)]
        self.fields = {n: [f"{n}_{c}" for c in df.columns] for n, df in inputs.items()}
        self.flags = [f"{n}_present" for n in inputs] if flags else []
        every = [*self.keys, *(c for own in self.fields.values() for c in own), *self.flags]
        distinct(every)
        self.prefix = "__"
        while any(c.startswith(self.prefix) for c in every):
            self.prefix += "_"

    def own(self, what: str) -> str:
        return f"{self.prefix}{what}"

    def tagged(self, df: DataFrame, name: str, at: int, keys: Sequence[str], how: Comparators) -> DataFrame:
        """An input under the result's names, with its canonical keys, its keys where those differ, and its presence."""
        own = [col(c).alias(a) for c, a in zip(df.columns, self.fields[name], strict=True)]
        canonical = [(h(quoted(k)) if h else col(k)).alias(self.own(f"{at}_key_{i}")) for i, (k, h) in enumerate(zip(keys, how, strict=True))]
        shown = [col(k).alias(self.own(f"{at}_shown_{i}")) for i, (k, h) in enumerate(zip(keys, how, strict=True)) if h]
        return df.select(*own, *canonical, *shown, F.lit(True).alias(self.own(f"{at}_here")))

    def moved(self, at: int | str, to: int | str, how: Comparators, value: Callable[[str, str], Column]) -> dict[str, Column]:
        """The running keys, canonical and shown, given by ``value`` from the names in ``to`` and ``at``."""
        kinds = [f"key_{i}" for i in range(len(how))] + [f"shown_{i}" for i, h in enumerate(how) if h]
        return {self.own(f"{to}_{k}"): value(self.own(f"{to}_{k}"), self.own(f"{at}_{k}")) for k in kinds}

    def result(self, df: DataFrame, how: Comparators) -> DataFrame:
        keys = [col(self.own(f"run_{'shown' if h else 'key'}_{i}")).alias(k) for i, (k, h) in enumerate(zip(self.keys, how, strict=True))]
        here = [F.coalesce(col(self.own(f"{at}_here")), F.lit(False)).alias(n) for at, n in enumerate(self.flags)]
        return df.select(*keys, *[col(c) for own in self.fields.values() for c in own], *here)


def _comparators(given: Comparators | None, n_keys: int) -> Comparators:
    if given is not None and len(given) != n_keys:
        raise FieldError(f"{len(given)} comparators for a key of {n_keys} fields")
    return list(given) if given is not None else [None] * n_keys


def _inputs(inputs: dict[str, DataFrame], keys) -> tuple[list[str], dict[str, list[str]]]:
    if len(inputs) < 2:
        raise FieldError("a join needs two inputs")
    per = keys if isinstance(keys, dict) else {n: keys for n in inputs}
    names = {n: resolve(per[n], df.columns) for n, df in inputs.items()}
    if len({len(k) for k in names.values()}) != 1:
        raise FieldError(f"keys of different lengths: {names}")
    return list(inputs), names


def _equal(a: Column, b: Column, not_null: bool) -> Column:
    return a == b if not_null else a.eqNullSafe(b)


_POLICIES: dict[str, Callable[[int], list[bool]]] = {
    "inner": lambda n: [True] * n,
    "full": lambda n: [False] * n,
    "left": lambda n: [True] + [False] * (n - 1),
    "right": lambda n: [False] * (n - 1) + [True],
}


def required(policy: str | Sequence[bool], n: int) -> list[bool]:
    """Which sides must be present: by name of the join, or one flag for each side."""
    if isinstance(policy, str):
        if policy not in _POLICIES:
            raise FieldError(f"no join policy {policy!r}")
        return _POLICIES[policy](n)
    if len(policy) != n:
        raise FieldError(f"{len(policy)} flags for {n} inputs")
    return [bool(x) for x in policy]


def cogroup(inputs: dict[str, DataFrame], keys, policy: str | Sequence[bool] = "inner", *, keys_not_null: bool = False, flags: bool = False, comparators: Comparators | None = None) -> DataFrame:
    """Join any number of inputs on one key. ``keys`` is one selector for all inputs or one for each by name.

    ``policy`` is inner, left, right or full, or a flag for each side that must be present. The narrowest join that
    gives the rows is planned: a side is kept whole only if the policy can let the other be absent.
    """
    names, own = _inputs(inputs, keys)
    must, n_keys = required(policy, len(names)), len(next(iter(own.values())))
    if not n_keys:
        if not all(must):
            raise FieldError("inputs without keys can only be crossed: every side must be present")
        return cross(inputs, flags=flags)
    how_equal, made = _comparators(comparators, n_keys), _Names(inputs, n_keys, flags)
    any_name = made.own("any")
    out = made.tagged(inputs[names[0]], names[0], 0, own[names[0]], how_equal)
    out = out.withColumns(made.moved(0, "run", how_equal, lambda _, new: col(new)) | {any_name: F.lit(True)})
    for at, name in enumerate(names[1:], 1):
        right = made.tagged(inputs[name], name, at, own[name], how_equal)
        on = reduce(Column.__and__, [_equal(col(made.own(f"run_key_{i}")), col(made.own(f"{at}_key_{i}")), keys_not_null) for i in range(n_keys)])
        left_needed, right_needed = any(must[:at]), must[at]
        how = "inner" if left_needed and right_needed else "left" if left_needed else "right" if right_needed else "full"
        out = out.join(right, on, how)
        if how == "right":
            out = out.withColumns(made.moved(at, "run", how_equal, lambda _, new: col(new)))
        elif how == "full":  # by presence: a key may be null on a side that is there
            here = F.coalesce(col(any_name), F.lit(False))
            out = out.withColumns(made.moved(at, "run", how_equal, lambda old, new, here=here: F.when(here, col(old)).otherwise(col(new))))
        out = out.withColumn(any_name, F.lit(True))
    if not all(must) and any(must):
        out = out.where(reduce(Column.__and__, [F.coalesce(col(made.own(f"{at}_here")), F.lit(False)) for at, m in enumerate(must) if m]))
    return made.result(out, how_equal)


def self_join(df: DataFrame, copies: int, keys, policy="inner", **options) -> DataFrame:
    """An input joined with itself: ``copies`` sides named a, b, ..."""
    return cogroup({chr(97 + i): df for i in range(copies)}, keys, policy, **options)


def cross(inputs: dict[str, DataFrame], *, limit: int = BROADCAST_LIMIT, flags: bool = False) -> DataFrame:
    """The product of the inputs. A further input is sent whole to every executor if it is small; else the partitions of
    both sides meet in pairs, each in a task of its own."""
    names = list(inputs)
    if len(names) < 2:
        raise FieldError("a product needs two inputs")
    made = _Names(inputs, 0, flags)
    plain = lambda n: inputs[n].select(*[col(c).alias(a) for c, a in zip(inputs[n].columns, made.fields[n], strict=True)])
    out = plain(names[0])
    for n in names[1:]:
        out = out.crossJoin(small(plain(n), limit))
    return out.withColumns({f: F.lit(True) for f in made.flags}) if flags else out


def hash_join(inputs: dict[str, DataFrame], keys, policy: str = "inner", *, keys_not_null: bool = False, limit: int = BROADCAST_LIMIT, flags: bool = False, comparators: Comparators | None = None) -> DataFrame:
    """Stream the first input and look up all others by its key, without moving it.

    Others are broadcast while Spark's estimate of their size is within ``limit``; a larger one is joined by a shuffle.
    inner and left are for any number of inputs, and left is left for each of them.
    """
    if policy not in ("inner", "left"):
        raise FieldError("a streamed input can only be joined inner or left; use cogroup for others")
    names, own = _inputs(inputs, keys)
    n_keys = len(own[names[0]])
    if not n_keys:
        return cross(inputs, limit=limit, flags=flags)
    how_equal, made = _comparators(comparators, n_keys), _Names(inputs, n_keys, flags)
    out = made.tagged(inputs[names[0]], names[0], 0, own[names[0]], how_equal)
    out = out.withColumns(made.moved(0, "run", how_equal, lambda _, new: col(new)))
    for at, name in enumerate(names[1:], 1):
        right = small(made.tagged(inputs[name], name, at, own[name], how_equal), limit)
        on = reduce(Column.__and__, [_equal(col(made.own(f"run_key_{i}")), col(made.own(f"{at}_key_{i}")), keys_not_null) for i in range(n_keys)])
        out = out.join(right, on, policy)
    return made.result(out, how_equal)


def semi(left: DataFrame, right: DataFrame, keys, *, anti: bool = False) -> DataFrame:
    """The left rows that have (``anti``: do not have) a right row with their key."""
    names = resolve(keys, left.columns)
    others = {k: fresh(f"_r_{k}", left.columns) for k in resolve(keys, right.columns)}
    other = right.select(*[col(k).alias(a) for k, a in others.items()])
    on = reduce(Column.__and__, [col(k).eqNullSafe(col(others[k])) for k in names])
    return left.join(other, on, "left_anti" if anti else "left_semi")


Joiner = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def custom_join(inputs: dict[str, DataFrame], keys, joiner: Joiner, schema: str | StructType, **options) -> DataFrame:
    """A joiner of the user's over every combination of a full co-group, with presence flags, in batches of rows."""
    return over_frames(cogroup(inputs, keys, "full", flags=True, **options), joiner, schema)


#: Rows of one side of one key that a buffer join holds in memory; what is beyond goes to a file.
SPILL_ROWS = 10_000


class Side:
    """The rows of a key on one of a buffer join's further inputs: their number, and their frames as often as asked for.

    Up to ``SPILL_ROWS`` rows are held; the rest is in a file below the shared folder, read batch by batch. All of a
    frame's own attributes work on ``whole()``, which reads everything into memory.
    """

    def __init__(self, schema: pa.Schema, place: str, rows: int = SPILL_ROWS):
        self._schema, self._place, self._most, self._n = schema, place, rows, 0
        self._held: list[pa.RecordBatch] = []
        self._file, self._out, self._whole = None, None, None

    def _add(self, batch: pa.RecordBatch) -> None:
        self._n += batch.num_rows
        if self._n <= self._most:
            self._held.append(batch)
            return
        if self._out is None:
            system, at = fs.FileSystem.from_uri(self._place)
            system.create_dir(at, recursive=True)
            self._file = (system, f"{at}/{uuid.uuid4().hex}.arrow")
            self._out = pa.ipc.new_stream(system.open_output_stream(self._file[1]), self._schema)
        self._out.write_batch(batch)

    def _batches(self) -> Iterator[pa.RecordBatch]:
        yield from self._held
        if self._file is not None:
            with self._file[0].open_input_stream(self._file[1]) as f:
                yield from pa.ipc.open_stream(f)

    def _sealed(self) -> Side:
        if self._out is not None:
            self._out.close()
            self._out = None
        return self

    def _drop(self) -> None:
        self._sealed()
        if self._file is not None:
            self._file[0].delete_file(self._file[1])
            self._file = None

    def __len__(self) -> int:
        return self._n

    def __iter__(self) -> Iterator[pd.DataFrame]:
        return map(frame_of, self._batches())

    def whole(self) -> pd.DataFrame:
        if self._whole is None:
            self._whole = frame_of(pa.Table.from_batches(self._batches(), self._schema))
        return self._whole

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        return getattr(self.whole(), name)

    def __getitem__(self, key):
        return self.whole()[key]


Buffer = Callable[[tuple, Iterator[pd.DataFrame], list[Side]], Iterable[pd.DataFrame] | pd.DataFrame | None]


def buffer_join(inputs: dict[str, DataFrame], keys, f: Buffer, schema: str | StructType, *, comparators: Comparators | None = None, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """User code over all inputs' rows of a key: ``f(key, first, others)``.

    The inputs are tagged, merged and sorted so that a key's rows of the first input come last and stream by, whatever
    their number. Those of each other input are a ``Side``, which holds ``spill_rows`` of them and has the rest on disk.
    Without keys all rows meet in one task and the key is empty. A key of only some inputs has empty sides for the
    others. With comparators the key is given in its canonical form.
    """
    names, own = _inputs(inputs, keys)
    n_keys = len(own[names[0]])
    how = _comparators(comparators, n_keys)
    key_names = [f"key_{i}" for i in range(n_keys)]
    whole = {n: StructType(inputs[n].schema.fields) for n in names}
    place = scratch(inputs[names[0]].sparkSession, "spill")

    def tagged(at: int, n: str) -> DataFrame:
        sides = [F.struct(*map(col, inputs[n].columns)).alias(f"in_{i}") if m == n else F.lit(None).cast(whole[m]).alias(f"in_{i}") for i, m in enumerate(names)]
        return inputs[n].select(*[(h(quoted(k)) if h else col(k)).alias(a) for k, a, h in zip(own[n], key_names, how, strict=True)], F.lit(at).alias("side"), *sides)

    rows = reduce(DataFrame.unionAll, [tagged(i, n) for i, n in enumerate(names)])
    dealt = rows.repartition(*key_names) if key_names else rows.repartition(1)
    ordered = dealt.sortWithinPartitions(*key_names, F.desc("side"))
    target = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)
    schemas = [to_arrow_schema(whole[n]) for n in names]

    def prepare(b):
        """Each side's rows of the batch; a slice is one batch for each side in it, last side first."""
        sides = b.column("side").to_numpy()
        batches, before = {}, {}
        for i in np.unique(sides):
            own = sides == i
            column = b.column(f"in_{i}").filter(pa.array(own))
            batches[i] = pa.RecordBatch.from_arrays(column.flatten(), schema=schemas[i])
            before[i] = np.concatenate(([0], np.cumsum(own)))
        frame = frame_of(batches[0]) if 0 in batches else None  # the first input's rows go out as frames, converted once
        part = lambda i, a, z: frame.iloc[a:z] if i == 0 else batches[i].slice(a, z - a)
        return lambda a, z: [(i, part(i, before[i][a], before[i][z])) for i in sorted(batches, reverse=True) if before[i][z] > before[i][a]]

    def run(batches):
        def one(key, slices):
            others = [Side(schemas[i], place, spill_rows) for i in range(1, len(names))]
            ahead: list[pd.DataFrame] = []
            for part in slices:
                for i, some in part:
                    if i:
                        others[i - 1]._add(some)
                    else:
                        ahead.append(some)
                if ahead:
                    break

            def first():
                yield from ahead
                for part in slices:
                    yield from (frame for _, frame in part)

            try:
                yield from frames_of(f(key, first(), [x._sealed() for x in others]))
            finally:
                for x in others:
                    x._drop()

        return as_batches(by_group(batches, key_names, prepare, one), target)

    return ordered.mapInArrow(run, schema)
