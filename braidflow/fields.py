"""Field lists: names, selectors and declared types of a dataset."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StructType, _parse_datatype_string


@dataclass(frozen=True)
class Selector:
    kind: str

    def __repr__(self):
        return self.kind


#: Every field; no field (a global group or a cross product); only what an operation returns; fields known only at load.
ALL, NONE, RESULTS, UNKNOWN = Selector("ALL"), Selector("NONE"), Selector("RESULTS"), Selector("UNKNOWN")


class FieldError(ValueError):
    """A selector that does not fit the fields, or types that do not fit each other."""


def quoted(name: str) -> str:
    """A field's name as Spark's own expressions take it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, or a longer one that none of ``taken`` equals, upper and lower case alike."""
    have = {x.lower() for x in taken}
    while name.lower() in have:
        name = f"_{name}"
    return name


def distinct(names: Sequence[str]) -> None:
    """Check that no two names are equal, upper and lower case alike, as Spark compares them."""
    seen: set[str] = set()
    for n in names:
        if n.lower() in seen:
            raise FieldError(f"field {n!r} would stand twice in {list(names)}")
        seen.add(n.lower())


def resolve(selector, columns: Sequence[str]) -> list[str]:
    """The names that ``selector`` picks from ``columns``: ALL, NONE, a name, a position (negative from the end), or a list of them."""
    if selector is ALL:
        return list(columns)
    if selector is NONE or selector is None:
        return []
    if isinstance(selector, Selector):
        raise FieldError(f"{selector} does not select from a dataset")
    if not isinstance(selector, (list, tuple)):
        selector = [selector]
    out = []
    for x in selector:
        if isinstance(x, bool) or not isinstance(x, (str, int)):
            raise FieldError(f"{x!r} is neither a name nor a position")
        if isinstance(x, int):
            if not -len(columns) <= x < len(columns):
                raise FieldError(f"position {x} of {len(columns)} fields")
            x = columns[x]
        elif x not in columns:
            raise FieldError(f"no field {x!r} among {list(columns)}")
        if x in out:
            raise FieldError(f"field {x!r} is selected twice")
        out.append(x)
    return out


def kind_of(kind) -> DataType:
    return kind if isinstance(kind, DataType) else _parse_datatype_string(kind)


def typed(df: DataFrame, **kinds) -> DataFrame:
    """Declare types of fields. A text field takes any type; others only a wider one of the same family."""
    have = {f.name: f.dataType for f in df.schema}
    for name, kind in kinds.items():
        resolve(name, df.columns)
        want, old = kind_of(kind), have[name]
        if want != old and old.typeName() != "string" and not (isinstance(want, NumericType) and isinstance(old, NumericType)):
            raise FieldError(f"{name} is {old.simpleString()}, not {want.simpleString()}")
    return df.select(*[col(c).cast(kind_of(kinds[c])).alias(c) if c in kinds else col(c) for c in df.columns])


def same_shape(first: StructType, other: StructType) -> None:
    """Check that two inputs can be merged by position: as many fields, each of the same type or both numeric."""
    if len(first) != len(other):
        raise FieldError(f"{len(first)} fields against {len(other)}")
    for a, b in zip(first, other, strict=True):
        if a.dataType != b.dataType and not (isinstance(a.dataType, NumericType) and isinstance(b.dataType, NumericType)):
            raise FieldError(f"{a.name} is {a.dataType.simpleString()}, {b.name} is {b.dataType.simpleString()}")


def at_load(df: DataFrame, names: Sequence[str], separator: str = r"\t", column: str = "line") -> DataFrame:
    """Resolve lines of unknown fields into ``names``. Lines of another length raise when they are read."""
    parts = F.split(column, separator, -1)
    fit = F.when(F.size(parts) == len(names), parts).otherwise(F.raise_error(F.concat(F.lit(f"expected {len(names)} fields: "), F.col(column))))
    return df.select(fit.alias("_parts")).select(*[F.col("_parts")[i].alias(n) for i, n in enumerate(names)])
