"""Flow configuration in layers: flow properties, then those of a step and of a node; each sets or proposes values."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Layer:
    """``defaults`` hold where nothing below sets the key; ``replaces`` hold over everything below."""

    defaults: Mapping[str, str] = field(default_factory=dict)
    replaces: Mapping[str, str] = field(default_factory=dict)

    def over(self, below: Mapping[str, str]) -> dict[str, str]:
        return {**self.defaults, **below, **self.replaces}


def _plain(properties: Mapping) -> dict[str, str]:
    """Only texts and plain values are properties; classes and other objects are left out."""
    return {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in properties.items() if isinstance(k, str) and isinstance(v, (str, int, float, bool))}


@dataclass(frozen=True)
class Config:
    properties: Mapping[str, str] = field(default_factory=dict)
    layers: tuple[Layer, ...] = ()

    @staticmethod
    def of(properties: Mapping) -> Config:
        return Config(_plain(properties))

    def with_layer(self, layer: Layer) -> Config:
        return Config(self.properties, (*self.layers, layer))

    def values(self) -> dict[str, str]:
        out = dict(self.properties)
        for layer in self.layers:
            out = layer.over(out)
        return out

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.values().get(key, default)

    def changed(self, since: Config) -> dict[str, str]:
        """What differs from another configuration."""
        old = since.values()
        return {k: v for k, v in self.values().items() if old.get(k) != v}

    def merged(self, more: Mapping) -> Config:
        return Config({**self.properties, **_plain(more)}, self.layers)

    @contextmanager
    def held(self, spark: SparkSession) -> Iterator[None]:
        """Spark's own settings among the values hold meanwhile and are put back after."""
        own = {k: v for k, v in self.values().items() if k.startswith("spark.sql.") and spark.conf.isModifiable(k)}
        before = {k: spark.conf.get(k, None) for k in own}
        try:
            for k, v in own.items():
                spark.conf.set(k, v)
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)
