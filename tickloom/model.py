"""Dataset contracts: columns, keys, units and null sentinels in one place."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """A column: its type, the provider's name, unit factor and values that stand for null."""

    name: str
    kind: str
    source: str = ""
    required: bool = False
    factor: float = 1.0
    sentinels: tuple = ()
    formats: tuple[str, ...] = ()
    doc: str = ""


@dataclass(frozen=True)
class Dataset:
    """A typed dataset. `key` tells rows apart, `event_time` orders them, `partition` is the layout on disk."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    event_time: str = ""
    partition: tuple[str, ...] = ()
    depends_on: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    kind: str = "TABLE"
    rules: dict[str, str] = field(default_factory=dict)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.DataType.fromDDL(f.kind), not f.required, {"doc": f.doc, "factor": f.factor}) for f in self.fields])

    def field(self, name: str) -> Field:
        found = [f for f in self.fields if f.name == name]
        if not found:
            raise KeyError(f"{self.name} has no column {name}")
        return found[0]

    def is_null(self, name: str) -> Column:
        """Null, or one of the values that stood for it."""
        c = F.col(name)
        kept = self.field(name).sentinels
        return c.isNull() | c.isin(*kept) if kept else c.isNull()


def to_base_unit(df: DataFrame, ds: Dataset) -> DataFrame:
    """Numbers times their unit factors."""
    factors = {f.name: f.factor for f in ds.fields if f.factor != 1.0}
    return df.select(*((F.col(c) * factors[c]).alias(c) if c in factors else F.col(c) for c in df.columns))
