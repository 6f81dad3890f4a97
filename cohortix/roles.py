"""Column roles: which columns are ids, labels, categories, flags, features."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


@dataclass(frozen=True)
class Roles:
    ids: tuple[str, ...] = ()
    labels: tuple[str, ...] = ()
    category: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    exclude: tuple[str, ...] = field(default_factory=tuple)

    def features(self, df: DataFrame) -> list[str]:
        """Every column that is not an id, label or excluded column."""
        skip = set(self.ids) | set(self.labels) | set(self.exclude)
        return [c for c in df.columns if c not in skip]

    def numeric(self, df: DataFrame, include_flags: bool = False) -> list[str]:
        """Numeric features; flags count only when ``include_flags``."""
        types = {f.name: f.dataType for f in df.schema.fields}
        skip = set(self.category) | (set() if include_flags else set(self.flags))
        return [
            c
            for c in self.features(df)
            if c not in skip and isinstance(types[c], NUMERIC_TYPES)
        ]


def numeric_columns(df: DataFrame, cols: list[str] | None = None) -> list[str]:
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = cols if cols is not None else df.columns
    return [c for c in cols if isinstance(types[c], NUMERIC_TYPES)]
