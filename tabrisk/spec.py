"""Declared table layout standing in for dtype sniffing."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    id: str
    label: str | None
    numeric: tuple[str, ...] = field(default_factory=tuple)
    categorical: tuple[str, ...] = field(default_factory=tuple)
    train_flag: str | None = "is_train"

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.numeric) + tuple(self.categorical)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns of a numeric type, like ``select_dtypes(['int64','float64'])``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Columns of string type, like ``select_dtypes('object')``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]
