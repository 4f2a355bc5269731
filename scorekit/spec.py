"""Declared table layout: which column is the row key, which the label, which the features."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)


def q(name: str) -> str:
    """Back-quote a column name for SQL expression strings (names may hold spaces and dots)."""
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class TableSpec:
    id_col: str
    label_col: str | None = None
    features: tuple[str, ...] = field(default_factory=tuple)
