"""Fail-fast checks. All of them look at metadata or stop at the first row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Raise with the names of the columns that are missing."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise when there is no row at all."""
    if df.isEmpty():
        raise RuntimeError(message)
    return df


def require_not_null(df: DataFrame, column: str) -> DataFrame:
    """Raise when ``column`` is null anywhere."""
    if not df.filter(F.col(column).isNull()).isEmpty():
        raise RuntimeError(f"null values in {column}")
    return df


def has_two_classes(df: DataFrame, label: str = "label") -> bool:
    """Whether both label values occur (one pass, two extremes)."""
    low, high = df.agg(F.min(label), F.max(label)).first()
    return low != high


def require_two_classes(df: DataFrame, label: str = "label") -> DataFrame:
    """Raise when training rows carry fewer than two labels."""
    if not has_two_classes(df, label):
        raise ValueError(f"fewer than two classes in {label}")
    return df


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate that ``df`` has, or None."""
    present = set(df.columns)
    return next((name for name in candidates if name in present), None)
