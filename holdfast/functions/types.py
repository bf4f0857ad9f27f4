"""Which column types may stand for which others."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
)

# Whole numbers in order of width, with the digits that hold all their values.
_WHOLE = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
_BROKEN = (FloatType(), DoubleType())


def common_type(one: DataType, other: DataType) -> DataType | None:
    """The narrowest type that holds the values of both, or None.

    Whole numbers widen to longer ones, to decimals with enough digits and to double (exact up
    to 2**53), float to double, dates to timestamps without zone, arrays by their elements.
    """
    if one == other:
        return one
    pair = {one, other}
    if pair <= set(_WHOLE):
        return max(pair, key=_WHOLE.get)
    if pair <= {*_WHOLE, *_BROKEN}:
        return DoubleType()
    if pair == {DateType(), TimestampNTZType()}:
        return TimestampNTZType()
    if isinstance(one, ArrayType) and isinstance(other, ArrayType):
        inner = common_type(one.elementType, other.elementType)
        return inner and ArrayType(inner)
    digits = [_digits(t) for t in pair]
    if None not in digits:
        before, after = (max(d[i] for d in digits) for i in (0, 1))
        return DecimalType(before + after, after) if before + after <= 38 else None
    return None


def _digits(kind: DataType) -> tuple[int, int] | None:
    if isinstance(kind, DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (_WHOLE[kind], 0) if kind in _WHOLE else None


def enforce_types(df: DataFrame, wanted: Mapping[str, DataType]) -> DataFrame:
    """``df`` with the named columns in their wanted types; other columns stay as they are.

    Columns are cast where the wanted type holds all their values. Missing columns and other types are
    refused by name, before any task runs.
    """
    have = {f.name: f.dataType for f in df.schema}
    problems = []
    for name, kind in wanted.items():
        if name not in have:
            problems.append(f"{name} is missing")
        elif common_type(have[name], kind) != kind:
            problems.append(f"{name} is {have[name].simpleString()}, not {kind.simpleString()}")
    if problems:
        raise TypeError("; ".join(problems))
    casts = {n: F.col(f"`{n}`").cast(k) for n, k in wanted.items() if have[n] != k}
    return df.withColumns(casts) if casts else df
