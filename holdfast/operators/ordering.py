"""Exact positions in a global order, without sorting all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from math import ceil, floor
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from holdfast.session import materialise

_SEQ_BITS = 33  # monotonically_increasing_id keeps the row within the partition in these bits
_ACCURACY = 10_000  # ranks of the sketch are off by at most count / accuracy
_MARGIN = 2 / _ACCURACY


def with_row_index(
    df: DataFrame, order: Sequence[str], tie: Sequence[str] = (), out: str = "row_index"
) -> DataFrame:
    """Number the rows from 0 in the order of ``order``, then ``tie``.

    Rows equal in both are ordered by a hash of the whole row. That hash is part
    of the sort key, so the range partitioning can split a date, or any other
    key, that holds a large part of the rows.
    """
    keys = [*order, *tie, F.xxhash64(*df.columns)]
    numbered, sizes = _numbered(df, keys, F.count(F.lit(1)))
    starts = df.sparkSession.createDataFrame(
        list(_starts(sizes).items()), "_part long, _start long"
    )
    # One row per partition of the sort, however many rows there are.
    return numbered.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.col("_seq")).alias(out)
    )


def row_at(df: DataFrame, keys: Sequence[str], position: int) -> Row | None:
    """The row at one position in the order of all ``keys``, None beyond the end."""
    return _rows_at(df, keys, [position]).get(position)


def exact_percentiles(
    df: DataFrame, column: str, shares: Sequence[float]
) -> list[float | None]:
    """Percentiles with linear interpolation between the two nearest ranks.

    Nulls and NaN are left out. A sketch first gives a
    narrow span of values around each rank; counts then say where the spans lie,
    and only the values inside are sorted. Only the values at the wanted ranks
    reach the driver.
    """
    value = F.col(column).cast("double")
    clean = df.select(value.alias("value")).filter(value.isNotNull() & ~F.isnan(value))
    edges = [min(max(share + side, 0.0), 1.0) for share in shares for side in (-_MARGIN, _MARGIN)]
    count, found = clean.agg(F.count("value"), F.percentile_approx("value", edges, _ACCURACY)).first()
    if not count:
        return [None for _ in shares]
    ranks = [(count - 1) * share for share in shares]
    wanted = sorted({step(rank) for rank in ranks for step in (floor, ceil)})
    values = _values_in_spans(clean, list(zip(found[::2], found[1::2])), wanted)
    if values is None:
        values = {at: row["value"] for at, row in _rows_at(clean, ["value"], wanted).items()}
    return [
        values[floor(r)] + (values[ceil(r)] - values[floor(r)]) * (r - floor(r)) for r in ranks
    ]


def _values_in_spans(
    clean: DataFrame, spans: Sequence[tuple[float, float]], ranks: Sequence[int]
) -> dict[int, float] | None:
    """The values at the ranks, or None if one of them lies in no span."""
    disjoint: list[tuple[float, float]] = []
    for low, high in sorted(spans):
        if disjoint and low <= disjoint[-1][1]:
            disjoint[-1] = (disjoint[-1][0], max(high, disjoint[-1][1]))
        else:
            disjoint.append((low, high))
    inside = [F.col("value").between(*span) for span in disjoint]
    counts = clean.agg(
        *(F.count_if(F.col("value") < low) for low, _ in disjoint), *map(F.count_if, inside)
    ).first()
    below, sizes = counts[: len(disjoint)], counts[len(disjoint) :]
    positions = {}
    for start, size, skipped in zip(below, sizes, accumulate(sizes, initial=0)):
        positions |= {r: r - start + skipped for r in ranks if start <= r < start + size}
    if len(positions) < len(ranks):
        return None
    picked = _rows_at(clean.filter(reduce(or_, inside)), ["value"], list(positions.values()))
    return {rank: picked[position]["value"] for rank, position in positions.items()}


def _rows_at(df: DataFrame, keys: Sequence[str], positions: Sequence[int]) -> dict[int, Row]:
    """The keys at the wanted positions; none for a position beyond the end.

    Rows are counted per key first, on the map side too: a value that a third of
    the rows share is one row to sort. The partition of each position follows
    from the partitions' totals, and only those partitions are looked into.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    numbered, sizes = _numbered(counted, keys, F.sum("_rows"))
    places = {}
    for part, start in _starts(sizes).items():
        for position in set(positions):
            if start <= position < start + sizes[part]:
                places[position] = (part, position - start)
    if not places:
        return {}
    running = Window.partitionBy("_part").orderBy("_seq")
    before = F.sum("_rows").over(running) - F.col("_rows")
    near = (
        numbered.filter(F.col("_part").isin(sorted({part for part, _ in places.values()})))
        .withColumn("_before", before)
        .withColumn("_after", F.col("_before") + F.col("_rows"))
    )
    found = {}
    for position, (part, offset) in places.items():
        here = (F.col("_part") == part) & (F.col("_before") <= offset) & (F.col("_after") > offset)
        found[position] = F.max(F.when(here, F.struct(*keys)))
    row = near.agg(*(column.alias(str(position)) for position, column in found.items())).first()
    return {position: row[str(position)] for position in found}


def _numbered(
    df: DataFrame, keys: Sequence[str | Column], size: Column
) -> tuple[DataFrame, dict[int, int]]:
    """Sort globally, stamp partition and position, and write that down.

    The stamp is read from the checkpoint afterwards: positions taken from a plan
    that may run again could differ between runs. The sizes are one number per
    partition.
    """
    stamped = materialise(df.orderBy(*keys).withColumn("_id", F.monotonically_increasing_id()))
    numbered = stamped.select(
        *df.columns,
        F.shiftright("_id", _SEQ_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _SEQ_BITS) - 1)).alias("_seq"),
    )
    sizes = numbered.groupBy("_part").agg(size.alias("_size")).orderBy("_part").collect()
    return numbered, {row["_part"]: row["_size"] for row in sizes}


def _starts(sizes: dict[int, int]) -> dict[int, int]:
    return dict(zip(sizes, accumulate(sizes.values(), initial=0)))
