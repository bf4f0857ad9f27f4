"""Columns computed from whole texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, with as many underscores before it as no column has (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def add_from_text(
    docs: DataFrame,
    fields: Mapping[str, str],
    compute: Callable[[pa.Array], Sequence[pa.Array]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add the columns ``fields`` (name to SQL type), computed from ``text`` per batch.

    ``keep`` names the columns of ``docs`` to return, all by default; those with one of
    the new names are replaced. Only these and the text go through Python.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in fields]
    text = "text"
    while text in keep:
        text = f"_{text}"
    has_text = "text" in keep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = compute(batch.column("text" if has_text else text))
            yield pa.record_batch(
                [*(batch.column(c) for c in keep), *new], names=[*keep, *fields]
            )

    sent = docs.select(*keep, *(() if has_text else [F.col("text").alias(text)]))
    added = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))
    schema = StructType([*docs.select(*keep).schema.fields, *added.fields])
    return sent.mapInArrow(run, schema)
