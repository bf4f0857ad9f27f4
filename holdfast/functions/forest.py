"""Boosted trees as flat arrays, and their margins for whole batches of rows.

A tree of depth d has 2**(d + 1) - 1 places, the children of place i at 2 i + 1 and 2 i + 2. An
inner place names a feature and a cut (values up to it go left); a leaf has feature -1. All
rows of an Arrow batch walk a tree together, one numpy step a level, so scoring a table
is one pass however many trees there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

_NODES = "tree int, place int, feature int, cut double, value double"


@dataclass(frozen=True)
class Forest:
    """Trees in order of their rounds; row i of each array is tree i."""

    inputs: tuple[str, ...]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray  # of leaves, the learning rate included

    @property
    def rounds(self) -> int:
        return len(self.feature)

    def first(self, rounds: int) -> Forest:
        return Forest(self.inputs, self.feature[:rounds], self.cut[:rounds], self.value[:rounds])

    def leaves(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """For each tree the value that every row (a column of ``rows``) ends at."""
        count = rows.shape[1]
        flat, at = rows.reshape(-1), np.arange(count)
        for tree in zip(self.feature, self.cut, self.value):
            feature, cut, value = _complete(*tree)
            line = feature * count
            place = np.zeros(count, np.int64)
            for _ in range(int(len(feature)).bit_length() - 1):
                right = flat.take(line.take(place) + at) > cut.take(place)
                place *= 2
                place += 1
                place += right
            yield value.take(place)

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of class 1 for every row."""
        total = np.zeros(rows.shape[1])
        for value in self.leaves(rows):
            total += value
        return total

    def prefix_margins(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of the first 1, 2, ... trees, one line each."""
        return np.cumsum([*self.leaves(rows)], axis=0)

    def save(self, spark: SparkSession, path: str) -> None:
        """Write one row for each place of each tree, and the inputs in order as a table of their own."""
        places = [
            (tree, place, int(f), float(c), float(v))
            for tree, of_tree in enumerate(zip(self.feature, self.cut, self.value))
            for place, (f, c, v) in enumerate(zip(*of_tree))
        ]
        spark.createDataFrame(places, _NODES).coalesce(1).write.parquet(f"{path}/nodes")
        inputs = spark.createDataFrame([*enumerate(self.inputs)], "place int, name string")
        inputs.coalesce(1).write.parquet(f"{path}/inputs")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        names = spark.read.parquet(f"{path}/inputs").orderBy("place").collect()
        nodes = spark.read.schema(_NODES).parquet(f"{path}/nodes").orderBy("tree", "place").toArrow()
        tree, columns = nodes["tree"].to_numpy(), [nodes[c].to_numpy() for c in ("feature", "cut", "value")]
        rounds = len(np.unique(tree))
        feature, cut, value = (c.reshape(rounds, -1) for c in columns) if rounds else (np.empty((0, 1)) for _ in columns)
        return Forest(tuple(r["name"] for r in names), feature.astype(np.int64), cut, value)


def _complete(feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same tree with all leaves in the last level, so that no row has to be asked whether it has ended."""
    value, ended = value.copy(), feature < 0
    low, high = 0, 1
    while high < len(feature):  # places low to high are one level, their children the next
        above, below = np.repeat(np.arange(low, high), 2), np.arange(high, 2 * high + 1)
        value[below] = np.where(ended[above], value[above], value[below])
        ended[below] |= ended[above]
        low, high = high, 2 * high + 1
    return np.where(ended, 0, feature), np.where(ended, np.inf, cut), value


def matrix(batch: pa.RecordBatch, inputs: Sequence[str]) -> np.ndarray:
    """The inputs as doubles, one line each; null and NaN are 0."""
    lines = [batch.column(c).cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False) for c in inputs]
    return np.nan_to_num(np.stack(lines), nan=0.0, posinf=np.inf, neginf=-np.inf)


def probabilities(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-margins))


def score(rows: DataFrame, model: Forest, out: str = "churn_probability") -> DataFrame:
    """Add the probability of class 1 to every row; an ``out`` of the input is replaced."""
    keep = [c for c in rows.columns if c != out]
    asked = [F.col(c).cast("double").alias(f"_input_{i}") for i, c in enumerate(model.inputs)]
    names = [f"_input_{i}" for i in range(len(model.inputs))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = probabilities(model.margins(matrix(batch, names)))
            row = batch.column("_row")
            yield pa.record_batch([*row.flatten(), pa.array(found)], names=[*keep, out])

    # The row's own columns travel in one struct, so none can have the name of an input.
    sent = rows.select(F.struct(*keep).alias("_row"), *asked)
    schema = StructType([*rows.select(*keep).schema.fields, StructField(out, DoubleType())])
    return sent.mapInArrow(run, schema)
