"""Fitted models on shared storage, with a small table of their versions."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from holdfast.functions.forest import Forest
from holdfast.functions.types import enforce_types
from holdfast.sources.files import Store

REGISTRY_SCHEMA = (
    "version int, path string, metrics map<string,double>, "
    "params map<string,string>, signature string, input_example string, saved_ts timestamp"
)
ALIAS_SCHEMA = "number int, alias string, version int, set_ts timestamp"
LATEST = "latest"
OUTPUTS = [{"name": "churn_probability", "type": "double"}]


class Signature(NamedTuple):
    """Columns and types that a model takes and gives."""

    inputs: dict[str, DataType]
    outputs: dict[str, DataType]

    def check_inputs(self, df: DataFrame) -> DataFrame:
        """``df`` with inputs cast where that is safe; else TypeError before any task runs."""
        return enforce_types(df, self.inputs)

    def check_outputs(self, df: DataFrame) -> DataFrame:
        return enforce_types(df, self.outputs)


def registry(spark: SparkSession, root: str) -> DataFrame:
    """One row per saved model; no rows when nothing has been saved."""
    return _table(spark, f"{root}/registry", REGISTRY_SCHEMA)


def aliases(spark: SparkSession, root: str) -> DataFrame:
    """Every time an alias was set, in order of ``number``; the last one holds."""
    return _table(spark, f"{root}/aliases", ALIAS_SCHEMA)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _append(spark: SparkSession, root: str, table: str, number: int, row: Row, schema: str) -> None:
    """Add one row as one file, written aside and renamed: appends at once would share a temporary folder."""
    store, aside = Store(spark, root), f"_row-{uuid.uuid4().hex}"
    spark.createDataFrame([row], schema).coalesce(1).write.parquet(f"{root}/{aside}")
    (file,) = store.names(f"{aside}/part-*.parquet")
    store.move(file, f"{table}/{number}.parquet")
    store.delete(aside)


def save_model(
    model: Forest,
    root: str,
    metrics: dict[str, float],
    params: dict[str, object] | None = None,
    example: DataFrame | None = None,
) -> int:
    """Store ``model`` as the next version and point ``latest`` at it.

    The number is claimed before anything is written, so two savers at once get two numbers; a
    save that dies leaves a gap. The model is written first, then its row, then the
    alias: neither names anything that is missing.
    """
    spark = SparkSession.active()
    newest = registry(spark, root).agg(F.max("version")).first()[0]
    version = Store(spark, root).claim_number("_versions", newest or 0)
    path = f"{root}/v{version}"
    model.save(spark, path)
    row = Row(
        version=version,
        path=path,
        metrics={name: float(value) for name, value in metrics.items()},
        params={name: str(value) for name, value in (params or {}).items()},
        signature=_signature(example),
        input_example=_example_json(example),
        saved_ts=datetime.now(timezone.utc),
    )
    _append(spark, root, "registry", version, row, REGISTRY_SCHEMA)
    set_alias(spark, root, LATEST, version)
    return version


def set_alias(spark: SparkSession, root: str, alias: str, version: int) -> None:
    """Point ``alias`` at a stored version, for example back at an earlier one."""
    _path(spark, root, version)
    last = aliases(spark, root).agg(F.max("number")).first()[0]
    number = Store(spark, root).claim_number("_alias_numbers", last or 0)
    row = Row(number=number, alias=alias, version=version, set_ts=datetime.now(timezone.utc))
    _append(spark, root, "aliases", number, row, ALIAS_SCHEMA)


def load_model(
    spark: SparkSession, root: str, version: int | None = None, alias: str = LATEST
) -> Forest:
    """Load one version, or the one behind an alias."""
    return Forest.load(spark, _path(spark, root, _version(spark, root, version, alias)))


def load_signature(
    spark: SparkSession, root: str, version: int | None = None, alias: str = LATEST
) -> Signature | None:
    """The signature of one version, or of the one behind an alias; None where none was stored."""
    text = _entry(spark, root, _version(spark, root, version, alias))["signature"]
    if text is None:
        return None
    stored = json.loads(text)
    sides = ({c["name"]: DataType.fromDDL(c["type"]) for c in stored[side]} for side in ("inputs", "outputs"))
    return Signature(*sides)


def load_latest(spark: SparkSession, root: str) -> Forest:
    """Load the model behind the alias ``latest``."""
    return load_model(spark, root)


def _version(spark: SparkSession, root: str, version: int | None, alias: str) -> int:
    if version is not None:
        return version
    named = aliases(spark, root).filter(F.col("alias") == alias).orderBy(F.desc("number")).first()
    if named is None:
        raise LookupError(f"no model {alias} under {root}")
    return named["version"]


def _entry(spark: SparkSession, root: str, version: int) -> Row:
    entry = registry(spark, root).filter(F.col("version") == version).first()
    if entry is None:
        raise LookupError(f"no model {version} under {root}")
    return entry


def _path(spark: SparkSession, root: str, version: int) -> str:
    return _entry(spark, root, version)["path"]


def _signature(example: DataFrame | None) -> str | None:
    if example is None:
        return None
    inputs = [{"name": name, "type": kind} for name, kind in example.dtypes]
    return json.dumps({"inputs": inputs, "outputs": OUTPUTS})


def _example_json(example: DataFrame | None) -> str | None:
    if example is None:
        return None
    rows = [row.asDict(recursive=True) for row in example.take(3)]
    return json.dumps(rows, ensure_ascii=False, default=str)
