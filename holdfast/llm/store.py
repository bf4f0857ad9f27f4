"""Tables and files that an operator writes between its steps.

All of them lie below the folder of ``spark.checkpoint.dir``, which driver and
executors share. Tasks that write files of their own use ``pyarrow.fs`` on that
folder's URI and report the files as rows; the rows are written by Spark's
committer, so files of a lost or repeated attempt are never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from holdfast.session import ensure_checkpoint_dir


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a work folder and read it back: lineage ends there."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI and the path in it; used inside tasks."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)
