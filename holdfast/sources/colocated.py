"""Tables stored by user, so that joins and sums by user need no shuffle.

All tables of a lake that are joined by one key are written with the same number of buckets
and sorted by that key. A scan then has the partitioning the join asks for, bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def save_colocated(
    df: DataFrame, name: str, path: str, buckets: int, key: str = "user_id", sort: Sequence[str] = ()
) -> DataFrame:
    """Replace the table ``name``, kept at ``path``, by ``df`` in buckets of ``key``, and read it.

    The rows are shuffled once, here, by the same hash as the buckets, so each bucket is one
    sorted file. Choose ``buckets`` for files of a few hundred megabytes, and the same for
    all tables that meet. Rows of one key are in one bucket: use it for tables with a
    bounded number of rows a key (users, daily snapshots, daily activity), not for raw events. An
    empty frame becomes an empty table; rows whose key is null share a bucket.
    """
    if buckets < 1:
        raise ValueError("a table needs one bucket at least")
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key, *sort)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
