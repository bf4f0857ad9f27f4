"""Table reads, and the write that replaces one date of a table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Read one named parquet table of a directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Read a date-partitioned table; ``merge_schema`` unites old and new columns."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_date(spark: SparkSession, path: str, day: date | str, merge_schema: bool = False) -> DataFrame:
    """Read one date of a table; the filter prunes to that partition."""
    return read_table(spark, path, merge_schema).filter(F.col("event_date") == day_literal(day))


def day_literal(day: date | str):
    return F.lit(str(day)).cast("date")


def activity_history(df: DataFrame) -> DataFrame:
    """The two columns of the activity table that labels need."""
    return df.select("user_id", "event_date").withColumnRenamed("event_date", "activity_date")


def replace_date(df: DataFrame, path: str, day: date | str, column: str = "event_date") -> int:
    """Replace the rows of one date at ``path``, keep all other dates, count the rows.

    A row of another date fails the write before anything is committed. Dynamic
    overwrite leaves a partition alone when there is no row for it, so an empty
    frame clears the date in a second step.
    """
    wanted = day_literal(day)
    checked = F.when(F.col(column) == wanted, F.col(column)).otherwise(
        F.raise_error(
            F.concat(
                F.lit(f"replace_date({day}) got a row of date "),
                F.coalesce(F.col(column).cast("string"), F.lit("null")),
            )
        )
    )
    written = Observation()
    (
        df.withColumn(column, checked)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    rows = written.get["rows"]
    if rows == 0:
        (
            df.drop(column)
            .limit(0)
            .write.mode("overwrite")
            .parquet(f"{path}/{column}={day}")
        )
    return rows
