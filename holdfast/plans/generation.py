"""Asking a text generator so that a run can break off and go on.

Answers are kept in a log, a Parquet folder keyed by a hash of the prompt. A run first leaves
out every prompt the log answers, so equal prompts are asked once and a second run asks only
what is open. Tasks are short, and each publishes its answers when it ends, not when the job
does: what a run that is killed has been told stays told. A call that fails or
takes too long is a row with an error, and is open again in the next run until it has failed
``tries`` times.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.joins import lookup

LOG_SCHEMA = "prompt_key string, answered boolean, content string, refusal string, error string"

Generate = Callable[[pd.Series], "pd.Series | pd.DataFrame"]


@dataclass(frozen=True)
class AnswerLog:
    """Where answers are kept, and how prompts are asked.

    ``threads`` calls run at a time in each task, ``seconds`` is the longest a call may take from when it
    begins, ``per_task`` the prompts of a task, ``tries`` the failures after which a prompt stays unanswered.
    """

    path: str
    threads: int = 8
    seconds: float = 60.0
    per_task: int = 100
    tries: int = 2


def step_log(log: AnswerLog, step: str) -> AnswerLog:
    """The log of one step, in a folder of its own, so that equal prompts of two steps are asked in both.

    One folder for all would not do: in a plan that reads it at two times Spark takes the scans for
    the same one, and the later may lack its answers.
    """
    return replace(log, path=f"{log.path}/{step}")


def prompt_key(prompt: Column) -> Column:
    return F.sha2(prompt, 256)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All calls so far; none where nothing has been asked."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def settled(calls: DataFrame, tries: int) -> DataFrame:
    """One row a prompt that is answered, or has failed ``tries`` times; of several answers the smallest."""
    answer = F.min(F.when(F.col("error").isNull(), F.struct("answered", "content", "refusal"))).alias("answer")
    found = calls.groupBy("prompt_key").agg(answer, F.count_if(F.col("error").isNotNull()).alias("failures"))
    return found.filter(F.col("answer").isNotNull() | (F.col("failures") >= tries)).select("prompt_key", "answer")


def ask_open(prompts: DataFrame, generate: Generate, log: AnswerLog) -> int:
    """Ask every distinct prompt (``prompt_key``, ``prompt``) that the log does not settle; returns how many."""
    spark = prompts.sparkSession
    distinct = prompts.filter("prompt is not null").groupBy("prompt_key").agg(F.min("prompt").alias("prompt"))
    done = settled(read_log(spark, log.path), log.tries).select("prompt_key")
    open_ = distinct.join(done, "prompt_key", "left_anti")
    count = open_.count()
    if count:
        tasks = -(-count // log.per_task)
        asked = open_.repartition(tasks, "prompt_key").mapInPandas(_asking(generate, log), LOG_SCHEMA)
        # With this committer a task's file is in place when the task ends; a file that a repeated
        # task leaves twice does no harm, as the log is read by key.
        asked.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(log.path)
    return count


def _asking(generate: Generate, log: AnswerLog):
    def call(prompt: str) -> tuple:
        got = generate(pd.Series([prompt]))
        row = {"content": got.iloc[0]} if isinstance(got, pd.Series) else got.iloc[0].to_dict()
        return bool(row.get("answered", True)), row.get("content"), row.get("refusal"), None

    def result(future: Future) -> tuple:
        try:
            return future.result(timeout=log.seconds)
        except Late:
            return False, None, None, f"no answer in {log.seconds} s"
        except Exception as error:  # whatever the client raises is this prompt's own failure
            return False, None, None, f"{type(error).__name__}: {error}"

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for low in range(0, len(frame), log.threads):
                some = frame.iloc[low : low + log.threads]
                pool = ThreadPoolExecutor(len(some))
                calls = [pool.submit(call, prompt) for prompt in some["prompt"]]
                rows += [(key, *result(c)) for key, c in zip(some["prompt_key"], calls)]
                pool.shutdown(wait=False)  # a call that hangs must not hold up the others
            out = pd.DataFrame(rows, columns=["prompt_key", "answered", "content", "refusal", "error"])
            yield out.astype({"content": object, "refusal": object, "error": object}).where(out.notna(), None)

    return ask


def answers(prompts: DataFrame, prompt: str, generate: Generate, log: AnswerLog) -> DataFrame:
    """``prompts`` with ``_response`` (answered, content, refusal) from the log, asking what is open first.

    A prompt that is null, or failed for good, was not answered. One plan should use a log once; further
    steps have logs of their own (:func:`step_log`).
    """
    keyed = prompts.withColumn("prompt_key", prompt_key(F.col(prompt)))
    ask_open(keyed.select("prompt_key", F.col(prompt).alias("prompt")), generate, log)
    found = lookup(keyed, settled(read_log(prompts.sparkSession, log.path), log.tries), ["prompt_key"])
    none = F.struct(F.lit(False).alias("answered"), F.lit(None).cast("string").alias("content"), F.lit(None).cast("string").alias("refusal"))
    return found.withColumn("_response", F.coalesce("answer", none)).drop("prompt_key", "answer")
