import itertools
import random

import public_tokenizers
from tokenizers import Tokenizer
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from holdfast.llm import queries, tokens
from holdfast.llm.packing import TOKEN_BUDGET, cell, choose_bounds, pack


def _padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= x) - x for x in lengths)


@pytest.mark.parametrize("seed", range(5))
def test_bounds_are_optimal(seed):
    r = random.Random(seed)
    lengths = [r.randrange(1, 60) for _ in range(40)]
    cells = sorted(set(lengths))
    chosen = choose_bounds(cells, [lengths.count(c) for c in cells], [c * lengths.count(c) for c in cells], 3)
    best = min(_padding(lengths, (*some, cells[-1])) for k in range(3) for some in itertools.combinations(cells[:-1], k))
    assert len(chosen) <= 3 and _padding(lengths, chosen) == best


def test_batches_keep_the_budget(docs):
    r = random.Random(1)
    texts = [None, ""] + ["w " * r.choice([1, 5, 5, 40, 41, 300]) for _ in range(400)] + ["w " * 2_000] * 2
    got = pack(docs(*texts).withColumn("bucket", F.lit("x")), buckets=4, budget=1_000, keep=["doc_id", "source"])
    rows = got.collect()
    assert sorted(x["doc_id"] for x in rows) == list(range(len(texts)))
    batches = {}
    for x in rows:
        batches.setdefault((x["bucket"], x["shard"], x["batch"]), []).append(x)
        assert x["length"] <= x["bucket"]
    for (bucket, _, _), held in batches.items():
        assert len(held) == 1 or bucket * len(held) <= 1_000
        assert sorted(x["slot"] for x in held) == list(range(len(held)))
    assert len({x["bucket"] for x in rows}) <= 4


def test_length_column_and_empty_table(docs):
    assert pack(docs("a", "b"), length=F.lit(None)).select("length").distinct().collect() == [(0,)]
    assert pack(docs()).count() == 0


def test_registered_lengths_are_tokens(spark, docs, tmp_path):
    texts = [None, "", "a b", "日本語" * 500, "https://example.org/" + "x1" * 2_000, "word " * 300] * 3
    docs(*texts).write.parquet(f"{tmp_path}/documents.parquet")
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    expected = {i: len(encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for got in (queries.op8_length_buckets(spark, str(tmp_path)), corpus_pipeline.batches(spark, table, str(tmp_path))):
        rows = got.collect()
        assert {x["doc_id"]: x["length"] for x in rows} == expected
        for bucket in {x["bucket"] for x in rows}:
            assert bucket * max(x["slot"] + 1 for x in rows if x["bucket"] == bucket) <= TOKEN_BUDGET


def test_cells_are_few_and_narrow(spark):
    rows = spark.range(1, 3_000_000, 7).select(F.col("id").alias("_length"))
    cells = rows.groupBy(cell(F.col("_length")).alias("c")).agg(F.min("_length").alias("a"), F.max("_length").alias("b"))
    count, widest = cells.agg(F.count("*"), F.max((F.col("b") - F.col("a")) / F.col("a"))).first()
    assert count < 6_000 and widest < 0.01
