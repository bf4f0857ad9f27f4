import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdfast.llm import bytewords, importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def features(text):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def crcs(text):
    return Counter(zlib.crc32(f.encode()) for f in features(text))


def brute(rows, target):
    """Plain version: (doc_id, n_features, weight, score) by row, and the ids drawn in order."""
    bucket = lambda texts: Counter(c % 10_000 for t in texts for c in crcs(t).elements())
    s, t = bucket(x for _, x in rows), bucket(target)
    s_all, t_all = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    found = []
    for doc_id, text in rows:
        gain = [math.floor(1000 * math.log((t[c % 10_000] + 1) * s_all / ((s[c % 10_000] + 1) * t_all))) for c in crcs(text).elements()]
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = sum(gain) + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append((doc_id, len(gain), sum(gain), score))
    able = [f for f, (_, text) in zip(found, rows) if len(words(text)) >= 20]
    able.sort(key=lambda f: (-f[3], f[0] is None, f[0] or 0))
    return found, able


def prose(seed, count):
    r = random.Random(seed)
    vocabulary = ["Alpha", "beta", "x1", "über", "日本", "don't", "e-mail", "Z", "longer" * 15]
    return [" ".join(r.choices(vocabulary, k=r.randrange(0, 60))) for _ in range(count)]


def key(row):
    return tuple((v is None, v or 0) for v in row)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB9 é日-\n") | st.characters(codec="utf-8"), max_size=40), max_size=5), st.integers(4, 50))
def test_crcs_of_word_runs(texts, slice_bytes):
    before, bytewords.SLICE_BYTES = bytewords.SLICE_BYTES, slice_bytes
    try:
        got = [Counter() for _ in texts]
        for found in bytewords.words(pa.array(texts, pa.string()), importance._WORD, 2):
            for last, crc in bytewords.run_crcs(found, 3):
                for row, c in zip(np.searchsorted(found.bounds, last, "right") - 1, crc.tolist()):
                    got[found.row + row][c] += 1
    finally:
        bytewords.SLICE_BYTES = before
    assert got == [crcs(t) for t in texts]


def test_words_of_any_length():
    texts = ["a" * n for n in (1, 63, 64, 65, 128, 5_000)]
    found = next(bytewords.words(pa.array(texts), importance._WORD, 2))
    _, crc = next(bytewords.run_crcs(found, 1))
    assert crc.tolist() == [zlib.crc32(t.encode()) for t in texts]


@pytest.mark.parametrize("wanted", [1, 2, 7, 40, 99, 100])
def test_least_value_that_reaches(spark, wanted):
    values = sorted(random.Random(wanted).choice([-(10**12), -5, 0, 3, 8, 9, 10**15]) for _ in range(100))
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    found = values[wanted - 1]
    assert importance.least_reaching(rows, "v", wanted) == (found, values.index(found))


def test_against_plain_version(spark, docs):
    texts = prose(1, 400) + [None, "", " ", "one two", "word " * 30_000]
    rows = list(zip(range(len(texts)), texts))
    target = prose(2, 30) + [None, ""]
    found, able = brute(rows, target)
    drawn = able[: 5 * len(able) // 100]
    rank = {f[0]: i + 1 for i, f in enumerate(drawn)}
    got = importance.resample(docs(*texts), spark.createDataFrame([(t,) for t in target], "text string"))
    got = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got)) == [(*f, rank.get(f[0])) for f in found] and len(drawn) > 5


def test_ties_repeats_and_null_ids(spark, docs):
    same = " ".join(["alpha beta"] * 15)
    texts, ids = [same] * 40, [7] * 25 + [None] * 10 + [8] * 5
    got = importance.resample(docs(*texts, ids=ids), spark.createDataFrame([("alpha",)], "text string"), (1, 2)).collect()
    _, able = brute(list(zip(ids, texts)), ["alpha"])
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert len(got) == 40 and [r["rank"] for r in drawn] == list(range(1, 21))
    assert [(r["doc_id"], r["score"]) for r in drawn] == [(f[0], f[3]) for f in able[:20]]


def test_empty_tables_and_clashing_names(spark, docs):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(docs(), target).count() == 0
    named = docs(*prose(3, 60)).withColumnsRenamed({"lang": "score", "source": "row", "n_chars": "rank"})
    plain_ = importance.resample(docs(*prose(3, 60)), target)
    assert sorted(importance.resample(named, target).collect(), key=key) == sorted(plain_.collect(), key=key)
    few = importance.resample(docs("a", "b"), target)
    assert few.filter(F.col("rank").isNotNull()).count() == 0 and few.count() == 2
