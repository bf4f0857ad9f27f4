from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from holdfast.llm import langid, quality, queries
from holdfast.llm.quality import fit_quality, score_quality

DATA = "/root/testdata/sf0.1"


def test_language_accuracy_on_held_out_rows(spark):
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    got = queries.op3_language_id(spark, DATA).filter("held_out").join(truth, "doc_id")
    right, rows = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert rows > 1_500 and right > 0.99


def test_language_scores_equal_plain_bayes(spark, docs):
    texts = ["the cat sat", "der Hund lief", "the dog", "die Katze", "Ein Tag"]
    rows = docs(*texts).withColumn("lang", F.when(F.col("doc_id").isin(0, 2), "en").otherwise("de"))
    model = langid.fit_languages(rows)
    assert model.languages == ["de", "en"]
    points, offsets, _ = langid._prepared(["the hat"])
    plain = model.prior.copy()
    for bucket, _ in langid._grams(points, offsets):
        plain += model.weights[bucket].sum(axis=0)
    share = np.exp(plain - plain.max())
    best, score = langid.score_texts(["the hat", "12 !"], model)
    assert best.tolist() == [1, -1] and score[0] == pytest.approx(share.max() / share.sum()) and score[1] == 0


def test_language_cases(spark, docs):
    rows = docs(None, "", "12 ?!", "the " * 300_000, "the").withColumn("lang_pred", F.lit(1))
    got = langid.predict_languages(rows, langid.fit_languages(docs("the cat")))
    assert [r["lang_pred"] for r in got.orderBy("doc_id").collect()] == ["und", "und", "und", "en", "en"]
    nothing = langid.fit_languages(docs())
    assert langid.predict_languages(rows, nothing).select("lang_pred").distinct().collect() == [("und",)]
    assert langid.predict_languages(docs(), nothing).count() == 0


def test_languages_beyond_the_bound_are_refused(docs):
    most = langid.MAX_CELLS // (1 << langid.BITS)
    named = docs(*["a b"] * (most + 1)).withColumn("lang", F.col("doc_id").cast("string"))
    with pytest.raises(ValueError, match=f"more than {most} languages"):
        langid.fit_languages(named)
    assert len(langid.fit_languages(named.filter(F.col("doc_id") < most)).languages) == most


def test_quality_accuracy_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = queries.op4_quality(spark, DATA).filter("held_out").join(labels, "doc_id").cache()
    for quality in (0, 1):
        rows = got.filter(F.col("quality") == quality)
        assert rows.agg(F.avg((F.col("predicted") == quality).cast("int"))).first()[0] > 0.98


def test_quality_cases(spark, docs):
    texts = ["good plain words here", "bad### bad### bad###"] * 20
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(40)] + [(0, 1), (None, 1), (3, None)], "doc_id bigint, quality int")
    model = fit_quality(docs(*texts), labels)
    rows = docs("good plain words", "bad### bad###", None, "", "bad### " * 200_000).withColumn("score", F.lit("x"))
    got = score_quality(rows, model).orderBy("doc_id").collect()
    assert [r["predicted"] for r in got[:2]] == [1, 0] and got[4]["predicted"] == 0
    assert got[2]["score"] == got[3]["score"] and 0 <= got[2]["score"] <= 1
    assert score_quality(docs("a"), fit_quality(docs(), labels)).first()["score"] == 0.5
    assert score_quality(docs(), model).count() == 0


_ALL = (1 << 64) - 1


def _mixed(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & _ALL
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & _ALL
    return h ^ (h >> 31)


def _word_hash(word):
    def factor(kind, k):
        return (_mixed((2 * k + kind) * 0x9E3779B97F4A7C15 & _ALL) | 1) if k else 1

    return _mixed(sum((b + 1) * factor(0, k % 4096) * factor(1, k // 4096) for k, b in enumerate(word)) & _ALL)


def _plain_features(text):
    """Buckets of words, pairs of words and runs of three characters, one by one."""
    hashes = [_word_hash(w) for w in (text or "").encode().split()]
    found = [h >> 48 for h in hashes]
    found += [_mixed((b - a + 1) & _ALL) >> 48 for a, b in zip(hashes, hashes[1:])]
    padded = f" {text or ''} "
    for k in range(len(padded) - 2):
        h = 3
        for c in padded[k : k + 3]:
            h = (h * 0x9E3779B1 & 0xFFFFFFFF) ^ ord(c)
            h = h * 0x85EBCA6B & 0xFFFFFFFF
            h ^= h >> 15
        found.append(h >> 16)
    return found


def _plain_model(texts, label):
    """The same steps of descent in doubles, bucket by bucket."""
    r, d = np.random.default_rng(quality.SEED), quality.DIMENSIONS
    vectors = r.uniform(-1 / d, 1 / d, (1 << 16, d))
    output, bias, done = np.zeros(d), 0.0, 0
    shares = []
    for text in texts:
        counts = Counter(_plain_features(text))
        shares.append({b: n / sum(counts.values()) for b, n in counts.items()})
    for _ in range(quality.EPOCHS):
        for i in r.permutation(len(texts)):
            step = quality.RATE * (1 - done / (quality.EPOCHS * len(texts)))
            done += 1
            mean = sum((s * vectors[b] for b, s in shares[i].items()), np.zeros(d))
            step *= label[i] - 1 / (1 + np.exp(-(mean @ output + bias)))
            for b, s in shares[i].items():
                vectors[b] += step * np.sqrt(s) * output
            output = output + step * mean
            bias += 0.1 * step
    return vectors @ output, bias


def test_quality_equals_plain_descent_and_scores(spark, docs):
    texts = ["good plain words hère", "bad### bad### bad###", "", "w" * 9_000 + " plain", "some more words\there", "bad### x"]
    label = [1, 0, 1, 1, 1, 0]
    labels = spark.createDataFrame([*enumerate(label)], "doc_id bigint, quality int")
    model = fit_quality(docs(*texts), labels)
    folded, bias = _plain_model(texts, label)
    assert np.allclose(model.folded(), folded, atol=2e-3) and abs(model.bias - bias) < 2e-3
    asked = [*texts, None, "bad### good", "ünknown plain bad### words", "x"]
    for row in score_quality(docs(*asked), model).collect():
        found = _plain_features(asked[row["doc_id"]])
        odds = sum(folded[b] for b in found) / max(len(found), 1) + bias
        assert row["score"] == pytest.approx(1 / (1 + np.exp(-odds)), abs=2e-3)
        assert row["predicted"] == int(row["score"] >= 0.5)


def test_quality_learns_one_row_of_each_id(spark, docs, monkeypatch):
    learned = []
    monkeypatch.setattr(quality, "train", lambda bucket, count, label: learned.extend(label.tolist()))
    table = docs(*[f"copy {i}" for i in range(50)], "other", "third", ids=[0] * 50 + [1, 2])
    fit_quality(table, spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id bigint, quality int"))
    assert learned == [1, 0, 1]


def test_counts_for_the_driver_are_small_and_come_back():
    words = "".join(f"word{i % 700}x{i * i % 997} " for i in range(4_000))
    packed = quality._bucket_counts(pa.array([words, None, "a a b"]))
    buckets, counts = quality._unpacked(packed[0][0].as_py(), packed[1][0].as_py())
    assert (np.diff(buckets.astype(int)) > 0).all() and counts.min() >= 1 and counts.dtype == np.float32
    assert packed[0].nbytes + packed[1].nbytes < 4 * len(buckets)
    assert [len(quality._unpacked(b.as_py(), c.as_py())[0]) for b, c in zip(*packed)][1] == 0
    expected = np.concatenate([b for b, _ in quality._features(*quality.utf8(pa.array([words])), [words])])
    found = np.repeat(buckets, counts.astype(int))
    assert (np.sort(expected) == found).all()
