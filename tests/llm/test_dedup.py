import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import neardup, substrings
from holdfast.llm.components import components
from holdfast.llm.textarrays import window_hashes, words


def _sets(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def _brute(texts, percent):
    sets, head = [_sets(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = head[i], head[j]
                head = [min(a, b) if h in (a, b) else h for h in head]
    return head


def _family(random_, base, copies, edits):
    out = []
    for _ in range(copies):
        w = base.split()
        for _ in range(random_.randint(0, edits)):
            w[random_.randrange(len(w))] = f"e{random_.random()}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent, block", [(85, 128), (80, 8)])
def test_components_equal_brute_force(stored_docs, monkeypatch, percent, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    r = random.Random(percent)
    texts = [None, "", " \n", "a b", "A b", "a b c", "x " * 40, "x " * 50]
    for length, copies, edits in ((8, 6, 1), (40, 30, 2), (120, 40, 6), (300, 25, 12), (3_000, 4, 30)):
        base = " ".join(f"w{r.randrange(10_000)}" for _ in range(length))
        texts += _family(r, base, copies, edits)
    r.shuffle(texts)
    got = neardup.near_duplicates(stored_docs(*texts), percent).orderBy("doc_id").collect()
    assert [g["component_id"] for g in got] == _brute(texts, percent)
    assert [g["n_shingles"] for g in got] == [len(_sets(t)) for t in texts]
    assert all(g["kept"] == (g["doc_id"] == g["component_id"]) for g in got)


def test_keep_one_keeps_columns_and_one_row(stored_docs, docs):
    same = "one two three four five six seven"
    table = stored_docs(same, same, None, "other words", ids=[4, 4, None, None])
    assert neardup.keep_one(table).columns == table.columns
    assert neardup.keep_one(table).count() == 3
    assert neardup.keep_one(docs()).count() == 0


def test_rows_keep_their_numbers_when_scans_are_split_anew(stored_docs, conf, monkeypatch):
    r = random.Random(6)
    texts = [" ".join(f"w{r.randrange(10_000)}" for _ in range(60)) for _ in range(60)]
    texts += [t + " more" for t in texts[:30]]
    table, splits = stored_docs(*texts), ["8k", "128m"]

    def resplit(df, name):
        out = stored(df, name)
        splits.reverse()
        conf(spark__sql__files__maxPartitionBytes=splits[0], spark__sql__files__openCostInBytes="0")
        return out

    stored = neardup.stored
    monkeypatch.setattr(neardup, "stored", resplit)
    kept = neardup.keep_one(table, 85)
    for size in ("8k", "128m"):
        conf(spark__sql__files__maxPartitionBytes=size)
        assert sorted((x["doc_id"], x["text"]) for x in kept.select("*").collect()) == list(enumerate(texts[:60]))


def test_a_large_component_is_sent_only_to_the_rest_of_its_group(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    label = {cid: 1 if cid <= 400 else cid // 2 for cid in range(1, 411)}
    rows = [(hub, cid, 9, label[cid], b"") for hub in (1, 2) for cid in label] + [(3, 1, 9, 1, b""), (3, 2, 9, 1, b"")]
    known = spark.createDataFrame(rows, "hub bigint, cid bigint, n bigint, label bigint, sketch binary")
    met = Counter()
    sent = neardup._paired(known).collect()
    for hub, low, high in {(r["hub"], r["low"], r["high"]) for r in sent}:
        here = [r for r in sent if (r["hub"], r["low"], r["high"]) == (hub, low, high)]
        left = [r["cid"] for r in here if r["side"] == 0]
        right = left if low == high else [r["cid"] for r in here if r["side"] == 1]
        met.update({(hub, *sorted((a, b))) for a in left for b in right if label[a] != label[b]})
    wanted = {(hub, a, b) for hub in (1, 2) for a in label for b in label if a < b and label[a] != label[b]}
    assert set(met) == wanted and max(met.values()) == 1
    assert len(sent) == 2 * (400 * 2 + 10 * (50 + 2))  # every member to every block: 42,640


def test_only_links_across_components_are_put_together_again(stored_docs, monkeypatch):
    seen = []

    def counted(links):
        seen.append(links.count())
        return components(links)

    monkeypatch.setattr(neardup, "components", counted)
    r = random.Random(5)
    texts = _family(r, " ".join(f"w{r.randrange(10_000)}" for _ in range(400)), 12, 1)
    got = neardup.near_duplicates(stored_docs(*texts), 80).collect()
    assert {g["component_id"] for g in got} == {0}
    assert len(seen) == 2 and seen[0] > 0 and seen[1] == 0


def test_estimates_are_close():
    r = np.random.default_rng(1)
    both = np.unique(r.integers(0, 1 << 63, 3_000).astype(np.uint64) * np.uint64(2))
    left, right = np.sort(both[:2_700]), np.sort(both[300:])
    sketch = [neardup.registers(x)[None] for x in (left, right)]
    assert neardup.jaccard_estimates(*sketch)[0, 0] == pytest.approx(0.8, abs=0.12)


def test_components_of_a_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components(links).select("label").distinct().collect() == [(0,)]
    assert components(links.limit(0)).count() == 0


def test_cover_reaches_every_pair_of_positions():
    p = substrings.PERIOD
    for x in range(p):
        for y in range(p):
            assert any((x + d) % p in substrings.COVER and (y + d) % p in substrings.COVER for d in range(p))
    assert substrings.ANCHOR + p - 1 <= substrings.WINDOW


def _without_repeats(texts):
    listed = [(t or "").encode().split() for t in texts]
    n = substrings.WINDOW
    seen = Counter(tuple(w[k : k + n]) for w in listed for k in range(len(w) - n + 1))
    out = []
    for w in listed:
        gone = set()
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k : k + n])] > 1:
                gone |= set(range(k, k + n))
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def test_repeats_equal_brute_force(stored_docs, docs):
    r = random.Random(3)
    word = lambda: f"é{r.randrange(10**6)}"
    passages = [" ".join(word() for _ in range(k)) for k in (34, 35, 36, 60, 200)]
    texts = [None, "", "of " * 36, "of " * 35, "a\u00a0b \x0b c", passages[4], passages[4]]
    for _ in range(120):
        parts = [" ".join(word() for _ in range(r.randrange(60))) for _ in range(3)]
        parts.insert(r.randrange(3), r.choice(passages))
        texts.append("\n ".join(parts))
    texts.append(" ".join(word() for _ in range(30_000)) + " " + passages[2])
    got = substrings.remove_repeats(stored_docs(*texts).withColumn("chunk", F.lit(1)).withColumn("hash", F.lit("h")))
    rows = got.orderBy("doc_id").collect()
    assert [(g["n_words"], g["n_removed"], g["text"]) for g in rows] == _without_repeats(texts)
    assert rows[0]["chunk"] == 1 and rows[0]["hash"] == "h"
    left = substrings.remove_repeats(stored_docs("a  b", "of " * 40), leave=True).orderBy("doc_id").collect()
    assert [x["text"] for x in left] == ["a  b", ""]
    assert substrings.remove_repeats(docs()).count() == 0


def test_repeats_of_a_shuffled_input_and_by_bytes(spark, docs, monkeypatch):
    r = random.Random(9)
    word = lambda: f"w{r.randrange(10**6)}"
    passage = " ".join(word() for _ in range(80))
    texts = [" ".join(word() for _ in range(r.choice((20, 200, 3_000)))) for _ in range(60)]
    texts = [t + " " + passage if k % 4 == 0 else t for k, t in enumerate(texts)] + [passage * 3]
    monkeypatch.setattr(substrings, "CHUNK_ROW", 1 << 9)
    shuffled = docs(*texts).repartition(5).distinct()
    got = substrings.remove_repeats(shuffled, keep=["doc_id"]).orderBy("doc_id").collect()
    assert [(g["n_words"], g["n_removed"], g["text"]) for g in got] == _without_repeats(texts)


def test_chunks_are_bounded_by_bytes(spark):
    sizes = [0, 10, (1 << 15) - 1, 1 << 15, 1 << 16, 100_000, 1 << 20, (1 << 22) - 1, 1 << 22, 1 << 27]
    rows = spark.range(0, 20_000, 1, 1).withColumn("size", F.element_at(F.array(*map(F.lit, sizes)), (F.col("id") * 7 % 10 + 1).cast("int")))
    chunks = rows.groupBy(substrings._chunk(F.col("id"), F.col("size")).alias("chunk")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    assert chunks.filter("n > 256 or n > 1 and bytes > 1 << 23").count() == 0
    assert chunks.filter("n = 1").agg(F.max("bytes")).first()[0] == 1 << 27


def test_windows_are_compared_by_both_hashes(spark):
    first, second = np.array([5, 5, 5, 2, 9], np.uint64), np.array([1, 3, 3, 7, 0], np.uint32)
    rows = substrings._rows_of(4, hash=first, second=second).to_pylist()
    assert sorted((x["hash"], x["second"]) for x in rows) == [(2, 7), (5, 1), (5, 3), (5, 3), (9, 0)]
    sent = spark.createDataFrame([*((x["hash"], x["second"], 4) for x in rows), (9, 1, 6), (2, 7, 6)], substrings._WINDOWS)
    found = substrings._repeated(sent, "hash", "second").collect()
    assert sorted((x["hash"], x["chunk"]) for x in found) == [(2, 4), (2, 6), (5, 4), (5, 4)]


def test_words_of_alternating_form_do_not_collide():
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(2_048))  # collides for powers of any odd base
    text = (one + " " + one.translate(str.maketrans("ab", "ba"))).encode()
    assert len(set(words(np.frombuffer(text, np.uint8), np.array([0, len(text)])).hashes.tolist())) == 2


def test_a_word_hashes_alike_beside_a_long_one():
    def hashes(text):
        return words(np.frombuffer(text, np.uint8), np.array([0, len(text)])).hashes.tolist()

    long = b"q" * 9_000
    assert hashes(b"some words") == hashes(b"some words " + long)[:2] == hashes(b"some " + b" " * 9_000 + b"words")
    assert hashes(long) == hashes(long + b" " + b"z" * 90_000)[:1]


def test_long_words_and_windows_hash_by_content():
    text = ("q" * 10_000 + " " + "z " * 3 + "q" * 10_000).encode()
    found = words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert found.hashes[0] == found.hashes[-1] and len(set(found.hashes.tolist())) == 2
    h = window_hashes(np.arange(50, dtype=np.uint64), 35)
    assert len(h) == 16 == len(set(h.tolist()))
    assert hashlib.sha1(window_hashes(np.arange(5, dtype=np.uint64), 5)).digest()
