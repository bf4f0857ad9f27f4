import random

from holdfast.llm.decontam import drop_contaminated, find_items


def _shingles(text):
    w = (text or "").lower().encode().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_found_items_equal_brute_force(spark, docs):
    r = random.Random(2)
    items = [" ".join(f"w{r.randrange(500)}" for _ in range(r.randrange(5, 60))) for _ in range(40)]
    items += [None, "", "a b", "A  b\n", items[0], "w7", "w8 w9 w10", "c d e f"]
    texts = [None, "", "a b", "a b c d e", "b a", "x c d e f", "w7", "w8 w9"]
    for k in range(150):
        item = (r.choice(items[:40])).split()
        for _ in range(r.randrange(4)):
            item[r.randrange(len(item))] = "other"
        around = [f"w{r.randrange(500)}" for _ in range(r.randrange(400))]
        texts.append(" ".join(around[:50] + [w.upper() if k % 2 else w for w in item] + around[50:]))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    table = docs(*texts)
    expected = {}
    for d, text in enumerate(texts):
        held = _shingles(text)
        for i, item in enumerate(items):
            n, found = len(_shingles(item)), len(_shingles(item) & held)
            short = (item or "").lower().split()
            if 0 < len(short) < 5:  # found as a run of its words
                w = (text or "").lower().split()
                found = int(any(w[k : k + len(short)] == short for k in range(len(w))))
            if n and 100 * found >= 80 * n:
                expected[d, i] = (n, found)
    got = {(x["doc_id"], x["item_id"]): (x["n_shingles"], x["n_found"]) for x in find_items(table, benchmark).collect()}
    assert got == expected and len(got) > 50
    clean = drop_contaminated(table, benchmark)
    assert clean.columns == table.columns
    assert {x["doc_id"] for x in clean.collect()} == set(range(len(texts))) - {d for d, _ in expected}


def test_blocks_nulls_and_empty_tables(spark, docs, monkeypatch):
    monkeypatch.setattr("holdfast.llm.decontam.BLOCK_KEYS", 3)
    words = " ".join(f"q{i}" for i in range(30))
    benchmark = spark.createDataFrame([(1, words), (2, words[:40])], "item_id int, text string")
    table = docs(words, words, "clean", ids=[None, 4, None])
    assert {tuple(x)[:2] for x in find_items(table, benchmark).collect()} == {(None, 1), (4, 1), (None, 2), (4, 2)}
    assert [x["text"] for x in drop_contaminated(table, benchmark).collect()] == ["clean"]
    assert find_items(docs(), benchmark).count() == find_items(table, benchmark.limit(0)).count() == 0


def test_long_items_and_texts(spark, docs, monkeypatch):
    monkeypatch.setattr("holdfast.llm.decontam.BLOCK_KEYS", 1_000)
    long = " ".join(f"i{k}" for k in range(6_000))
    changed = " ".join(w if k % 40 else "gone" for k, w in enumerate(long.split()))
    less = " ".join(w if k % 20 else "gone" for k, w in enumerate(long.split()))
    table = docs("before " + changed + " after " * 20_000, less, long).withColumnsRenamed({"lang": "item", "source": "t1"})
    benchmark = spark.createDataFrame([(1, long)], "item_id int, text string")
    assert sorted(x["doc_id"] for x in find_items(table, benchmark).collect()) == [0, 2]
    assert [x["doc_id"] for x in drop_contaminated(table, benchmark).collect()] == [1]


def test_main_path_has_no_python(spark, docs, tmp_path):
    docs("a b c d e f").write.parquet(f"{tmp_path}/d")
    spark.sql("select 1 as item_id, 'a b c d e f' as text").write.parquet(f"{tmp_path}/b")
    found = find_items(spark.read.parquet(f"{tmp_path}/d"), spark.read.parquet(f"{tmp_path}/b"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
