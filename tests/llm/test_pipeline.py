import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from holdfast.llm.queries import llm_queries

WORDS = [f"plain{i}" for i in range(400)]


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in llm_queries())
    assert numbers == list(range(1, 14))
    assert {*llm_queries(), "pipeline"} <= set(entry_points.queries())


@pytest.fixture
def corpus(spark, tmp_path):
    def text(start, step):
        return " ".join(f"{WORDS[(start + k * step) % 400]}s{start}" for k in range(60))

    texts = {i: text(i, 7) for i in range(30)}
    texts |= {100: texts[3], 101: texts[4] + " more"}  # copies
    shared = " ".join(f"shared{k}" for k in range(50))
    texts |= {110: text(210, 3) + " " + shared, 111: shared + " " + text(211, 3)}
    item = " ".join(f"item{k}" for k in range(20))
    texts |= {120: text(220, 5) + " " + item + " tail"}
    texts |= {200 + i: "junk### " * (40 + i) for i in range(15)}
    texts |= {300: None, 301: ""}
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, columns).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 200), 0) for i in texts if i < 300]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), texts, shared


def test_stages_take_effect(spark, corpus):
    directory, texts, shared = corpus
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, directory)
        if name != "packing":
            assert out.columns == docs.columns
        docs = corpus_pipeline.stored(out, name)
        left[name] = {r["doc_id"]: r for r in docs.collect()}
    plain = set(range(30)) | {110, 111, 120}
    assert set(left["quality"]) & set(range(200)) == plain | {100, 101}
    assert not set(left["quality"]) & set(range(200, 300))
    assert set(left["near-duplicates"]) & set(range(200)) == plain
    trimmed = left["substrings"]
    assert trimmed[110]["text"] == texts[110].removesuffix(" " + shared)
    assert trimmed[110]["n_chars"] == len(trimmed[110]["text"])
    assert all(trimmed[i]["text"] == texts[i] for i in range(30))
    assert set(left["decontamination"]) == set(trimmed) - {120}
    assert set(left["packing"]) == set(left["decontamination"])


def test_run_on_empty_tables(spark, corpus, tmp_path):
    directory = corpus[0]
    empty = f"{tmp_path}/empty"
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{directory}/{table}.parquet").limit(0).write.parquet(f"{empty}/{table}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
