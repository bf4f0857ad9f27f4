import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from holdfast.llm import pretokens, tokencounts
from holdfast.llm.queries import llm_queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
SIGNS = ["a", "s", "re", "ll", "ve", "'", " ", "  ", "\n", "\t", "1", "²", "é", "你", "　", "\xa0", "😀", "!", "T"]
SIGNS += ["<|endoftext|>", "<|", "́", "Ⅷ", "\x85", "​", " don't", " extraordinarily", " the"]


def plain(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SIGNS) | st.characters(codec="utf-8"), max_size=30).map("".join), max_size=5))
def test_counts_of_any_text(texts):
    found = pretokens.pieces(PATH, pretokens.whole_tokens(PATH))
    assert found.counts(pa.array(texts, pa.string())).tolist() == plain(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SIGNS), max_size=80).map("".join), min_size=1, max_size=4))
def test_cut_texts_and_a_full_table(texts):
    keep = pretokens.SLICE_BYTES, pretokens.PART
    pretokens.SLICE_BYTES, pretokens.PART = 16, 4
    try:
        found = pretokens.Pieces(PATH, pretokens.whole_tokens(PATH))
        found.size, found.begin = found.size[: found.table.count + 9], found.begin[: found.table.count + 9]
        assert found.counts(pa.array(texts)).tolist() == plain(texts)
        ids, _ = found.ids(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in LIBRARY.encode(t, add_special_tokens=False).ids]
    finally:
        pretokens.SLICE_BYTES, pretokens.PART = keep


def test_whole_tokens_are_proved():
    whole = pretokens.whole_tokens(PATH)
    assert len(whole.ids) > 45_000  # of 50,256; the rest are parts of characters, or long
    texts = [LIBRARY.decode([i]) for i in whole.ids[:2_000].tolist()]
    assert plain(texts) == [1] * len(texts)


def test_edge_rows(spark, docs):
    long = "lorem ipsum dolor " * 200_000 + "x" * 50_000
    texts = [None, "", long, "a b", "a b", "<|endoftext|> b"]
    rows = docs(*texts, ids=[1, 2, 3, None, None, 6]).withColumnsRenamed({"source": "n_tokens", "lang": "over_limit"})
    got = tokencounts.count_tokens(rows, PATH)
    assert got.columns == ["doc_id", "text", "n_chars", "n_bytes", "n_tokens", "over_limit"]
    found = {(r["doc_id"], r["text"]): (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got.collect()}
    assert got.count() == 6
    for i, t in zip([1, 2, 3, None, None, 6], texts):
        n = plain([t])[0]
        assert found[i, t] == (len(t or ""), n, n > 512)
    assert tokencounts.count_tokens(docs(), PATH, keep=["doc_id"]).count() == 0


def test_other_tokenizers_are_refused(docs):
    with pytest.raises(ValueError, match="byte-level"):
        tokencounts.count_tokens(docs("a"), public_tokenizers.path("word_bpe_49k.json"))


def test_query_against_the_library(spark):
    directory = "/root/testdata/sf0.001"
    got = llm_queries()["op13_whole_token_counts"](spark, directory).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{directory}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for row, n in zip(got, plain([texts[r["doc_id"]] for r in got])):
        size = len((texts[row["doc_id"]] or "").encode())
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (size, n, n > 512)
