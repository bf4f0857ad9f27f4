import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenizers import Tokenizer

from holdfast.llm import pretokens, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1) | st.integers(0, 300) | st.just(0), max_size=3_000))
def test_packed_ids_come_back(ids):
    words, offsets = tokens.pack(np.array(ids, np.uint64))
    assert tokens.unpack(words, offsets, len(ids)).tolist() == ids


def test_one_block_alone():
    ids = np.arange(5_000, dtype=np.uint64) * np.uint64(7)
    words, offsets = tokens.pack(ids)
    low, high = offsets[2], offsets[3]
    alone = tokens.unpack(words[low:high], np.array([0, high - low]), tokens.BLOCK_IDS)
    assert (alone == ids[2 * tokens.BLOCK_IDS : 3 * tokens.BLOCK_IDS]).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab' \n\t\u00a0\u3000é日1.,<|>") | st.characters(codec="utf-8"), max_size=40), max_size=4))
def test_pieces_give_the_ids_of_whole_texts(texts):
    found = pretokens.pieces(PATH, pretokens.whole_tokens(PATH))
    ids, sizes = found.ids(pa.array(texts, pa.string()))
    whole = [found.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in whole] and ids.tolist() == sum(whole, [])


@pytest.mark.parametrize("file_ids", [tokens.FILE_IDS, 50])
def test_files(spark, docs, monkeypatch, file_ids):
    monkeypatch.setattr(tokens, "FILE_IDS", file_ids)
    texts = ["a b", None, "", "word " * 5_000, "same", "same", "<|endoftext|> x"]
    ids = [5, 3, None, 1, 8, 8, -2]
    got = tokens.read_tokens(tokens.write_tokens(docs(*texts, ids=ids), PATH), ids=True).orderBy("start").collect()
    encode = Tokenizer.from_file(PATH).encode
    start = 0
    for row, (doc_id, text) in zip(got, sorted(zip(ids, texts), key=lambda x: (x[0] is not None, x[0] or 0))):
        expected = [*encode(text or "", add_special_tokens=False).ids, 2]
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids"]) == (doc_id, start, len(expected), expected)
        assert row["ids_crc32"] == zlib.crc32(np.array(expected, "<u4").tobytes())
        start += len(expected)
    assert len(got) == len(texts)
    assert tokens.read_tokens(tokens.write_tokens(docs(), PATH)).count() == 0
