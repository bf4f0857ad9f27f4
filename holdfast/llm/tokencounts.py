"""Token counts by the whole-token shortcut.

Before any text is read, the whole vocabulary is encoded string by string: those that come
back as one token need no merging wherever they stand as a pre-token, and count 1. Only
the rest is merged, once for each distinct pre-token that a worker remembers. See
``pretokens``. There is no shuffle; what is broadcast has the size of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from holdfast.llm.columns import add_from_text
from holdfast.llm.pretokens import pieces, whole_tokens
from holdfast.llm.textarrays import utf8

LIMIT = 512


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, keep: Sequence[str] | None = None
) -> DataFrame:
    """``keep`` (all columns by default), ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    Counts are those of the tokenizers library for the whole text, without begin, end or
    added special tokens; special strings inside a text count one token. A null or empty
    text has 0 bytes and 0 tokens. Rows are judged one by one, so repeated rows and null ids stay
    as they are; an empty table gives none; columns of the three new names are replaced. A text of
    any length is taken in pieces of about a megabyte. ``tokenizer_path`` must exist on the
    driver and every executor and be a plain byte-level BPE, else it is refused.
    """
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer_path))

    def count(texts: pa.Array) -> list[pa.Array]:
        n_tokens = pieces(tokenizer_path, whole.value).counts(texts)
        return [pa.array(np.diff(utf8(texts)[1])), pa.array(n_tokens), pa.array(n_tokens > limit)]

    return add_from_text(docs, {"n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}, count, keep)
