"""Token ids are those of the library as it loads the file."""

from __future__ import annotations

import zlib

import numpy as np

from clausemill.llm import token_output
from tests.llm.test_operators import BPE, by_id


def test_strings_of_added_tokens_are_the_librarys(spark):
    from tokenizers import Tokenizer

    tok, start, want = Tokenizer.from_file(BPE), 0, {}
    rows = [(0, "a <|endoftext|> x"), (1, "plain words"), (2, "x<|endoftext|>\n<|endoftext|>y"), (3, "<|endoftext|>"), (4, "a x plain <|endo")]
    for i, t in rows:
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want[i] = {"start": start, "n_tokens": len(ids), "ids_crc32": zlib.crc32(np.array(ids, "<u4").tobytes())}
        start += len(ids)
    assert tok.encode(rows[0][1], add_special_tokens=False).ids == [64, 220, 50256, 2124]
    assert by_id(token_output.token_output(spark.createDataFrame(rows, "doc_id long, text string"), BPE)) == want
