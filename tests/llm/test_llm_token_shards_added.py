import zlib

import numpy as np
from tokenizers import Tokenizer

from cohortwise.llm import token_shards
from test_llm_token_shards import ODD, PATH

TEXTS = [*ODD, "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\ny", "<|endoftext|", "a b"]


def test_query_gives_the_ids_of_the_library_as_loaded(frame):
    plain = Tokenizer.from_file(PATH)
    want, start = set(), 0
    for i, text in enumerate(TEXTS):
        ids = plain.encode(text, add_special_tokens=False).ids + [0]
        want.add((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert plain.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    assert {tuple(r) for r in token_shards.written_digests(frame(list(enumerate(TEXTS))), PATH).collect()} == want
