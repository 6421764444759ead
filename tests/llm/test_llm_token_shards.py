import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortwise.llm import token_shards
from cohortwise.llm.queries import QUERIES
from cohortwise.sources import io

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(0, 10))
def test_elias_fano_returns_what_went_in(values, over):
    values = sorted(values)
    ef = token_shards.EliasFano.of(np.array(values, np.int64), (values[-1] if values else 0) + over)
    again = token_shards.EliasFano(ef.n, ef.low_bits, ef.low.tobytes(), ef.high.tobytes(), ef.samples.tobytes())
    assert again.values().tolist() == values
    assert [again.select(i) for i in range(len(values))] == values


def test_elias_fano_is_near_the_bound_of_its_space():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000))
    ef = token_shards.EliasFano.of(values, int(values[-1]))
    bits = 8 * (ef.low.nbytes + ef.high.nbytes) / len(values)
    assert bits <= 2 + np.log2(values[-1] / len(values)) + 0.1
    assert ef.samples.nbytes <= len(values) / 15


ODD = ["", " ", "\n", "  two  spaces ", "a\t \n b", "don't we'll I'm", "tab\there", "é nbsp x", "x\x1cy \x1d z!\x1e", "end\n\n\n", " line em", "<|endoftext|> text",
       "a" * 5000, "漢字 かな 🙂🙂 ok", "1234 56,7", "\r\n\r\nwin", "!!! ??? ...", " lead", "trail ", "﻿bom", "word ​ zero"]


def test_units_give_the_ids_of_the_whole_text(library):
    got = token_shards.UnitEncoder(PATH).encode(ODD)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [library(t) for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list(" \n\t\r\x0b\x1c\x85 　abcZé9'!-漢🙂")), max_size=40))
def test_units_of_any_text(text):
    if not hasattr(test_units_of_any_text, "pair"):
        t = Tokenizer.from_file(PATH)
        t.encode_special_tokens = True
        test_units_of_any_text.pair = t, token_shards.UnitEncoder(PATH)
    t, encoder = test_units_of_any_text.pair
    assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == t.encode(text, add_special_tokens=False).ids


def expected(rows, library, end=0):
    out, start = {}, 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = library(text) + [end]
        out.setdefault(doc_id, []).append((start, ids))
        start += len(ids)
    return out


def test_files_hold_all_documents_in_order(spark, frame, library):
    rows = [(i * 7 % 101, t) for i, t in enumerate(ODD)] + [(200, None), (None, "no id"), (3000, "same id"), (3000, "other text"), (5, "word " * 3000)]
    path = io.fresh_path(spark, "test-shards")
    token_shards.write(frame(rows).repartition(5).withColumnRenamed("source", "ids"), path, PATH, segment=50)
    want = expected(rows, library)
    got = token_shards.read(spark, path).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.start, r.ids) in want[r.doc_id]
    digests = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_shards.digests(spark, path).collect()}
    assert digests == {(k, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, v in want.items() for s, ids in v}


def test_empty_table(spark, frame):
    path = io.fresh_path(spark, "test-shards")
    token_shards.write(frame([]), path, PATH)
    assert token_shards.digests(spark, path).collect() == []


def test_query_equals_brute_force(spark, small, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    want = {(k, s, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, v in expected(rows, library).items() for s, ids in v}
    assert {tuple(r) for r in QUERIES["op1_elias_fano_token_shards"](spark, small).select("doc_id", "start", "n_tokens", "ids_crc32").collect()} == want
