import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortwise.llm import sentencepiece_viterbi as sp
from cohortwise.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
S = sp.SPACE


@pytest.fixture(scope="module")
def vocabulary():
    return sp.Vocabulary(PATH)


def best_score(v, text):
    """Score of the best path by a plain search over the whole text."""
    best = [0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - v.longest), end):
            got = v.pieces.get(text[start:end])
            if got:
                best[end] = max(best[end], best[start] + got[0])
        if text[end - 1] not in v.pieces:
            best[end] = max(best[end], best[end - 1] + v.unknown)
    return best[-1]


def score_of(v, text, ids):
    """Score of given ids, which have to spell the text."""
    score_by_id = {i: (s, p) for p, (s, i) in v.pieces.items()}
    at, total, k = 0, 0, 0
    while k < len(ids):
        if ids[k] in score_by_id:
            s, p = score_by_id[ids[k]]
            assert text.startswith(p, at)
            at, total, k = at + len(p), total + s, k + 1
        else:
            raw = text[at].encode()
            assert ids[k:k + len(raw)] == [v.byte_ids[b] for b in raw]
            at, total, k = at + 1, total + v.unknown, k + len(raw)
    assert at == len(text)
    return total


TEXTS = ["the thing", " a  b\t\nc", "é漢字🙂 ok", "x" * 500, "Ciónmenteueó. Les\nfin", "thethethe" * 40, "\n\n", "   ", "a▁b", "<s> </s> <unk> <0x41>", "word.\nNext line\n"]


@pytest.mark.parametrize("text", TEXTS)
def test_streamed_path_is_a_best_one(vocabulary, text):
    written = S + text.replace(" ", S)
    ids = np.frombuffer(sp.Encoder(vocabulary).encode([text])[0], vocabulary.kind).tolist()
    assert score_of(vocabulary, written, ids) == best_score(vocabulary, written)


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(list("the aionrs\n▁é🙂.Q")), max_size=60), st.integers(1, 9))
def test_any_text_in_any_portions(text, portion):
    v = test_any_text_in_any_portions.__dict__.setdefault("v", sp.Vocabulary(PATH))
    written = S + text.replace(" ", S)
    stream, ids = sp.StreamingViterbi(v), []
    for at in range(0, len(written), portion):
        ids += stream.feed(written[at:at + portion])
    ids += stream.finish()
    assert score_of(v, written, ids) == best_score(v, written)
    whole = np.frombuffer(sp.Encoder(v).encode([text])[0], v.kind).tolist()
    assert whole == (ids if text else [])


def _varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _fields(data):
    at = 0
    while at < len(data):
        key, shift = 0, 0
        while True:
            key |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                break
        start = at
        if key & 7 == 2:
            n, shift = 0, 0
            while True:
                n |= (data[at] & 127) << shift
                shift, at = shift + 7, at + 1
                if data[at - 1] < 128:
                    break
            yield key, data[at:at + n]
            at += n
        elif key & 7 == 0:
            while data[at] > 127:
                at += 1
            at += 1
            yield key, data[start:at]
        else:
            at += 4 if key & 7 == 5 else 8
            yield key, data[start:at]


def as_unigram(path, score):
    """The model file with its pieces' scores replaced and its kind set to the library's unigram search."""
    out = b""
    for key, value in _fields(open(path, "rb").read()):
        if key == 1 << 3 | 2:
            piece = b""
            for k, x in _fields(value):
                if k == 2 << 3 | 5:
                    x = np.float32(score(float(np.frombuffer(x, "<f4")[0]))).tobytes()
                piece += _varint(k) + (_varint(len(x)) if k & 7 == 2 else b"") + x
            value = piece
        if key == 2 << 3 | 2:
            value = b"".join(_varint(k) + (_varint(len(x)) if k & 7 == 2 else b"") + x for k, x in _fields(value) if k != 3 << 3) + _varint(3 << 3) + b"\x01"
        out += _varint(key) + (_varint(len(value)) if key & 7 == 2 else b"") + value
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def test_library_finds_the_same_ids_with_the_same_scores(spark, small, vocabulary):
    scores = {i: s / sp.UNIT for s, i in vocabulary.pieces.values()}
    raw = sentencepiece.SentencePieceProcessor(model_file=PATH)
    by_raw = {raw.get_score(i): s for i, s in scores.items()}
    library = as_unigram(PATH, lambda s: max(by_raw.get(s, s), -100.0))  # its 32-bit sums would lose all else to the file's -1e9 of runs of spaces
    encoder = sp.Encoder(vocabulary)
    same = whole = 0
    for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect():
        mine, theirs = np.frombuffer(encoder.encode([r.text])[0], vocabulary.kind).tolist(), library.encode(r.text)
        written = S + r.text.replace(" ", S)
        whole += 1
        same += mine == theirs
        if mine != theirs:  # the library adds up 32-bit numbers; only near ties may differ
            assert score_of(vocabulary, written, theirs) == pytest.approx(score_of(vocabulary, written, mine), abs=0.01 * sp.UNIT)
    assert same >= 0.9 * whole


def test_window_stays_small(vocabulary):
    stream, most = sp.StreamingViterbi(vocabulary), 0
    for _ in range(300):
        stream.feed("thingationerst" * 7)
        most = max(most, len(stream.text), len(stream.best))
    assert most < 8 * vocabulary.longest


def test_file_scores(vocabulary):
    v = sp.Vocabulary(PATH, scores="file")
    ids = np.frombuffer(sp.Encoder(v).encode(["the thing"])[0], v.kind).tolist()
    assert score_of(v, S + "the▁thing", ids) == best_score(v, S + "the▁thing")


def test_edges(frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (101, ""), (None, "x"), (3, TEXTS[0]), (3, TEXTS[0]), (102, "long text " * 40_000), (103, "y" * 30_000)]
    docs = frame(rows).withColumnRenamed("source", "ids")
    got = sp.decode(sp.encode(docs, PATH), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.decoded == (None if r.text is None else r.text.replace(S, " "))
        assert r.ids == (None if r.text is None else [] if r.text == "" else r.ids)
    assert sp.round_trip(frame([]), PATH).collect() == []
    trip = {r.doc_id: r for r in sp.round_trip(frame(rows), PATH).collect()}
    assert trip[100].n_pieces == trip[101].n_pieces == 0 and trip[100].ids_crc32 == 0 and trip[100].exact


def test_query_equals_brute_force(spark, small, vocabulary):
    encoder = sp.Encoder(vocabulary)
    got = {r.doc_id: r for r in QUERIES["op10_streaming_viterbi"](spark, small).collect()}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        written = S + r.text.replace(" ", S)
        ids = np.frombuffer(encoder.search(written), vocabulary.kind)
        assert (got[r.doc_id].n_pieces, got[r.doc_id].ids_crc32) == (len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
        assert got[r.doc_id].exact and got[r.doc_id].text_crc32 == got[r.doc_id].decoded_crc32 == zlib.crc32(r.text.encode())
