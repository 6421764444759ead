"""SentencePiece encoding and decoding by streaming Viterbi.

The pieces of a vocabulary file are states of a best-path search over the characters, with spaces written as U+2581 and one put
in front. Only the last `longest` boundaries (the longest piece's length) can still be the start of a piece; as soon as the backpointer
paths of all of them run through one boundary, the ids before it are committed and their part of the window is forgotten.
Memory is thus that of the window, not of the text.

A boundary that no piece can span is one where all paths meet whatever comes next: before a space that follows another character, on both sides
of a line end if no piece holds one, and after a run of letters before signs that no piece joins to a letter. Texts are cut there, and as
the best path of such a unit depends on nothing else, short units are searched once and remembered.

Scores are log-probabilities. A file of merge ranks (scores 0, -1, -2 ...) has none; for it, `scores="zipf"` takes the probability of the
piece of rank r as proportional to 1 / (r + 1), and `scores="file"` takes the file's numbers as they are. Characters outside
the vocabulary cost the least score minus 10 and become byte pieces. Equal paths: the longer last piece wins.

Defined results: a missing text has missing ids; an empty one has none. U+2581 in a text is a space when decoded, as in
the file format itself; every other text is decoded exactly. Repeated rows are encoded alike.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortwise.llm.common import Remembered

SPACE = "▁"
_NEVER, _MISS = -(1 << 62), (0, -2)
_LETTERS = frozenset(c for c in map(chr, range(0x41, 0x100)) if c.isalpha() and c not in "ªµº")
#: Units whose ids one Python worker remembers, and the length of the longest of them.
REMEMBERED, SHORT = 1 << 18, 48
UNKNOWN_PENALTY = 10.0
#: Scores are whole numbers of this part of one: sums are exact, so that equal paths stay equal wherever a text is cut.
UNIT = 1 << 16


class Vocabulary:
    def __init__(self, path: str, scores: str = "zipf"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.vocab_size())
        plain = [i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        raw = {i: model.get_score(i) for i in plain}
        if scores == "zipf":
            norm = math.log(sum(1 / (r + 1) for r in range(len(plain))))
            raw = {i: s if s <= -1e8 else -math.log1p(-s) - norm for i, s in raw.items()}
        raw = {i: round(s * UNIT) for i, s in raw.items()}
        self.pieces = {model.id_to_piece(i): (raw[i], i) for i in plain}
        self.unknown = min((s for s in raw.values() if s > -1e8 * UNIT), default=0) - round(UNKNOWN_PENALTY * UNIT)
        self.longest = max(map(len, self.pieces), default=1)
        of_byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in every if model.is_byte(i)}
        self.byte_ids = [of_byte.get(b, model.unk_id()) for b in range(256)]
        self.bytes_of = [b""] * len(every)
        for piece, (_, i) in self.pieces.items():
            self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        for b, i in of_byte.items():
            self.bytes_of[i] = bytes([b])
        pairs = {(a, b) for p in self.pieces for a, b in zip(p, p[1:])}
        self.units = None
        if not any(b == SPACE and a != SPACE for a, b in pairs):
            line = "\n" if not any("\n" in p for p in pairs) else ""
            signs = "".join(re.escape(c) for c in map(chr, range(0x21, 0x7F)) if not c.isalpha() and not any(b == c and a in _LETTERS for a, b in pairs))
            letters = f"{SPACE}*[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[{SPACE}{line}{signs}]|\\Z)|" if signs else ""
            self.units = re.compile(f"{letters}{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + (f"|{line}" if line else "")).findall
        self.table: dict[str, tuple[int, int] | None] = {}  # pieces, and None for what only begins one
        for piece in self.pieces:
            for end in range(1, len(piece)):
                self.table.setdefault(piece[:end], None)
        self.table.update(self.pieces)
        self.kind, self.code = ("<u2", "H") if len(every) <= 1 << 16 else ("<u4", "I")


class StreamingViterbi:
    """Feed characters; take committed ids as they come.

    Starts before `done` have passed their score on to the ends of all pieces that begin there. A start waits until the longest piece's length is at hand.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._reset()

    def _reset(self) -> None:
        self.text, self.done, self.check = "", 0, 8 * self.v.longest
        self.best, self.back, self.piece = [0], [0], [-1]

    def feed(self, text: str) -> list[int]:
        """Search on over some more text; the ids that became certain."""
        out: list[int] = []
        step = 8 * self.v.longest
        for at in range(0, len(text), step):
            self._append(text[at:at + step])
            self._relax(len(self.text) - self.v.longest)
            if self.done >= self.check:
                out += self._commit(self._meeting())
                self.check = 2 * self.done + step  # looked for again when what is held has doubled
        return out

    def finish(self) -> list[int]:
        self._relax(len(self.text))
        out = self._commit(len(self.text))
        self._reset()
        return out

    def _append(self, more: str) -> None:
        n = len(more)
        self.text += more
        self.best += [_NEVER] * n
        self.back += [0] * n
        self.piece += [-1] * n

    def _relax(self, upto: int) -> None:
        text, best, back, piece, longest, n = self.text, self.best, self.back, self.piece, self.v.longest, len(self.text)
        get, unknown = self.v.table.get, self.v.unknown
        for start in range(self.done, upto):
            base = best[start]
            if base == _NEVER:
                continue
            end = start + 1
            got = get(text[start], _MISS)
            if got is _MISS or got is None:
                if base + unknown > best[end]:
                    best[end], back[end], piece[end] = base + unknown, start, -1
                if got is _MISS:
                    continue
            elif base + got[0] > best[end]:
                best[end], back[end], piece[end] = base + got[0], start, got[1]
            for end in range(start + 2, n + 1 if n < start + longest else start + longest + 1):
                got = get(text[start:end], _MISS)
                if got is None:
                    continue
                if got is _MISS:
                    break
                score = base + got[0]
                if score > best[end]:
                    best[end], back[end], piece[end] = score, start, got[1]
        self.done = max(self.done, upto)

    def _meeting(self) -> int:
        """The boundary that the paths of all possible starts run through."""
        live = {i for i in range(self.done, min(len(self.text), self.done + self.v.longest - 1) + 1) if self.best[i] > _NEVER}
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(self.back[last])
        return live.pop()

    def _commit(self, upto: int) -> list[int]:
        out: list[int] = []
        at = upto
        while at > 0:
            start = self.back[at]
            if self.piece[at] >= 0:
                out.append(self.piece[at])
            else:
                out += [self.v.byte_ids[b] for b in reversed(self.text[start:at].encode("utf-8", "surrogatepass"))]
            at = start
        if upto:
            self.text = self.text[upto:]
            base = self.best[upto]
            self.best = [s if s == _NEVER else s - base for s in self.best[upto:]]
            self.back = [0] + [b - upto for b in self.back[upto + 1:]]
            self.piece = [-1] + self.piece[upto + 1:]
            self.done -= upto
        return out[::-1]


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.stream = StreamingViterbi(vocabulary)
        self.remembered = Remembered(lambda units: map(self.search, units), REMEMBERED, SHORT)

    def search(self, text: str) -> bytes:
        return array(self.v.code, self.stream.feed(text) + self.stream.finish()).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        texts = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        if self.v.units is None:
            return [self.search(t) for t in texts]
        return [b"".join(values) for values in self.remembered(map(self.v.units, texts))]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of a text."""
        return b"".join(map(self.v.bytes_of.__getitem__, ids.tolist()))[1:]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, scores: str) -> Encoder:
    key = path, scores
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(Vocabulary(path, scores))
    return _ENCODERS[key]


#: Bytes of text worked through at a time.
SLICE = 1 << 21


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(texts)]
    return zip(cuts, cuts[1:])


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids", exact: str | None = None, scores: str = "zipf") -> DataFrame:
    """All columns of docs (but for those named `into` and `exact`), the array of piece ids of the text and, if asked for, whether its decoding is the text."""
    kept = [f for f in docs.schema if f.name not in (into, exact)]
    more = [T.StructField(into, T.ArrayType(T.IntegerType())), *([T.StructField(exact, T.BooleanType())] if exact else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, scores)
        for b in batches:
            for lo, hi in _slices(b.column(text)):
                texts = b.column(text)[lo:hi].to_pylist()
                packed = [None if t is None else np.frombuffer(p, encoder.v.kind) for t, p in zip(texts, encoder.encode(texts))]
                ends = np.cumsum([0] + [0 if p is None else len(p) for p in packed])
                ids = np.concatenate([p for p in packed if p is not None] or [np.empty(0)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids), mask=pa.array([p is None for p in packed]))
                same = [pa.array([p is None or encoder.decode(p) == t.encode() for t, p in zip(texts, packed)], pa.bool_())] if exact else []
                yield pa.RecordBatch.from_arrays([*[b.column(f.name).slice(lo, hi - lo) for f in kept], lists, *same], names=[*[f.name for f in kept], *[f.name for f in more]])
    return docs.mapInArrow(run, T.StructType([*kept, *more]))


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded", scores: str = "zipf") -> DataFrame:
    """All columns (but for one named `into`) and the text of the ids; bytes that are no UTF-8 become U+FFFD."""
    kept = [f for f in encoded.schema if f.name != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, scores)
        for b in batches:
            lists = b.column(ids)
            ends, flat, empty = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False), lists.is_null().to_pylist()
            texts = [None if none else encoder.decode(flat[a:z]).decode("utf-8", "replace") for a, z, none in zip(ends, ends[1:], empty)]
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(texts, pa.string())], names=[*[f.name for f in kept], into])
    return encoded.mapInArrow(run, T.StructType([*kept, T.StructField(into, T.StringType())]))


def round_trip(docs: DataFrame, path: str, scores: str = "zipf") -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (of the ids as little-endian 32-bit numbers), crc32 of the text and of the decoded ids, and whether these are equal.

    A missing text counts as empty here. Encoding and decoding share one Python worker, so that ids do not travel.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, scores)
        for b in batches:
            for lo, hi in _slices(b.column("text")):
                texts = [t or "" for t in b.column("text")[lo:hi].to_pylist()]
                rows = []
                for text, packed in zip(texts, encoder.encode(texts)):
                    ids, raw = np.frombuffer(packed, encoder.v.kind), text.encode()
                    decoded = encoder.decode(ids)
                    rows.append((len(ids), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(raw), zlib.crc32(decoded), raw == decoded))
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), (*(pa.int64(),) * 4, pa.bool_()))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), *columns], names=["doc_id", "n_pieces", "ids_crc32", "text_crc32", "decoded_crc32", "exact"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, text_crc32 long, decoded_crc32 long, exact boolean")
