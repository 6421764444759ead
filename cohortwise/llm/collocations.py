"""Phrase collocations per language by best-first growth with admissible bounds.

n counts a language's words, f(phrase) all contiguous occurrences inside pieces. A candidate is a phrase of 2 to WORDS words
with a = f(phrase) >= LEAST; its score is the lowest floor(1000 * a * n / (l * r)) over its cuts in two, l and r the counts of
both parts. Both parts occur at least a times, so no extension of a prefix x scores above floor(1000 * n / f(x[:k])) for any k;
the first word's count gives the lowest of these bounds.

Words are counted first. Then the texts are written once as stretches of numbers of frequent words, which later passes read.

Growth: the frontier holds prefixes that were counted but not extended. Each pass over the stretches extends the prefixes of the
highest bounds (those whose first word is among the rarest, STEP times more frequent ones in each later pass, and all longer
ones) by one word, and counts the parts that scores still lack: by hash first, then those with a frequent hash by their words. A pass ends with each language's TOP-th surviving score; prefixes
whose bound is below it are never extended, parts of phrases that cannot reach it never counted. Growth ends when no prefix and
no phrase reaches it any more, ties included.

A candidate is dropped if a longer one has the same count: then all its occurrences have the same word before them, or the
same word after them. Each pass keeps the lowest and highest hash of the neighbours, so that this needs no further counts.

Tasks learn what to count from bit tables of hashes (frequent words, prefixes to extend, parts to count, beginnings of both) of at most 2^27
bits each. A false positive only counts a phrase too many, whose count is right as well. Phrases are told apart by their words, not by hashes.

Defined results: missing texts are empty, a missing language is `und`, languages are told apart as they stand. Repeated rows count as often as
they occur. Texts are worked through in slices cut at spaces, so that long ones take no more memory than their word numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.llm.common import BATCH_ROWS, in_parts, small_batches, stage, utf8

WORDS, LEAST, TOP = 5, 100, 2000
#: Growth of the first words' counts from one pass to the next.
STEP = 64
#: Phrases are counted by hash first where prefixes to extend make up more than one in so many words.
MANY = 8
#: Least and most bits of a bit table, and bits for each entry as long as they suffice.
LEAST_BITS, MOST_BITS, PER_ENTRY = 1 << 12, 1 << 27, 16
#: Words that a task counts at once, words it remembers, and bytes of a text it splits at once.
FLUSH, REMEMBERED, SLICE = 1 << 18, 1 << 18, 1 << 20
#: Stretches that are written or read at once: a row of them is up to a megabyte or two.
STRETCHES = 8

_SCHEMA = pa.schema([("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()), ("h", pa.int64()), ("a", pa.int64()),
                     ("starts", pa.int64()), ("before_low", pa.int64()), ("before_high", pa.int64()),
                     ("ends", pa.int64()), ("after_low", pa.int64()), ("after_high", pa.int64())])
_SPARK = "lang string, words int, phrase string, h long, a long, starts long, before_low long, before_high long, ends long, after_low long, after_high long"
#: A-Z in lower case, and one byte for all ends of pieces.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz.........")


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, slice by slice; b"." stands between pieces."""
    at = 0
    while at < len(text):
        cut = at + SLICE
        if cut < len(text):
            cut = text.rfind(b" ", at, cut) + 1 or text.find(b" ", cut) + 1 or len(text)
        part, at = text[at:cut].translate(_PLAIN), cut
        yield part.replace(b".", b" . ").split()


class _Words(dict):
    """Numbers of the frequent words of one language; 0 is the end of a piece or any other word."""

    def __init__(self, lang: str, frequent: Bits | None, all_words: list):
        super().__init__({b".": 0})
        self.lang, self.seed, self.frequent, self.all = lang, xxhash.xxh64_intdigest(lang.encode()), frequent, all_words

    def __missing__(self, word: bytes) -> int:
        number = 0
        if self.frequent is not None and self.frequent.has(h := xxhash.xxh64_intdigest(word, self.seed)):
            number = len(self.all)
            self.all.append((self.lang, word, h))
        self[word] = number
        return number


def _extend(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + word
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Bits:
    """A bit table of hashes: no false negatives, few false positives."""

    SHIFTS = (0, 32, 16)

    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, np.uint64(len(table) * 64 - 1)
        self.view: memoryview | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"view": None}

    @classmethod
    def of(cls, hashes: DataFrame, column: str = "h") -> Bits | None:
        """The table of a column of hashes, put together by Spark: at most MOST_BITS / 64 rows come to the driver."""
        rows = hashes.count()
        if not rows:
            return None
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (rows * PER_ENTRY).bit_length()))
        spots = F.array(*[F.shiftrightunsigned(column, s).bitwiseAND(bits - 1) for s in cls.SHIFTS])
        spot = F.col("spot")
        words = (hashes.select(F.explode(spots).alias("spot")).groupBy(F.shiftrightunsigned(spot, 6).alias("i"))
                 .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(63).cast("int"))).alias("b")).toArrow())
        table = np.zeros(bits // 64, np.uint64)
        table[words.column("i").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
        return cls(table)

    def holds(self, h: np.ndarray) -> np.ndarray:
        found, left = np.zeros(len(h), bool), None
        for s in self.SHIFTS:  # each probe looks only at what the ones before it let through
            spot = (h >> np.uint64(s)) & self.mask
            hit = np.flatnonzero((self.table[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1))
            left, h = hit if left is None else left[hit], h[hit]
        found[left] = True
        return found

    def has(self, h: int) -> bool:
        """The same for one hash, byte by byte."""
        if self.view is None:
            self.view, self.top = memoryview(self.table.astype("<u8", copy=False)).cast("B"), int(self.mask)
        view, top = self.view, self.top
        for s in self.SHIFTS:
            spot = (h >> s) & top
            if not view[spot >> 3] >> (spot & 7) & 1:
                return False
        return True


def _holds(bits: Bits | None, h: np.ndarray) -> np.ndarray:
    return np.zeros(len(h), bool) if bits is None else bits.holds(h)


def _rows(langs: pa.Array, m: int, phrases: pa.Array, h: np.ndarray, *counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([langs, pa.array(np.full(len(langs), m, np.int32)), phrases.cast(pa.string()), pa.array(h.view(np.int64)),
                                       *[pa.array(c.astype(np.int64)) for c in counts]], schema=_SCHEMA)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), utf8(b.column("text"))):
            if text:
                yield "und" if lang is None else lang, text


def count_words(texts: Iterator[tuple[str, bytes]]) -> Iterator[pa.RecordBatch]:
    """Words with their counts, and per language the empty phrase with the count of all words."""
    counts: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, count in counts.items():
            count.pop(b".", None)
            seed = xxhash.xxh64_intdigest(lang.encode())
            words = [*count, b""]
            n = np.array([*count.values(), sum(count.values())], np.int64)
            h = np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)
            zero = np.zeros(len(n), np.int64)
            langs, words = pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.array(words, pa.binary())
            yield from in_parts(_rows(langs[:-1], 1, words[:-1], h[:-1], n[:-1], *[zero[:-1]] * 6))
            yield _rows(langs[-1:], 0, words[-1:], h[-1:], n[-1:], *[zero[-1:]] * 6)
        counts.clear()

    for lang, text in texts:
        count = counts.setdefault(lang, Counter())
        for part in tokens(text):
            count.update(part)
            if sum(map(len, counts.values())) > REMEMBERED:
                yield from out()
                count = counts.setdefault(lang, Counter())
    yield from out()


class Encoder:
    """Texts as stretches of numbers of frequent words. All other words end a stretch's runs as a piece's end does:
    they occur too rarely to belong to a candidate, or to be the same word next to all occurrences of one."""

    def __init__(self, frequent: Bits | None, longest: int):
        self.frequent, self.longest = frequent, longest
        self.stream: list[np.ndarray] = [np.zeros(1, np.int32)]
        self.held = 1
        self.forget()

    def forget(self) -> None:
        self.words, self.of_lang = [("", b".", xxhash.xxh64_intdigest(b".", xxhash.xxh64_intdigest(b"")))], {}

    def add(self, lang: str, text: bytes) -> Iterator[pa.RecordBatch]:
        if lang not in self.of_lang:
            self.of_lang[lang] = _Words(lang, self.frequent, self.words)
        number = self.of_lang[lang].__getitem__
        for part in tokens(text):
            self.stream.append(np.fromiter(map(number, part), np.int32, len(part)))
            self.held += len(part)
            if self.held > FLUSH:
                yield from self.flush(False)
        self.stream.append(np.zeros(1, np.int32))
        self.held += 1
        if self.held > FLUSH or sum(map(len, self.of_lang.values())) > REMEMBERED:
            yield from self.flush(True)

    def flush(self, whole: bool) -> Iterator[pa.RecordBatch]:
        """A stretch whose phrases may start anywhere but in its first word and behind `upto`, where only what follows them stands."""
        ids = np.concatenate(self.stream)
        for _ in range(2):  # words alone between two ends go, then ends next to ends
            off = np.zeros(len(ids), bool)
            off[1:-1] = (ids[:-2] == 0) & (ids[2:] == 0) & (ids[1:-1] != 0)
            ids = ids[~off]
            keep = np.ones(len(ids), bool)
            keep[1:] = (ids[1:] != 0) | (ids[:-1] != 0)
            ids = ids[keep]
        upto = len(ids) if whole else len(ids) - self.longest - 1
        if upto > 1:
            met = np.zeros(len(self.words), bool)
            met[0] = met[ids] = True
            used = np.flatnonzero(met)
            words = [self.words[i] for i in used.tolist()]
            codes = (np.cumsum(met) - 1).astype(np.uint16 if len(used) <= 1 << 16 else np.uint32)[ids]
            hashes = np.fromiter((w[2] for w in words), np.uint64, len(words))
            yield pa.RecordBatch.from_arrays([pa.array([upto], pa.int32()), pa.array([[w[0] for w in words]]), pa.array([[w[1] for w in words]], pa.list_(pa.binary())),
                                              pa.array([codes.tobytes()], pa.binary()), pa.array([codes.itemsize], pa.int32()), pa.array([hashes.tobytes()], pa.binary())],
                                             names=["upto", "langs", "words", "ids", "width", "hashes"])
            ids = ids[upto - 1:]
        if whole:
            ids = ids[-1:]
            if sum(map(len, self.of_lang.values())) > REMEMBERED:
                self.forget()
        self.stream, self.held = [ids], len(ids)


_STRETCH = "upto int, langs array<string>, words array<binary>, ids binary, width int, hashes binary"


class Grower:
    """Counts the phrases of stretches that extend chosen prefixes or are themselves asked for.

    `walk` holds the prefixes to extend and the beginnings of all that is asked for: no other phrase leads to one to be counted.
    Left out, all phrases are looked at. `hashes` of a stretch are those of its words; left out, they are computed.
    """

    def __init__(self, grow: Bits | None, parts: Bits | None, longest: int, walk: Bits | None = None):
        self.grow, self.parts, self.longest, self.walk, self.seeds = grow, parts, longest, walk, {}

    def _chosen(self, upto: int, langs: Sequence[str], words: Sequence[bytes], ids: np.ndarray,
                hashes: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
        """Words and their hashes, then where the phrases of m words start that are to be counted, and their hashes."""
        if hashes is None:
            for lang in set(langs):
                self.seeds.setdefault(lang, xxhash.xxh64_intdigest(lang.encode()))
            hashes = np.array([xxhash.xxh64_intdigest(w, self.seeds[lang]) for lang, w in zip(langs, words)], np.uint64)
        ids = np.concatenate([ids.astype(np.int64), np.zeros(self.longest + 1, np.int64)])
        able, word = ids != 0, hashes[ids]
        at = 1 + np.flatnonzero(able[1:upto])
        h = word[at]
        for m in range(2, self.longest + 1):
            on = able[at + m - 1]
            at, h = at[on], h[on]
            if self.walk is not None:
                on = self.walk.holds(h)
                at, h = at[on], h[on]
            if not len(at):
                return
            grown = _holds(self.grow, h)
            h = _extend(h, word[at + m - 1])
            chosen = grown | _holds(self.parts, h)
            if chosen.any():
                yield ids, word, at[chosen], h[chosen], m

    def tally(self, *stretch) -> Iterator[pa.RecordBatch]:
        """How often each hash occurs: no phrase occurs more often than its hash."""
        hashes = [h for _, _, _, h, _ in self._chosen(*stretch)]
        if hashes:
            h, a = np.unique(np.concatenate(hashes), return_counts=True)
            yield from in_parts(pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(a.astype(np.int64))], names=["h", "a"]))

    def count(self, upto: int, langs: Sequence[str], words: Sequence[bytes], ids: np.ndarray, hashes: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        told = pa.array(langs, pa.string()), pa.array(words, pa.binary())
        for found in self._chosen(upto, langs, words, ids, hashes):
            yield from in_parts(self._phrases(*told, *found))

    @staticmethod
    def _phrases(langs: pa.Array, words: pa.Array, ids: np.ndarray, word: np.ndarray, at: np.ndarray, h: np.ndarray, m: int) -> pa.RecordBatch:
        # numbers of words have 21 bits at most, as have those of the groups of three
        code = ids[at]
        for j in range(1, m):
            if j == 3:
                code = np.unique(code, return_inverse=True)[1]
            code = (code << 21) | ids[at + j]
        order = np.argsort(code)
        code, at, h = code[order], at[order], h[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        before, after = ids[at - 1], ids[at + m]
        hash_before, hash_after = word[at - 1].view(np.int64), word[at + m].view(np.int64)
        told = [ids[at[first] + j] for j in range(m)]
        phrases = pc.binary_join_element_wise(*[words.take(pa.array(w)) for w in told], pa.scalar(b" "))
        return _rows(langs.take(pa.array(told[0])), m, phrases, h[first], np.diff(np.append(first, len(at))),
                     np.add.reduceat((before == 0).astype(np.int64), first), np.minimum.reduceat(hash_before, first), np.maximum.reduceat(hash_before, first),
                     np.add.reduceat((after == 0).astype(np.int64), first), np.minimum.reduceat(hash_after, first), np.maximum.reduceat(hash_after, first))


def _summed(rows: DataFrame, least: int) -> DataFrame:
    sums = rows.groupBy("lang", "phrase").agg(
        F.max("words").alias("words"), F.max("h").alias("h"), F.sum("a").alias("a"), F.sum("starts").alias("starts"),
        F.min("before_low").alias("before_low"), F.max("before_high").alias("before_high"), F.sum("ends").alias("ends"),
        F.min("after_low").alias("after_low"), F.max("after_high").alias("after_high"))
    return sums.where((F.col("a") >= least) | (F.col("words") == 0))


def _staged(df: DataFrame, name: str, rows: int = BATCH_ROWS, **options) -> DataFrame:
    with small_batches(df.sparkSession, rows):
        return stage(df, name, **options)


def _encoded(texts: DataFrame, frequent: Bits | None, longest: int) -> DataFrame:
    """The texts as stretches, written once: what later passes read."""
    sent = texts.sparkSession.sparkContext.broadcast(frequent)  # a table of MOST_BITS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value, longest)
        for lang, text in _texts(batches):
            yield from encoder.add(lang, text)
        yield from encoder.flush(True)

    out = _staged(texts.mapInArrow(run, _STRETCH), "phrase-stretches", **{"parquet.block.row.count.limit": STRETCHES})
    sent.destroy()
    return out


def _grown(stretches: DataFrame, longest: int, tables: Sequence[Bits | None], how: Callable, schema: str, done: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """One pass over the stretches with a method of Grower, written once."""
    sent = stretches.sparkSession.sparkContext.broadcast(tables)  # three tables of MOST_BITS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grow, parts, walk = sent.value
        grower = Grower(grow, parts, longest, walk)
        for b in batches:
            for i in range(b.num_rows):
                upto, ids, width, hashes = (b.column(c)[i].as_py() for c in ("upto", "ids", "width", "hashes"))
                langs, words = (b.column(c)[i].values for c in ("langs", "words"))
                yield from how(grower, upto, langs, words, np.frombuffer(ids, np.uint16 if width == 2 else np.uint32), np.frombuffer(hashes, np.uint64))

    out = _staged(done(stretches.mapInArrow(run, schema)), name, STRETCHES)
    sent.destroy()
    return out


def _counted(stretches: DataFrame, least: int, longest: int, grow: Bits | None, parts: Bits | None, walk: Bits | None, many: bool) -> DataFrame:
    """The phrases asked for that occur often enough, written out with their words and neighbours and counted by their words.

    Where there are many, most occur too rarely: then hashes and their counts alone are moved first, and only phrases whose hash
    occurs often enough are written out.
    """
    if not many:
        return _grown(stretches, longest, (grow, parts, walk), Grower.count, _SPARK, lambda rows: _summed(rows, least), "phrase-counts")
    often = _grown(stretches, longest, (grow, parts, walk), Grower.tally, "h long, a long",
                   lambda rows: rows.groupBy("h").agg(F.sum("a").alias("a")).where(F.col("a") >= least).select("h"), "phrase-hashes")
    return _grown(stretches, longest, (None, Bits.of(often), walk), Grower.count, _SPARK, lambda rows: _summed(rows, least), "phrase-counts")


#: floor(1000 * a * n / (l * r)) in whole decimals.
_SCORE = ("(cast({a} AS decimal(17,0)) * cast({n} AS decimal(17,0)) * cast(1000 AS decimal(4,0)))"
          " div (cast({l} AS decimal(18,0)) * cast({r} AS decimal(18,0)))")


def _score(a: str, n: str, l: str, r: str) -> Column:
    return F.expr(_SCORE.format(a=a, n=n, l=l, r=r))


def _judged(known: DataFrame, totals: DataFrame) -> DataFrame:
    """Each phrase with its lowest cut: score if all parts are counted (exact), else the most it can be; and the parts that lack a count."""
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = known.where("words > 1").select("lang", "phrase", "words", "a", cut)
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - words)")})
    count = known.where("words > 0").select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    cuts = cuts.join(count, ["lang", "left"], "left").join(count.withColumnsRenamed({"left": "right", "l": "r"}), ["lang", "right"], "left")
    cuts = cuts.join(totals, "lang").withColumn("score", _score("a", "n", "coalesce(l, a)", "coalesce(r, a)"))
    lacking = F.array_compact(F.array(F.when(F.col("l").isNull(), F.col("left")), F.when(F.col("r").isNull(), F.col("right"))))
    lowest = F.min(F.struct("score", "k", "l", "r"))
    return cuts.groupBy("lang", "phrase").agg(lowest.alias("b"), F.flatten(F.collect_list(lacking)).alias("lacking")).select(
        "lang", "phrase", "b.score", "b.l", "b.r", "lacking", (F.size("lacking") == 0).alias("exact"))


def _survives(longest: int) -> Column:
    """No longer candidate has the same count: the neighbours on neither side are always the same word."""
    same = lambda at_edge, side: (F.col(at_edge) == 0) & (F.col(f"{side}_low") == F.col(f"{side}_high"))
    return (F.col("words") == longest) | ~(same("starts", "before") | same("ends", "after"))


def mine(docs: DataFrame, longest: int = WORDS, least: int = LEAST, top: int = TOP, step: int = STEP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's `top` best phrases."""
    texts = docs.select("lang", "text")
    first = _staged(_summed(texts.mapInArrow(lambda batches: count_words(_texts(batches)), _SPARK), least), "phrase-words")
    totals = first.where("words = 0").select("lang", F.col("a").alias("n"))
    words = first.where((F.col("words") == 1) & (F.col("a") >= least))
    all_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known, grown = words, None
    stretches = _encoded(texts, Bits.of(words), longest)
    lead = words.select("lang", F.col("phrase").alias("lead"), F.col("a").alias("f"))
    reach = least
    ranked = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    while True:
        reach *= step
        judged = known.select("lang", "phrase", "a", _survives(longest).alias("survives")).join(_judged(known, totals), ["lang", "phrase"])
        judged = stage(judged.where("survives"), "phrase-judged")
        bar = judged.where("exact").withColumn("place", F.row_number().over(ranked)).where(F.col("place") == top).select("lang", F.col("score").alias("bar"))
        bar = stage(totals.join(bar, "lang", "left").select("lang", "n", F.coalesce("bar", F.lit(-1)).alias("bar")), "phrase-bar")
        # prefixes whose extensions can reach the bar, the best bounds first
        front = known.where((F.col("words") > 0) & (F.col("words") < longest)).select("lang", "phrase", "words", F.substring_index("phrase", " ", 1).alias("lead"))
        front = front if grown is None else front.join(grown, ["lang", "phrase"], "left_anti")
        front = front.join(lead, ["lang", "lead"]).join(bar, "lang").where(_score("1", "n", "f", "1") >= F.col("bar"))
        front = stage(front.select("lang", "phrase", "words", "f"), "phrase-front")
        lacking = judged.where("NOT exact").join(bar, "lang").where("score >= bar").select("lang", F.explode("lacking").alias("phrase")).distinct()
        lacking = _staged(_hashed(lacking), "phrase-lacking")
        if front.isEmpty() and lacking.isEmpty():
            break
        now = front.where((F.col("words") > 1) | (F.col("f") <= reach)).select("lang", "phrase")
        now = stage(now.join(known.select("lang", "phrase", "h", "a"), ["lang", "phrase"]), "phrase-now")
        extend, parts = Bits.of(now), Bits.of(lacking)
        if extend is None and parts is None:
            continue
        begun = now.select("lang", "phrase", F.lit(0).alias("less")).unionByName(lacking.select("lang", "phrase", F.lit(1).alias("less")))
        upto = F.size(F.split("phrase", " ")) - F.col("less")
        begun = begun.where(upto > 0).select("lang", "phrase", F.explode(F.sequence(F.lit(1), upto)).alias("k")).select("lang", F.expr("substring_index(phrase, ' ', k)").alias("phrase"))
        walk = Bits.of(_staged(_hashed(begun.distinct()), "phrase-walk"))
        starts = now.agg(F.coalesce(F.sum("a"), F.lit(0))).first()[0]
        more = _counted(stretches, least, longest, extend, parts, walk, starts * MANY > all_words)
        known = stage(known.unionByName(more).dropDuplicates(["lang", "phrase"]), "phrase-known")
        now = now.select("lang", "phrase")
        grown = now if grown is None else grown.unionByName(now)
    out = judged.where("exact").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top).join(totals, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _hashed(phrases: DataFrame) -> DataFrame:
    """The hash of each phrase, put together as the tasks do."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lang, phrase in zip(b.column("lang").to_pylist(), utf8(b.column("phrase"))):
                seed = xxhash.xxh64_intdigest(lang.encode())
                h, *rest = (np.array([xxhash.xxh64_intdigest(w, seed)], np.uint64) for w in phrase.split(b" "))
                out.append(reduce(_extend, rest, h))
            h = np.concatenate(out) if out else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("phrase"), pa.array(h.view(np.int64))], names=["lang", "phrase", "h"])
    return phrases.mapInArrow(run, "lang string, phrase string, h long")
