"""Language of each word, and so of each document, by a linear-chain conditional random field.

A document is the chain of its words (runs of letters, lower-cased). A word's own features are its first and last one to three letters, its
letter trigrams with the word's ends, its lexicon entries (is it among the words typical of a language) and a constant; their
weights give a score for each language. Transition weights between the languages of neighbours are learned with them, by
maximum likelihood with forward-backward. Training chains join spans of several documents, because a corpus labels whole
documents and the field has to label code-switched text; SWITCH is the chance that the next span's language is drawn anew.

Labels of words are the posterior marginals of forward-backward over the whole document, exact for any length: the chain is cut
into blocks, the product of each block's transfer matrices carries the messages from block to block, and all blocks of many
documents are worked through at once. Chains longer than a slice are worked through slice by slice: once forward for the messages at
the cuts, then backward for the marginals, so memory is bounded for any length. A document's language is that with the largest mean
marginal, which is its score.

Learning uses a bounded sample: of each language the SAMPLE documents with the smallest hash of their id, of the rows that may be
learned from (see common.held_out) and have a language, and SAMPLE_WORDS words of them. Every language that occurs is learned; with
many, each gives fewer words, so that words times languages, over all languages, stay within CELLS (CHAIN words each at least). Every feature that two words of the
sample share has weights, and a word has all its trigrams. Only text and language are used.

Defined results: a missing text or one without letters is `und` with score 0. Nothing to learn from: every document is `und`
with score 0. Missing languages are not learned. Repeated rows are judged alike. Equal means: the first language in the alphabet.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.llm.common import held_out

#: Bounds of the sample: documents and words per language, words times languages over all languages.
SAMPLE, SAMPLE_WORDS, CELLS = 120, 60_000, 60_000_000
#: Languages up to which the ids of the sample are broadcast; those of more are joined by a shuffle.
SENT = 4096
SPAN, CHAIN, SWITCH = 16, 128, 0.5
EPOCHS, RATE, DECAY = 30, 0.15, 1e-3
UNKNOWN = "und"
#: Words whose scores one Python worker remembers; words worked through at a time; words of a block. With many languages fewer words
#: are remembered and worked through, so that scores and block products hold at most SCORES and PRODUCTS numbers.
REMEMBERED, SLICE, BLOCK = 1 << 19, 1 << 18, 32
SCORES, PRODUCTS = 1 << 24, 1 << 23

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def features_of(word: str, lexicon: dict[str, list[str]]) -> list[str]:
    marked = f"^{word}$"
    return ["", *(f"p{word[:k]}" for k in (1, 2, 3)), *(f"s{word[-k:]}" for k in (1, 2, 3)),
            *(f"g{marked[k:k + 3]}" for k in range(len(marked) - 2)), *(f"l{x}" for x in lexicon.get(word, ()))]


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, list[str]]
    index: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    @property
    def key(self) -> str:
        return hashlib.sha1(self.weights.tobytes() + self.transitions.tobytes() + repr((self.languages, list(self.index), sorted(self.lexicon))).encode()).hexdigest()

    def scores(self, word: str) -> np.ndarray:
        known = [k for f in features_of(word, self.lexicon) if (k := self.index.get(f)) is not None]
        return self.weights[known].sum(axis=0)


def _messages(e: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Forward-backward over chains of one length: marginals, pair marginals summed, and the log-likelihood's normaliser.

    e: (length, chains, languages) exponentiated scores, t: exponentiated transitions.
    """
    length, chains, k = e.shape
    alpha, scale = np.empty_like(e), np.empty((length, chains, 1))
    for i in range(length):
        a = e[i] if i == 0 else (alpha[i - 1] @ t) * e[i]
        scale[i] = a.sum(axis=1, keepdims=True)
        alpha[i] = a / scale[i]
    beta, pairs, gamma = np.ones((chains, k)), np.zeros((k, k)), np.empty_like(e)
    for i in range(length - 1, -1, -1):
        gamma[i] = alpha[i] * beta
        if i:
            weighted = e[i] * beta / scale[i]
            pairs += (alpha[i - 1].T @ weighted) * t
            beta = weighted @ t.T
    return gamma, pairs, scale, float(np.log(scale).sum())


def words_each(languages: int) -> int:
    """Words that each of a number of languages gives to the sample."""
    return min(SAMPLE_WORDS, max(CHAIN, CELLS // max(1, languages) ** 2))


def train(samples: list[tuple[str, str]], seed: int = 7) -> Model | None:
    """Fit the field to (language, text) samples."""
    texts: dict[str, list[list[str]]] = {}
    most = words_each(len({language for language, _ in samples}))
    for language, text in sorted(samples):
        held = texts.setdefault(language, [])
        if (left := most - sum(map(len, held))) > 0 and (words := words_of(text)[:left]):
            held.append(words)
    texts = {k: v for k, v in texts.items() if v}
    if not texts:
        return None
    languages = sorted(texts)
    n = len(languages)

    counts = {k: Counter(w for ws in texts[k] for w in ws) for k in languages}
    whole = sum(counts.values(), Counter())
    lexicon: dict[str, list[str]] = {}
    for language, own in counts.items():
        typical = [w for w, c in own.items() if c >= 3 and c >= 0.6 * whole[w]]
        for w in sorted(typical):
            lexicon.setdefault(w, []).append(language)

    rng = np.random.default_rng(seed)
    spans = [(k, ws[i:i + SPAN]) for k, language in enumerate(languages) for ws in texts[language] for i in range(0, len(ws), SPAN)]
    chains, order = [], rng.permutation(len(spans))
    by_language = [[i for i in order if spans[i][0] == k] for k in range(n)]
    current, place, used = 0, [0] * n, 0
    words, labels = [], []
    total = sum(len(s[1]) for s in spans)
    while used < total:
        if rng.random() < SWITCH or not by_language[current]:
            current = int(rng.integers(n))
        pool = by_language[current]
        k, ws = spans[pool[place[current] % len(pool)]]
        place[current] += 1
        cut = int(rng.integers(3, SPAN + 1))
        words += ws[:cut]
        labels += [k] * len(ws[:cut])
        used += len(ws)
        while len(words) >= CHAIN:
            chains.append((words[:CHAIN], labels[:CHAIN]))
            words, labels = words[CHAIN:], labels[CHAIN:]
    if not chains:
        repeat = -(-CHAIN // max(1, len(words)))
        chains.append(((words * repeat)[:CHAIN], (labels * repeat)[:CHAIN]))

    distinct = {w: i for i, w in enumerate(dict.fromkeys(w for ws, _ in chains for w in ws))}
    met = Counter(f for w in distinct for f in features_of(w, lexicon))
    kept = [f for f, c in sorted(met.items(), key=lambda x: (-x[1], x[0])) if c >= 2 or len(distinct) < 1000]
    index = {f: i for i, f in enumerate(kept)}
    rows, columns = [], []
    for w, i in distinct.items():
        for f in features_of(w, lexicon):
            if f in index:
                rows.append(i)
                columns.append(index[f])
    rows, columns = np.array(rows), np.array(columns)
    x = np.array([[distinct[w] for w in ws] for ws, _ in chains]).T
    y = np.array([ls for _, ls in chains]).T

    def gather(values: np.ndarray, frm: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
        return np.stack([np.bincount(to, values[frm, k], size) for k in range(n)], axis=1)

    weights, transitions = np.zeros((len(index), n)), np.zeros((n, n))
    true_pairs = np.zeros((n, n))
    np.add.at(true_pairs, (y[:-1].ravel(), y[1:].ravel()), 1)
    truth = np.zeros((len(distinct), n))
    np.add.at(truth, (x.ravel(), y.ravel()), 1)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(transitions), np.zeros_like(transitions)]
    for step in range(1, EPOCHS + 1):
        per_word = gather(weights, columns, rows, len(distinct))
        e = np.exp(per_word - per_word.max(axis=1, keepdims=True))[x]
        gamma, pairs, _, _ = _messages(e, np.exp(transitions))
        gamma /= gamma.sum(axis=2, keepdims=True)
        expected = np.stack([np.bincount(x.ravel(), gamma[:, :, k].ravel(), len(distinct)) for k in range(n)], axis=1)
        slope_w = gather(truth - expected, rows, columns, len(index)) / x.size - DECAY * weights / len(index) ** 0.5
        slope_t = (true_pairs - pairs) / x.size - DECAY * transitions
        for value, slope, a, b in ((weights, slope_w, moments[0], moments[1]), (transitions, slope_t, moments[2], moments[3])):
            a += 0.1 * (slope - a)
            b += 0.01 * (slope ** 2 - b)
            value += RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-9)
    return Model(languages, lexicon, index, weights.astype(np.float32), transitions)


def sample(docs: DataFrame, per_language: int = SAMPLE) -> list[tuple[str, str]]:
    """(language, text) of a bounded number of documents per language; ids are chosen first, texts are fetched for these alone."""
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (usable.select("doc_id", "lang").withColumn("rank", F.row_number().over(order))
              .where(F.col("rank") <= per_language).select("doc_id", "lang").distinct())
    languages = usable.select("lang").distinct().count()
    ids = F.broadcast(chosen) if languages <= SENT else chosen  # per_language ids of each
    most = words_each(languages)
    got = usable.join(ids, ["doc_id", "lang"], "left_semi")
    got = got.withColumn("text", F.substring("text", 1, 8 * most)).dropDuplicates(["doc_id", "lang"])
    return [(r["lang"], r["text"]) for r in got.select("lang", "text").collect()]


class Labeller:
    """Marginals of whole documents under a model."""

    def __init__(self, model: Model):
        self.model, self.n = model, len(model.languages)
        t = np.exp(model.transitions - model.transitions.max())
        self.t = t.astype(np.float32)
        self.remembered, self.slice = min(REMEMBERED, SCORES // self.n), max(BLOCK, min(SLICE, PRODUCTS // self.n ** 2 * BLOCK))
        self.known: dict[str, int] = {}
        self.table = np.empty((1024, self.n), np.float32)

    def _rows(self, documents: list[list[str]]) -> np.ndarray:
        new = {w for words in documents for w in words if w not in self.known}
        if len(self.known) + len(new) > self.remembered:
            self.known.clear()
            new = {w for words in documents for w in words}
        need = len(self.known) + len(new)
        if need > len(self.table):
            self.table = np.concatenate([self.table, np.empty((max(need, 2 * len(self.table)) - len(self.table), self.n), np.float32)])
        if new:
            self._learn(list(new))
        get = self.known.__getitem__
        return np.array([get(w) for words in documents for w in words], np.int64)

    def _learn(self, words: list[str]) -> None:
        """Score words together: the weights of all their features, summed word by word. Each word has the constant feature, if no other."""
        index, lexicon, weights = self.model.index.get, self.model.lexicon, self.model.weights
        first, parts = len(self.known), []
        for w in words:
            found = [k for f in features_of(w, lexicon) if (k := index(f)) is not None]
            parts.append(found or [-1])
        weights = np.concatenate([weights, np.zeros((1, self.n), np.float32)])
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
        s = np.add.reduceat(weights[np.array([k for p in parts for k in p])], starts, axis=0)
        self.table[first:first + len(words)] = np.exp(s - s.max(axis=1, keepdims=True))
        self.known.update(zip(words, range(first, first + len(words))))

    def means(self, documents: list[list[str]]) -> np.ndarray:
        """Mean marginal of each language in each document; no document may be empty."""
        marginals, sizes, _ = self.marginals(documents)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.add.reduceat(marginals, starts, axis=0, dtype=np.float64) / sizes[:, None]

    def long_marginals(self, words: list[str]) -> Iterator[np.ndarray]:
        """Marginals of one document of any length, slice by slice from its end."""
        parts = [words[at:at + self.slice] for at in range(0, len(words), self.slice)]
        ahead = [np.ones(self.n, np.float32)]
        for part in parts[:-1]:
            e = self.table[self._rows([part])]
            v = ahead[-1]
            for row in e:
                v = (v @ self.t) * row
                v /= v.sum()
            ahead.append(v)
        behind = np.ones(self.n, np.float32)
        for part, v in zip(reversed(parts), reversed(ahead)):
            out, _, behind = self.marginals([part], v, behind)
            yield out

    def long_mean(self, words: list[str]) -> np.ndarray:
        return sum(part.sum(axis=0, dtype=np.float64) for part in self.long_marginals(words)) / len(words)

    def marginals(self, documents: list[list[str]], before: np.ndarray | None = None,
                  after: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A row of marginals for each word, documents one after the other, the documents' numbers of words, and the message from the first
        document's first word backward. `before` and `after` are the messages that reach the first and the last word of a single document."""
        n, t = self.n, self.t
        sizes = np.array([len(d) for d in documents])
        blocks = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        total = int(first[-1])
        start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        doc_of = np.repeat(np.arange(len(sizes)), blocks)
        inside = np.arange(total) - first[doc_of]
        at = start[doc_of] + inside * BLOCK
        left = np.minimum(BLOCK, sizes[doc_of] - inside * BLOCK)
        valid = np.arange(BLOCK)[:, None] < left[None, :]
        place = np.where(valid, at[None, :] + np.arange(BLOCK)[:, None], 0)
        rows = self._rows(documents)
        e = self.table[rows][place]

        product = np.broadcast_to(np.eye(n, dtype=np.float32), (total, n, n)).copy()
        for i in range(BLOCK):
            step = (product.reshape(-1, n) @ t).reshape(total, n, n) * e[i][:, None, :]
            product = np.where(valid[i][:, None, None], step, product)
            if i % 4 == 3:
                product /= product.max(axis=(1, 2), keepdims=True)

        ahead, behind = np.ones((total, n), np.float32), np.ones((total, n), np.float32)
        if before is not None:
            ahead[0], behind[-1] = before, after
        order = np.argsort(-blocks, kind="stable")
        ranked = blocks[order]
        for b in range(1, int(ranked[0])):
            now = first[order[:np.searchsorted(-ranked, -b, side="left")]] + b
            v = np.matmul(ahead[now - 1][:, None, :], product[now - 1])[:, 0, :]
            ahead[now] = v / v.sum(axis=1, keepdims=True)
        for b in range(1, int(ranked[0])):
            now = first[order[:np.searchsorted(-ranked, -b, side="left")] + 1] - 1 - b
            v = np.matmul(product[now + 1], behind[now + 1][:, :, None])[:, :, 0]
            behind[now] = v / v.sum(axis=1, keepdims=True)

        alpha = np.empty((BLOCK, total, n), np.float32)
        a = ahead
        for i in range(BLOCK):
            step = (a @ t) * e[i]
            a = np.where(valid[i][:, None], step / step.sum(axis=1, keepdims=True), a)
            alpha[i] = a
        out = np.empty((int(sizes.sum()), n), np.float32)
        b = behind
        for i in range(BLOCK - 1, -1, -1):
            g = alpha[i] * b
            g /= g.sum(axis=1, keepdims=True)
            out[place[i][valid[i]]] = g[valid[i]]
            step = (e[i] * b) @ t.T
            b = np.where(valid[i][:, None], step / step.sum(axis=1, keepdims=True), b)
        return out, sizes, b[0]


_LABELLERS: dict[str, Labeller] = {}


def _labeller(model: Model | None, key: str | None) -> Labeller | None:
    """The worker's labeller of a model; words that an earlier task has scored are still known."""
    if model is None:
        return None
    if key not in _LABELLERS:
        _LABELLERS.clear()
        _LABELLERS[key] = Labeller(model)
    return _LABELLERS[key]


def _judge(texts: list[str | None], labeller: Labeller | None) -> tuple[list[str], list[float]]:
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if labeller is None:
        return names, scores
    held, size = [], 0

    def decide(k: int, mean: np.ndarray):
        best = int(mean.argmax())
        names[k], scores[k] = labeller.model.languages[best], min(1.0, float(mean[best]))

    def flush():
        for (k, _), mean in zip(held, labeller.means([words for _, words in held])):
            decide(k, mean)

    for k, text in enumerate(texts):
        words = words_of(text)
        if not words or not has_letter(words):
            continue
        if len(words) > labeller.slice:
            decide(k, labeller.long_mean(words))
            continue
        if size + len(words) > labeller.slice:
            flush()
            held, size = [], 0
        held.append((k, words))
        size += len(words)
    if held:
        flush()
    return names, scores


def predict(docs: DataFrame, model: Model | None, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of docs, the predicted language and its score."""
    kept = [f for f in docs.schema if f.name not in (lang, score)]
    key = model.key if model is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller(model, key)
        for b in batches:
            names, scores = _judge(b.column(text).to_pylist(), labeller)
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*[f.name for f in kept], lang, score])
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]))


def label_words(docs: DataFrame, model: Model, text: str = "text", into: str = "words") -> DataFrame:
    """All columns of docs and, in order, each word with its language and marginal."""
    kept = [f for f in docs.schema if f.name != into]
    one = T.StructType([T.StructField("word", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("p", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model)
        for b in batches:
            out = []
            for value in b.column(text).to_pylist():
                words = words_of(value)
                rows = np.concatenate([*labeller.long_marginals(words)][::-1]) if words else []
                out.append([{"word": w, "lang": model.languages[int(r.argmax())], "p": float(r.max())} for w, r in zip(words, rows)])
            kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("p", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(out, kind)], names=[*[f.name for f in kept], into])
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(into, T.ArrayType(one))]))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document, by a field learned from the documents that may be learned from."""
    model = train(sample(docs))
    rows = predict(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep(docs: DataFrame, least_score: float) -> DataFrame:
    """The documents with letters whose language has at least the given score, with their own columns; all of them where nothing could be learned."""
    model = train(sample(docs))
    if model is None:
        return docs.where(F.rlike(F.coalesce("text", F.lit("")), F.lit("\\p{L}")))
    rows = predict(docs, model, lang="_crf_lang", score="_crf_score")
    return rows.where((F.col("_crf_lang") != UNKNOWN) & (F.col("_crf_score") >= least_score)).drop("_crf_lang", "_crf_score")
