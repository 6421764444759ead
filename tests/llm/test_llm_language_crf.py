import zlib

import numpy as np
import pytest

from cohortwise.llm import language_crf as crf
from cohortwise.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark, small):
    return crf.train(crf.sample(spark.read.parquet(f"{small}/documents.parquet")))


def by_enumeration(model, words):
    """Marginals from the scores of all label sequences."""
    n, k = len(words), len(model.languages)
    e = [model.scores(w) for w in words]
    t = model.transitions
    total, out = 0.0, np.zeros((n, k))
    for code in range(k ** (n + 1)):
        labels = [code // k ** i % k for i in range(n + 1)]
        p = np.exp(sum(t[labels[i], labels[i + 1]] + e[i][labels[i + 1]] for i in range(n)))
        total += p
        for i in range(n):
            out[i, labels[i + 1]] += p
    return out / total


def in_log_space(model, words):
    low = lambda a: np.logaddexp.reduce(a, axis=0)
    e, t, n = [model.scores(w).astype(float) for w in words], model.transitions, len(words)
    alpha = [e[0] + low(t)]
    for i in range(1, n):
        alpha.append(e[i] + low(alpha[-1][:, None] + t))
    beta = [np.zeros(len(t))]
    for i in range(n - 1, 0, -1):
        beta.insert(0, low((t + e[i] + beta[0]).T))
    g = np.array(alpha) + np.array(beta)
    g = np.exp(g - g.max(axis=1, keepdims=True))
    return g / g.sum(axis=1, keepdims=True)


def test_marginals_equal_all_label_sequences(model):
    words = ["the", "ción", "und", "eau"]
    assert np.allclose(crf.Labeller(model).marginals([words])[0], by_enumeration(model, words), atol=1e-5)


def test_blocks_carry_messages_over_any_length(model):
    rng = np.random.default_rng(3)
    pool = ["the", "of", "ción", "und", "eau", "le", "que", "x", "thing", "schen", "ñ"]
    documents = [[pool[i] for i in rng.integers(0, len(pool), n)] for n in (1, 2, 31, 32, 33, 64, 65, 700, 5, 96)]
    got, sizes, _ = crf.Labeller(model).marginals(documents)
    assert np.allclose(got, np.concatenate([in_log_space(model, d) for d in documents]), atol=1e-4)
    means = crf.Labeller(model).means(documents)
    assert np.allclose(means, [in_log_space(model, d).mean(axis=0) for d in documents], atol=1e-4)


def test_gradient_pairs_are_expected_transitions():
    rng = np.random.default_rng(0)
    e, t = np.exp(rng.normal(size=(4, 1, 2))), np.exp(rng.normal(size=(2, 2)))
    gamma, pairs, _, z = crf._messages(e, t)
    total, want = 0.0, np.zeros((2, 2))
    for code in range(16):
        y = [code >> i & 1 for i in range(4)]
        p = e[0, 0, y[0]] * np.prod([t[y[i - 1], y[i]] * e[i, 0, y[i]] for i in range(1, 4)])
        total += p
        for i in range(1, 4):
            want[y[i - 1], y[i]] += p
    assert np.allclose(pairs, want / total) and np.isclose(z, np.log(total))


def test_code_switched_words(model, spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) > 600").collect()
    part = {x: crf.words_of(next(d.text for d in docs if d.lang == x))[:25] for x in ("en", "de", "es")}
    labels = crf.Labeller(model).marginals([part["en"] + part["de"] + part["es"]])[0].argmax(axis=1)
    want = [model.languages.index(x) for x in ("en", "de", "es") for _ in part[x]]
    assert np.mean(labels == want) > 0.9


def test_edges(spark, frame, model):
    rows = [(1, None), (2, ""), (3, "12 34 !!! ² ½"), (4, "the and of the"), (4, "the and of the"), (None, "the"), (6, "the thing of " * 20_000)]
    got = sorted(crf.predict(frame(rows).withColumnRenamed("source", "score"), model).collect(), key=lambda r: (r.doc_id or 0, r.text or ""))
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert len(got) == 7
    assert by[1] == by[2] == by[3] == ("und", 0.0)
    assert by[4][0] == by[6][0] == "en" and 0 <= by[4][1] <= 1


def test_nothing_to_learn(spark, frame):
    got = crf.identify(frame([(1, "some text", None), (2, None, "en")])).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in got} == {(1, "und", 0.0), (2, "und", 0.0)}
    assert crf.identify(frame([])).collect() == []
    assert [r.doc_id for r in crf.keep(frame([(1, "some text", None), (2, "...")]), 0.5).collect()] == [1]


def test_one_language(frame):
    got = crf.identify(frame([(i, "a few words of text", "en") for i in range(20)])).collect()
    assert {r.lang_pred for r in got} == {"en"}


def test_held_out_accuracy(spark, small):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op2_crf_language"](spark, small).collect()
    assert {r.doc_id for r in got} == set(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.held_out]) > 0.97


def test_words_with_their_languages(spark, frame, model):
    got = crf.label_words(frame([(1, "the of und"), (2, None)]), model).orderBy("doc_id").collect()
    assert [w.word for w in got[0].words] == ["the", "of", "und"] and got[1].words == []


def test_a_word_has_all_its_trigrams():
    word = "abcdefghijklmnopqrstuvwxyz" + "nopqrstuvwxyzabcd"
    marked = f"^{word}$"
    assert {f[1:] for f in crf.features_of(word, {}) if f[:1] == "g"} == {marked[k:k + 3] for k in range(len(word))} and len(word) == 43


def test_slices_of_a_long_document_give_the_marginals_of_the_whole(model):
    rng = np.random.default_rng(5)
    pool = ["the", "of", "ción", "und", "eau", "le", "que", "x", "schen"]
    for size in (1, 63, 64, 65, 300):
        words = [pool[i] for i in rng.integers(0, len(pool), size)]
        labeller = crf.Labeller(model)
        labeller.slice = 64
        got = np.concatenate([*labeller.long_marginals(words)][::-1])
        assert np.allclose(got, in_log_space(model, words), atol=1e-4)
        assert np.allclose(labeller.long_mean(words), in_log_space(model, words).mean(axis=0), atol=1e-4)


def test_judgement_by_slices_is_that_of_whole_texts(model):
    texts = ["the of the thing " * 90, "und schen", None, "le que eau " * 40, "x"] * 3
    whole, sliced = crf.Labeller(model), crf.Labeller(model)
    sliced.slice = 64
    (names, scores), (same, near) = crf._judge(texts, whole), crf._judge(texts, sliced)
    assert names == same and np.allclose(scores, near, atol=1e-4)


def test_more_languages_than_there_are_letters(frame):
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    names = [f"l{i:02}" for i in range(40)]
    own = lambda i: [a + alphabet[i % 26] + b + alphabet[(i * 7 + i // 26) % 26] for a in alphabet[:6] for b in alphabet[10:16]]
    docs = frame([(i * 10 + k, " ".join(own(i) * 3), names[i]) for i in range(40) for k in range(5)])
    got = crf.identify(docs).collect()
    assert len(got) == 200 and np.mean([r.lang_pred == names[r.doc_id // 10] for r in got]) > 0.97
    assert crf.words_each(4) == crf.SAMPLE_WORDS and crf.words_each(200) * 200 * 200 <= crf.CELLS
