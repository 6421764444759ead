import random
import re
from collections import Counter, defaultdict

import numpy as np

from cohortwise.llm import collocations


def brute(rows, longest=5, least=100, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for j in range(i + 1, min(i + longest, len(words)) + 1):
                    f[lang, tuple(words[i:j])] += 1
    candidates = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    dropped = set()
    for (lang, words), a in candidates.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                part = lang, words[i:j]
                if j - i < len(words) and 100 * a >= 100 * f[part]:
                    dropped.add(part)
    out = defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in dropped:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1))


def found(df, **how):
    return sorted(tuple(r) for r in collocations.mine(df, **how).collect())


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.lang, r.text) for r in df.select("lang", "text").collect()]
    assert found(df) == brute(rows)


def made(rng, words, docs):
    names = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    fixed = [rng.choices(names, weights, k=rng.randint(3, 9)) for _ in range(12)]
    rows = []
    for i in range(docs):
        text = []
        for _ in range(rng.randint(1, 12)):
            text += rng.choice(fixed) if rng.random() < 0.4 else rng.choices(names, weights, k=rng.randint(1, 8))
            text.append(rng.choice([".", ",", "\n", "\t", "", ";"]))
        rows.append((i, " ".join(text).replace("w1 ", "W1  "), rng.choice(["en", "fr", None])))
    return rows


def test_bounds_cut_growth_and_keep_ties(spark, frame, monkeypatch):
    """Few wanted phrases: frequent first words are never extended, and what comes back is the same."""
    rows = made(random.Random(11), 80, 400)
    df, asked = frame(rows).repartition(3), []
    of = collocations.Bits.of.__func__

    def counting(cls, hashes, column="h"):
        asked.append(hashes.columns and hashes.count())
        return of(cls, hashes, column)
    monkeypatch.setattr(collocations.Bits, "of", classmethod(counting))
    pairs = [(r[2], r[1]) for r in rows]
    assert found(df, least=5, top=3, step=6) == brute(pairs, least=5, top=3)
    few = sum(asked)
    asked.clear()
    assert found(df, least=5, top=10_000, step=6) == brute(pairs, least=5, top=10_000)
    assert few < sum(asked)


def test_long_texts_in_small_slices(spark, frame, monkeypatch):
    monkeypatch.setattr(collocations, "FLUSH", 50)
    monkeypatch.setattr(collocations, "SLICE", 37)
    monkeypatch.setattr(collocations, "REMEMBERED", 40)
    rows = made(random.Random(7), 30, 40)
    rows += [(1000, "alpha beta gamma delta epsilon " * 300, "en"), (1001, "x" * 5000 + " alpha beta", "en")]
    pairs = [(r[2], r[1]) for r in rows]
    counts = Counter()
    for b in collocations.count_words(("und" if lang is None else lang, text.encode()) for lang, text in pairs):
        for r in b.to_pylist():
            counts[r["lang"], r["phrase"]] += r["a"]
    assert counts["en", "alpha"] == 301 and counts["en", "x" * 5000] == 1
    got = brute(pairs, least=8)
    assert found(frame(rows), least=8) == got and got


def test_stretches_join_over_flushes(monkeypatch):
    """A long piece counted in stretches has the neighbours and counts of the whole."""
    monkeypatch.setattr(collocations, "SLICE", 40)
    text = (b"a b c d e f g " * 200).strip()
    every = collocations.Bits(~np.zeros(64, np.uint64))

    def counted(flush):
        monkeypatch.setattr(collocations, "FLUSH", flush)
        encoder, grower, out = collocations.Encoder(every, 5), collocations.Grower(every, None, 5), {}
        for row in [*encoder.add("en", text), *encoder.flush(True)]:
            r = {k: v[0] for k, v in row.to_pydict().items()}
            for b in grower.count(r["upto"], r["langs"], r["words"], np.frombuffer(r["ids"], np.uint16)):
                for g in b.to_pylist():
                    old = out.get(g["phrase"], (0, 0, 0))
                    out[g["phrase"]] = (old[0] + g["a"], old[1] + g["starts"], old[2] + g["ends"])
        return out
    assert counted(20) == counted(10 ** 6)


def test_odd_rows(spark, frame):
    rows = [(1, None, "en"), (2, "", "en"), (None, "a b", None), (3, "a b. a b, a b", "en"), (3, "a b. a b, a b", "en"), (4, "...", "en"), (5, "  \x00   \x00", "xx")]
    pairs = [(r[2], r[1]) for r in rows]
    assert found(frame(rows), least=1) == brute(pairs, least=1)
    assert found(frame([])) == []
    clash = frame(rows).withColumnRenamed("source", "phrase").withColumnRenamed("n_chars", "a")
    assert found(clash, least=1) == brute(pairs, least=1)
