import random

import numpy as np
from pyspark.sql import functions as F

from cohortwise.llm import collocations


def texts(rng):
    rows = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(400)), "en") for i in range(40)]
    return rows + [(100 + i, "Alpha beta gamma. delta\x0bepsilon", None) for i in range(30)]


def test_rare_phrases_are_not_moved_with_their_words(spark, monkeypatch):
    """Only phrases whose hash occurs often enough are written out with words and neighbours."""
    written, summed = [], collocations._summed

    def noted(rows, least):
        written.append(rows.where("words > 1").select("lang", "phrase").distinct().count())
        return summed(rows, least)

    monkeypatch.setattr(collocations, "_summed", noted)
    df = spark.createDataFrame(texts(random.Random(5)), "doc_id long, text string, lang string")
    out = collocations.mine(df, least=12).collect()
    frequent = {(r.lang, r.phrase) for r in out}
    assert ("und", "alpha beta gamma") in frequent and ("und", "delta epsilon") not in frequent
    # some 3,600 different pairs occur, far fewer 12 times
    assert 0 < max(written) < 1000


def test_bit_table_answers_alike_for_one_hash_and_for_many():
    rng = np.random.default_rng(1)
    bits = collocations.Bits(rng.integers(0, 1 << 63, 64, dtype=np.uint64))
    h = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    many = bits.holds(h)
    assert many.any() and not many.all()
    assert many.tolist() == [bits.has(int(x)) for x in h]


def test_only_beginnings_of_what_is_counted_are_walked(spark):
    """A part of three words is found though its first two words are not asked for."""
    df = spark.createDataFrame([("en", "a b c")], "lang string, phrase string")
    hashes = {p: collocations._hashed(df.select("lang", F.lit(p).alias("phrase"))) for p in ("a", "a b", "a b c")}
    walk, part = collocations.Bits.of(hashes["a"].union(hashes["a b"]).select("h")), collocations.Bits.of(hashes["a b c"].select("h"))
    stretch = (6, ["", "en", "en", "en"], [b".", b"a", b"b", b"c"], np.array([0, 1, 2, 3, 1, 0], np.uint16))
    found = [r for b in collocations.Grower(None, part, 5, walk).count(*stretch) for r in b.column("phrase").to_pylist()]
    assert found == ["a b c"]
    short = collocations.Bits.of(hashes["a"].select("h"))
    assert not list(collocations.Grower(None, part, 5, short).count(*stretch))
