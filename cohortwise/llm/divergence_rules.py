"""Quality rules on counts and on the divergence from language references, in DataFrame functions only.

Base rules look at the number of words and the share of words in repeated windows. The method's rule compares a document's histograms of character
classes and of common words with those of each reference language by the Jensen-Shannon distance, the root of the divergence to base 2; the language
with the smallest sum of both counts. Documents with fewer words than a histogram's guard pass it: short texts lie far from any reference by chance.

References are the summed histograms of all documents of a language that pass the base rules: one aggregate, one row of fixed length for each
language. Every document is held to those of LANGUAGES, whose common words are known. A document that is labelled with another language is held to
that language's own reference as well, and only by its characters: of such a language no words are known, so that clean texts hold few of them.
Everything about a document is computed inside its row; own references are joined on the language, and only where there are any.

Defined results: a missing text has no words, and fails. A language without documents is no reference; without any reference the method keeps.
Missing languages teach nothing, and documents without a label are held to LANGUAGES. Repeated rows are judged alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import stage

LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Least words for the histogram of characters, and for that of common words.
GUARD_WORDS, GUARD_COMMON = 50, 100
#: Largest distances to the nearest reference: running text lies below 0.28, text of symbols or without function words above 0.3.
MOST_CHARACTERS, MOST_COMMON = 0.30, 0.295
LANGUAGES = ("en", "fr", "de", "es")

# Common words.
COMMON = {
    "en": "the of and to in is that it for was".split(),
    "fr": "de la le et les des un que est pour".split(),
    "de": "der die und den von zu das mit ist nicht".split(),
    "es": "de la el que en y los las por con".split(),
}
_COMMON = list(dict.fromkeys(w for ws in COMMON.values() for w in ws))
CLASSES = ("lower", "upper", "digit", "space", "beyond_ascii", "punctuation", "symbol")
BINS = len(_COMMON) + 1

_SPACE = "[ \\t-\\r]+"


def _strip(column: Column, pattern: str) -> Column:
    return F.regexp_replace(column, pattern, "")


def _named(tag: str) -> str:
    return f"_dr_{tag}"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def _repeated_words(words: Column, window: int) -> Column:
    """Words in windows of `window` words that occur twice or more in the list.

    Windows are compared by 64-bit hashes of their words' hashes. Places of repeated windows are the neighbours of equal hash in
    sorted order; sorted by place again, each adds the words that the one before does not cover.
    """
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    at = lambda h, i: F.xxhash64(*[F.get(h, i + k) for k in range(window)])
    windows = _let(hashes, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: at(h, i)))

    def covered(v: Column) -> Column:
        placed = F.sort_array(F.transform(v, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))  # get() gives null beyond either end
        repeats = lambda s: F.sort_array(F.transform(F.filter(s, lambda x, k: same(s, k - 1, x) | same(s, k + 1, x)), lambda x: x["i"]))
        spread = lambda p: F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-window).alias("before")),
                                       lambda a, i: F.struct((a["n"] + F.least(F.lit(window), i - a["before"])).alias("n"), i.alias("before")), lambda a: a["n"])
        return _let(_let(placed, repeats), spread)

    return F.when(F.size(words) <= window, 0).otherwise(
        _let(windows, lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), 0).otherwise(covered(v))))


def _let(value: Column, use) -> Column:
    """Compute a value once and use it several times inside one expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def describe(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, characters and words (histograms) in columns _dr_*."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit("[^ \\t-\\r]")))
    dup_lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    spelled = [v for w in _COMMON for v in (w, w.capitalize())]

    def of_rest(rest: Column, space: Column) -> Column:
        return _let(_strip(rest, "[A-Z]+"), lambda left: _let(
            F.struct(F.regexp_count(left, F.lit("[0-9]")).alias("digits"), F.length(_strip(left, "[\\x00-\\x7F]+")).alias("beyond"),
                     F.regexp_count(left, F.lit("[#*$%&|<>]")).alias("symbols")),
            lambda n: F.array(F.length(t) - space - F.length(rest), F.length(rest) - F.length(left), n["digits"], space, n["beyond"],
                              F.length(left) - n["digits"] - n["beyond"] - n["symbols"], n["symbols"])))

    def of_words(words: Column) -> Column:
        places = F.transform(F.filter(words, lambda w: w.isin(spelled)), lambda w: F.array_position(F.array(*map(F.lit, _COMMON)), F.lower(w)).cast("int"))
        common = _let(places, lambda p: F.concat(F.array(*[F.size(p) - F.size(F.array_remove(p, k + 1)) for k in range(len(_COMMON))]), F.array(F.size(words) - F.size(p))))
        chars = F.length(F.array_join(words, ""))
        characters = _let(chars, lambda n: F.struct(n.alias("n"), _let(_strip(t, "[a-z \\t-\\r]+"), lambda rest: of_rest(rest, F.length(t) - n)).alias("by_class")))
        return F.struct(F.size(words).cast("long").alias("n_words"), _repeated_words(words, WINDOW).cast("long").alias("n_repeat_words"),
                        characters.alias("characters"), common.alias("words"))

    rows = _pinned(docs, _let(words_of(t), of_words), _named("d"))
    d = F.col(_named("d"))
    return rows.withColumns({
        _named("n_words"): d["n_words"], _named("word_chars"): d["characters"]["n"].cast("long"), _named("n_symbols"): F.get(d["characters"]["by_class"], F.lit(6)).cast("long"),
        _named("n_dup_lines"): dup_lines.cast("long"), _named("n_repeat_words"): d["n_repeat_words"],
        _named("characters"): d["characters"]["by_class"], _named("words"): d["words"]}).drop(_named("d"))


def _base_failed() -> Column:
    n, repeated = F.col(_named("n_words")), F.col(_named("n_repeat_words"))
    return (n < LEAST_WORDS) | (repeated * 100 > n * MOST_REPEATED)


def references(described: DataFrame, lang: str = "lang") -> tuple[dict[str, tuple[list[float], list[float]]], DataFrame | None]:
    """Shares of character classes and of common words in the documents of each language that pass the base rules.

    Those of LANGUAGES by name; those of all other languages as a table (_dr_lang and _dr_own, a struct), None if there are none.
    """
    sums = [F.sum(F.get(_named("characters"), F.lit(k))).alias(f"c{k}") for k in range(len(CLASSES))]
    sums += [F.sum(F.get(_named("words"), F.lit(k))).alias(f"w{k}") for k in range(BINS)]
    summed = stage(described.where(~_base_failed() & F.col(lang).isNotNull()).groupBy(F.col(lang).alias(_named("lang"))).agg(*sums), "divergence-references")
    known = F.col(_named("lang")).isin(*LANGUAGES)
    parts = lambda xs: [x / sum(xs) for x in xs]
    refs = {r[0]: (parts(r[1:1 + len(CLASSES)]), parts(r[1 + len(CLASSES):])) for r in sorted(summed.where(known).collect())}
    others = summed.where(~known)
    if others.isEmpty():
        return refs, None
    own = F.struct(shares(F.array(*[f"c{k}" for k in range(len(CLASSES))])).alias("c"), shares(F.array(*[f"w{k}" for k in range(BINS)])).alias("w"))
    return refs, others.select(_named("lang"), own.alias(_named("own")))


def shares(counts: Column) -> Column:
    """Parts of the whole; zeros without any count."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    return _let(F.greatest(total, F.lit(1)), lambda n: F.transform(counts, lambda c: c / n))


def _information(parts: Column) -> Column:
    """Sum of x * log2(x), 0 at 0."""
    return F.aggregate(parts, F.lit(0.0), lambda a, x: a + F.when(x > 0, x * F.log2(x)).otherwise(0.0))


def distance(p: Column, own: Column, reference: list[float] | Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) between shares and a reference; own is the shares' _information.

    The divergence is the entropy of the mean less the mean of the entropies.
    """
    if isinstance(reference, Column):
        theirs = _information(reference)
    else:
        theirs, reference = sum(q * math.log2(q) for q in reference if q > 0), F.array(*map(F.lit, reference))
    mean = _information(F.zip_with(p, reference, lambda a, b: (a + b) / 2))
    return F.sqrt(F.greatest((own + theirs) / 2 - mean, F.lit(0.0)))


def judge(described: DataFrame, refs: dict[str, tuple[list[float], list[float]]], others: DataFrame | None = None, lang: str = "lang",
          into: str = "_dr_verdict") -> DataFrame:
    """described and a struct: base_failed, language, character_distance, word_distance, kept."""
    failed, n = _base_failed(), F.col(_named("n_words"))
    near = "struct<total:double,c:double,w:double,language:string>"
    if others is not None:
        described = described.join(others, F.col(lang) == F.col(_named("lang")), "left")
    own = F.col(_named("own"))

    def nearest(p: Column, q: Column) -> Column:
        def of_language(name: Column, c: list[float] | Column, w: list[float] | Column, i: Column) -> Column:
            pair = F.struct(distance(p, i["c"], c).alias("c"), distance(q, i["w"], w).alias("w"))
            return _let(pair, lambda d: F.struct((d["c"] + d["w"]).alias("total"), d["c"].alias("c"), d["w"].alias("w"), name.alias("language")))

        def of_all(i: Column) -> Column:
            found = [of_language(F.lit(x), c, w, i) for x, (c, w) in refs.items()]
            if others is not None:
                found.append(F.when(own.isNotNull(), of_language(F.col(_named("lang")), own["c"], own["w"], i)))
            return F.array_min(F.array(*found))  # passes over nulls
        return _let(F.struct(_information(p).alias("c"), _information(q).alias("w")), of_all)

    best = (_let(shares(F.col(_named("characters"))), lambda p: _let(shares(F.col(_named("words"))), lambda q: nearest(p, q)))
            if refs or others is not None else F.lit(None).cast(near))
    rows = _pinned(described, F.when(n >= GUARD_WORDS, best), _named("best"))
    b = F.col(_named("best"))
    spared = (n < GUARD_COMMON) | (F.lit(False) if others is None else own.isNotNull())
    close = F.coalesce((b["c"] <= MOST_CHARACTERS) & ((b["w"] <= MOST_COMMON) | spared), F.lit(True))
    return rows.withColumn(into, F.struct(failed.alias("base_failed"), b["language"].alias("language"), b["c"].alias("character_distance"),
                                          b["w"].alias("word_distance"), (~failed & close).alias("kept"))).drop(*map(_named, ("best", "lang", "own")))


def _pinned(df: DataFrame, value: Column, name: str) -> DataFrame:
    """df with a column that is computed once for each row.

    A filter on a plain column is moved below it by the optimizer, which then writes the whole expression out at each use; what a generator
    returns stays where it is.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and both distances to the nearest reference."""
    described = stage(describe(docs.select("doc_id", "text", "lang")).drop("text"), "divergence-counts")
    v = F.col("_dr_verdict")
    return judge(described, *references(described)).select(
        "doc_id", *[F.col(_named(c)).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        v["base_failed"].alias("base_failed"), v["kept"].alias("kept"), v["language"].alias("nearest_language"),
        F.round(v["character_distance"], 6).alias("character_distance"), F.round(v["word_distance"], 6).alias("word_distance"))


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns. Counts are taken once and written with the documents."""
    described = stage(describe(docs), "divergence-counts")
    return judge(described, *references(described)).where("_dr_verdict.kept").select(*[F.col(f"`{c}`") for c in docs.columns])
