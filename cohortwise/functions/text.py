"""Free text: splitting of findings and closeness to a list of accepted terms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators between findings, including a lower-to-upper case boundary.
FINDING_SEPARATOR = r"-| - |\. |(?<=\p{Lower})(?=\p{Upper}\p{Lower})"

_USED = "\u0000"


def split_findings(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.transform(F.split(c, FINDING_SEPARATOR), lambda t: F.lower(t))


def jaro_distance(a: Column, b: Column) -> Column:
    """1 - Jaro similarity, as string expressions that stay in the JVM.

    Every character of ``a`` takes the first free equal character of ``b`` inside the
    matching band; taken characters of ``b`` are blanked so that they are used once.
    Two characters out of order make one transposition, an odd one left over makes none.
    """
    la, lb = F.length(a), F.length(b)
    band = F.greatest(F.floor(F.greatest(la, lb) / 2).cast("int") - 1, F.lit(0))

    def take(state, i):
        ch = F.substring(a, i, F.lit(1))
        low = F.greatest(i - band, F.lit(1))
        high = F.least(i + band, lb)
        view = F.substring(state["rest"], low, F.greatest(high - low + 1, F.lit(0)))
        at = F.position(ch, view)
        rest = F.concat(
            F.substring(state["rest"], F.lit(1), low + at - 2), F.lit(_USED),
            F.substring(state["rest"], low + at, lb),
        )
        hit = at > 0
        return F.struct(
            F.when(hit, rest).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.concat(state["taken"], ch)).otherwise(state["taken"]).alias("taken"),
        )

    def finish(state):
        m = F.length(state["taken"])
        in_b = F.array_join(
            F.transform(
                F.filter(F.sequence(F.lit(1), lb), lambda j: F.substring(state["rest"], j, F.lit(1)) == _USED),
                lambda j: F.substring(b, j, F.lit(1)),
            ), "")
        out_of_order = F.size(F.filter(
            F.sequence(F.lit(1), m),
            lambda k: F.substring(state["taken"], k, F.lit(1)) != F.substring(in_b, k, F.lit(1))))
        swaps = F.floor(out_of_order / 2)
        return F.when(m == 0, F.lit(1.0)).otherwise(
            1.0 - (m / la + m / lb + (m - swaps) / m) / 3.0)

    start = F.struct(b.alias("rest"), F.lit("").alias("taken"))
    walked = F.aggregate(F.sequence(F.lit(1), la), start, take, finish)
    return (F.when((la == 0) & (lb == 0), F.lit(0.0))
            .when((la == 0) | (lb == 0), F.lit(1.0))
            .otherwise(walked))


def letter_counts(token: Column, letters: str) -> Column:
    """How often each of some letters occurs in a token."""
    return F.array(*[F.length(token) - F.length(F.replace(token, F.lit(c), F.lit(""))) for c in letters])


def least_distance(counts: Column, length: Column, term: str, letters: str) -> Column:
    """No Jaro distance of the token to the term is lower: matches are at most the letters both have, transpositions at least none."""
    shared = F.lit(0)
    for c in sorted(set(term)):
        shared = shared + F.least(F.element_at(counts, letters.index(c) + 1), F.lit(term.count(c)))
    most = F.when(length > 0, (shared / F.greatest(length, F.lit(1)) + shared / len(term) + 1) / 3)
    return F.when(shared > 0, 1 - most).otherwise(1.0) if term else F.when(length > 0, F.lit(1.0)).otherwise(0.0)


def closest_of(token: Column, bounds: Column) -> Column:
    """Array of (distance, term) of the closest terms, ties all kept; bounds has (least distance, term) of each, the first in order is tried first.

    Only terms whose least distance does not pass the distance of the first are measured.
    """
    exact = lambda t: F.round(jaro_distance(token, t), 9)
    able = F.transform(F.array(F.array_min(bounds)), lambda first: F.struct(exact(first["term"]).alias("d")))
    close = F.flatten(F.transform(able, lambda bar: F.filter(bounds, lambda b: b["least"] <= bar["d"] + 1e-8)))
    scored = F.array_sort(F.transform(close, lambda b: F.struct(exact(b["term"]).alias("distance"), b["term"].alias("term"))))
    return F.flatten(F.transform(F.array(scored), lambda all_: F.filter(all_, lambda s: s["distance"] == F.element_at(all_, 1)["distance"])))


def nearest_terms(token: Column, terms: Sequence[str]) -> Column:
    """Array of (term, distance) for the closest accepted terms; ties are all kept."""
    scored = F.transform(
        F.array(*[F.lit(t) for t in terms]),
        lambda t: F.struct(F.round(jaro_distance(token, t), 9).alias("distance"), t.alias("term")),
    )
    best = F.aggregate(
        scored, F.array().cast("array<struct<distance:double,term:string>>"),
        lambda acc, s: (F.when((F.size(acc) == 0) | (s["distance"] < F.element_at(acc, 1)["distance"]), F.array(s))
                        .when(s["distance"] == F.element_at(acc, 1)["distance"], F.concat(acc, F.array(s)))
                        .otherwise(acc)))
    return best
