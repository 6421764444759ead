"""Cleaning expressions: recodes, bins, first-match replacement, safe casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def one_of(c, values: Sequence) -> Column:
    """Membership that is never NULL: a missing value is simply not a member."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def cut(c, breaks: Sequence[float], labels: Sequence[str], missing: str | None = None) -> Column:
    """Right-closed bins. ``breaks`` are the inner upper bounds, so labels is one longer."""
    c = _col(c)
    ladder = F.when(c.isNull(), F.lit(missing))
    for upper, label in zip(breaks, labels):
        ladder = ladder.when(c <= upper, label)
    return ladder.otherwise(labels[-1])


def recode(c, mapping: Mapping[str, Sequence[str]], default: str | Column | None = None) -> Column:
    """``mapping`` is label -> accepted values. NULL stays NULL.

    Without a default other values are kept as they are.
    """
    c = _col(c)
    ladder = F.when(c.isNull(), F.lit(None).cast("string"))
    for label, values in mapping.items():
        ladder = ladder.when(c.isin(list(values)), label)
    if default is None:
        return ladder.otherwise(c)
    return ladder.otherwise(F.lit(default) if isinstance(default, str) else default)


def classify(c, mapping: Mapping[str, Sequence[str]], other: str | None, missing: str | None = None) -> Column:
    """Like recode, but a missing value becomes ``missing`` (or ``other`` if not given)."""
    c = _col(c)
    ladder = None
    for label, values in mapping.items():
        ladder = F.when(c.isin(list(values)), label) if ladder is None else ladder.when(c.isin(list(values)), label)
    if missing is not None:
        ladder = ladder.when(c.isNull(), missing)
    return ladder.otherwise(F.lit(other))


def levels(c, allowed: Sequence[str], unknown: str = "Not known") -> Column:
    c = _col(c)
    return F.when(c.isin(list(allowed)), c).otherwise(F.lit(unknown))


def level_order(c, allowed: Sequence[str]) -> Column:
    """Position of a value in its list of levels; values outside the list come last."""
    ladder = F.lit(len(allowed) + 1)
    for i, v in reversed(list(enumerate(allowed, 1))):
        ladder = F.when(_col(c) == v, i).otherwise(ladder)
    return ladder


def replace_first(c, pattern: str, replacement: str) -> Column:
    """Replace the first match only (regexp_replace alone changes every match)."""
    return F.regexp_replace(_col(c), rf"(?s)^(.*?)(?:{pattern})", "$1" + replacement)


def null_if(c, *values: str) -> Column:
    return reduce(lambda acc, v: F.nullif(acc, F.lit(v)), values, _col(c))


def to_number(c) -> Column:
    """Double, or NULL where the text is not a number."""
    c = _col(c)
    return F.when(c.rlike(_NUMBER), F.trim(c).try_cast("double"))


def junk_to_null(df: DataFrame, values: Sequence[str] = ("", "NULL", "null", "Null")) -> DataFrame:
    """Spellings of a missing value become NULL in every text column."""
    def fix(f):
        name = F.col(f"`{f.name}`")
        return F.when(~name.isin(list(values)), name).alias(f.name) if f.dataType.simpleString() == "string" else name
    return df.select(*[fix(f) for f in df.schema.fields])


def swap_repair(first, second, parse) -> tuple[Column, Column]:
    """(date, text) when the two were typed into each other's columns."""
    first, second = _col(first), _col(second)
    misplaced = parse(second)
    return F.coalesce(parse(first), misplaced), F.coalesce(F.when(misplaced.isNotNull(), first), second)


def coalesce_names(*cols) -> Column:
    return F.coalesce(*[_col(c) for c in cols])


def fingerprint(*cols, sep: str = "|", missing: str = "NA") -> Column:
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit(missing)) for c in cols])


def deciles_to_quintiles(c, missing: str | None = None) -> Column:
    """Deciles 1-10 to quintiles 1-5 (numbers)."""
    c = _col(c).cast("int")
    return F.when(c.between(1, 10), F.ceil(c / 2).cast("int"))


def round_to(c, base: int = 5) -> Column:
    """Round to a multiple of base, halves to even as in the published tables."""
    return (F.bround(_col(c) / base, 0) * base).cast("bigint")


def hide_small(c, threshold: int = 10) -> Column:
    c = _col(c)
    return F.when(c < threshold, F.lit(f"<{threshold}")).otherwise(c.cast("string"))


def ratio(top, bottom, digits: int | None = 4) -> Column:
    value = F.try_divide(_col(top).cast("double"), F.nullif(_col(bottom).cast("double"), F.lit(0.0)))
    return value if digits is None else F.round(value, digits)
