"""Date text parsing, calendar labels and day/month differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The day that spreadsheet serial 0 stands for.
EXCEL_ORIGIN = "1899-12-30"

# Month names, and the accepted text formats as one pattern (times included, so that only the day is left to check).
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_NAME, _TIME = "(?i:" + "|".join(MONTHS[i:i + 3] for i in range(0, 36, 3)) + ")", r"(?:[01]?\d|2[0-3]):[0-5]\d"
DATE_TEXT = "^(?:" + "|".join([
    rf"\d{{1,2}}/\d{{1,2}}/\d{{4}}(?: {_TIME})?",  # d/M/yyyy, d/M/yyyy H:mm
    rf"{_NAME} \d{{1,2}} \d{{4}} {_TIME}",  # MMM d yyyy H:mm
    rf"\d{{1,2}}-(?:\d{{1,2}}|{_NAME})-\d{{2}}",  # d-M-yy, d-MMM-yy
    rf"\d{{4}}-\d{{1,2}}-\d{{1,2}} {_TIME}:[0-5]\d",  # yyyy-M-d H:mm:ss
    r"\d{8}",  # yyyyMMdd
]) + r")\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def excel_serial(c) -> Column:
    """Spreadsheet day number held as text, NULL when it is not a whole number."""
    return F.date_add(F.lit(EXCEL_ORIGIN).cast("date"), _col(c).try_cast("int"))


def _part(c: Column, sep: str, i: int) -> Column:
    return F.substring_index(F.substring_index(c, sep, i), sep, -1)


def _month_number(name: Column) -> Column:
    return ((F.instr(F.lit(MONTHS.upper()), F.upper(name)) + 2) / 3).cast("int").cast("string")


def parse_formats(c) -> Column:
    """Date part of text in one of the accepted formats, else NULL.

    One pattern accepts the text; its separators then say where year, month and day stand. They are put in one order and read
    as a date once: no value pays for several patterns, and the code stays small enough to be compiled.
    """
    c = _col(c)
    middle = _part(c, "-", 2)
    year, month, day = (F.substring(c, i, n) for i, n in ((1, 4), (5, 2), (7, 2)))
    day_first = F.concat_ws("-", F.substring(F.substring_index(c, "/", -1), 1, 4), _part(c, "/", 2), F.substring_index(c, "/", 1))
    name_first = F.concat_ws("-", _part(c, " ", 3), _month_number(F.substring(c, 1, 3)), _part(c, " ", 2))
    short = F.concat(F.lit("20"), F.substring_index(c, "-", -1), F.lit("-"), F.when(F.length(middle) == 3, _month_number(middle)).otherwise(middle),
                     F.lit("-"), F.substring_index(c, "-", 1))
    spaced, dashed = F.contains(c, F.lit(" ")), F.contains(c, F.lit("-"))
    text = (F.when(F.contains(c, F.lit("/")), day_first).when(spaced & dashed, F.substring_index(c, " ", 1)).when(spaced, name_first)
            .when(dashed, short).otherwise(F.concat_ws("-", year, month, day)))
    return F.when(c.rlike(DATE_TEXT), text.try_cast("date"))


def parse_date(c) -> Column:
    """Five characters are a spreadsheet serial, everything else a formatted date."""
    c = _col(c)
    return F.when(F.length(c) == 5, excel_serial(c)).otherwise(parse_formats(c))


def month_start(c) -> Column:
    return F.trunc(_col(c), "MM")


def days_between(start, end) -> Column:
    return F.datediff(_col(end), _col(start))


def complete_months(start, end) -> Column:
    """Whole months from start to end; a month counts once its day of month is reached.

    Spans that run backwards count whole months too, rounded towards zero.
    """
    start, end = _col(start), _col(end)
    span = (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))
    short_fwd = (span > 0) & (F.day(end) < F.day(start))
    short_back = (span < 0) & (F.day(end) > F.day(start))
    return F.when(short_fwd, span - 1).when(short_back, span + 1).otherwise(span)


def financial_year(c) -> Column:
    """Label such as 2021-22 for a year that starts in April."""
    first = F.year(F.add_months(_col(c), -3))
    return F.concat(first.cast("string"), F.lit("-"), F.lpad(((first + 1) % 100).cast("string"), 2, "0"))


def month_label(c, style: str = "MMM yyyy") -> Column:
    return F.date_format(_col(c), style)


def year_month_or_null(c, fmt: str = "d/M/yyyy") -> Column:
    """yyyyMM of text in one given format, NULL where it does not parse."""
    return F.date_format(F.try_to_timestamp(_col(c), F.lit(fmt)), "yyyyMM")


def in_window(c, start: str, end: str) -> Column:
    """start <= date < end, as plain range predicates that reach the scan."""
    c = _col(c)
    return (c >= F.lit(start).cast("date")) & (c < F.lit(end).cast("date"))


def include_label(received, reference_date) -> Column:
    """Include rows received on or after the 15th of the month before the reference date."""
    ref = F.lit(reference_date).cast("date") if isinstance(reference_date, str) else reference_date
    cut = F.add_months(F.date_add(F.trunc(ref, "MM"), 14), -1)
    return F.when(_col(received) >= cut, "Include").otherwise("Exclude")
