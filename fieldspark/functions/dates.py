"""Dates: lenient parsing, calendar parts and pushable range predicates."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.functions.nulls import as_column

YEAR_FIRST = ["yyyy-M-d", "yyyy/M/d", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss"]
MONTH_FIRST = ["M/d/yyyy", "M-d-yyyy"]
#: Times as forms write them, in either order.
MOMENTS = ["yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm"]
ANY_DATE = [*YEAR_FIRST, *MONTH_FIRST, *MOMENTS]

#: What a part of a date may hold; two letters ask for two digits.
_PARTS = {
    "yyyy": r"(\d{4})", "MM": r"(0[1-9]|1[0-2])", "M": r"(0?[1-9]|1[0-2])", "dd": r"(0[1-9]|[12]\d|3[01])", "d": r"(0?[1-9]|[12]\d|3[01])",
}
_TIMES = {"HH": r"(?:[01]\d|2[0-3])", "H": r"(?:[01]?\d|2[0-3])", "mm": r"[0-5]\d", "ss": r"[0-5]\d", "[.SSSSSS]": r"(?:\.\d{1,6})?"}
_TOKEN = re.compile(r"\[\.S+\]|'[^']*'|y+|M+|d+|H+|m+|s+|.")


class Shapes:
    """The forms that a date may be written in, as one pattern, and what rewrites any of them in year-month-day order.

    Text of no known form is rewritten to something that is no date. The ranges of months, days, hours and minutes are part of a form,
    so of two forms that look alike (month first, day first) the first that can be meant is taken. Forms with other parts (a month's name,
    a zone) are left to Spark's own parser, one call each, for text of no known form.
    """

    def __init__(self, formats: Sequence[str]):
        groups: dict[str, list[int]] = {"y": [], "M": [], "d": [], "time": []}
        count, forms = 0, []
        self.others = [f for f in formats if _has_other_parts(f)]
        for form in formats:
            if form in self.others:
                continue
            pattern, time = "", ""
            for token in _TOKEN.findall(form):
                literal = token.strip("'") if token[0] == "'" and len(token) > 1 else token
                if token in _PARTS and not time:
                    count += 1
                    groups[token[0]].append(count)
                    pattern += _PARTS[token]
                elif token in _TIMES or time:
                    time += _TIMES.get(token, re.escape(literal))
                else:
                    pattern += re.escape(literal)
            if time:
                count += 1
                groups["time"].append(count)
                # the sign between date and time is not carried over
                pattern += f"({time})"
            forms.append(pattern)
        self.pattern = rf"\A(?:{'|'.join(forms)})\z|\A[\s\S]*\z"
        day = "-".join("".join(f"${i}" for i in groups[k]) for k in "yMd")
        self.day = day
        self.moment = day + " " + "".join(f"${i}" for i in groups["time"])

    def day_of(self, c: Column) -> Column:
        known = F.regexp_replace(c, self.pattern, self.day).try_cast("date")
        return F.coalesce(known, *[F.try_to_date(c, f) for f in self.others]) if self.others else known

    def moment_of(self, c: Column) -> Column:
        known = F.regexp_replace(c, self.pattern, self.moment).try_cast("timestamp")
        return F.coalesce(known, *[F.try_to_timestamp(c, F.lit(f)) for f in self.others]) if self.others else known


def _has_other_parts(form: str) -> bool:
    return any(t.isalpha() and t not in _PARTS and t not in _TIMES for t in _TOKEN.findall(form))


def parse_date(c: Column | str, formats: Sequence[str] = tuple(YEAR_FIRST)) -> Column:
    """The day that text stands for, in the first form that fits; text that fits none is missing.

    One pattern tells the form and puts the parts in order, and one cast reads them, whatever the number of forms.
    """
    return Shapes(formats).day_of(as_column(c))


def parse_moment(c: Column | str, formats: Sequence[str] = (*MOMENTS, *YEAR_FIRST, *MONTH_FIRST)) -> Column:
    """The same for a point in time; a date alone is its midnight."""
    return Shapes(formats).moment_of(as_column(c))


def day_of(df: DataFrame, name: str, formats: Sequence[str] = tuple(ANY_DATE)) -> Column:
    """The day in a column of either kind: dates and times as they are, text parsed, unreadable text missing."""
    return parse_date(name, formats) if dict(df.dtypes)[name] == "string" else F.to_date(name)


def moment_of(df: DataFrame, name: str, formats: Sequence[str] = (*MOMENTS, *YEAR_FIRST, *MONTH_FIRST)) -> Column:
    """The same for a point in time."""
    return parse_moment(name, formats) if dict(df.dtypes)[name] == "string" else F.col(name)


def in_year(c: Column | str, year: int) -> Column:
    """Half-open range, so that the predicate can reach a Parquet scan (``year()`` cannot)."""
    c = as_column(c)
    return (c >= F.lit(date(year, 1, 1))) & (c < F.lit(date(year + 1, 1, 1)))


def week_start(c: Column | str) -> Column:
    """The Monday on or before a date."""
    return F.date_trunc("week", as_column(c)).cast("date")


def latest_of(resurvey: Column | str, original: Column | str) -> Column:
    """The resurvey date where there is one, else the original date."""
    return F.coalesce(as_column(resurvey), as_column(original))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(as_column(later), as_column(earlier)).cast("double")


def stamp_text(c: Column | str) -> Column:
    return F.date_format(as_column(c), "yyyyMMdd_HHmmss")
