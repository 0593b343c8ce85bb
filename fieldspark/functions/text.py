"""Text cleaning: whitespace, site codes, recodes and pattern classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldspark.fixed_values import DEPTH_PATTERNS, SITE_PREFIX_PATTERNS
from fieldspark.functions.nulls import as_column


def squish(c: Column | str) -> Column:
    """Trim, and collapse inner whitespace (any Unicode space) to one blank."""
    return F.trim(F.regexp_replace(as_column(c), r"(?U)\s+", " "))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(as_column(c), F.lit(""))


def squish_to_null(c: Column | str) -> Column:
    """Squish first, then missing if nothing is left, so blank-only text is missing too."""
    return blank_to_null(squish(c))


def sentinel_to_null(c: Column | str, sentinel: str = "NULL") -> Column:
    return F.nullif(as_column(c), F.lit(sentinel))


def strip_side(c: Column | str) -> Column:
    """Drop one trailing side letter: ``12R`` -> ``12``."""
    return F.regexp_replace(as_column(c), "[RL]$", "")


def site_code(c: Column | str) -> Column:
    """First ``REC<digits>`` gets an underscore: ``REC7`` -> ``REC_7``; the rest is untouched."""
    return F.regexp_replace(as_column(c), r"(?s)^(.*?)REC(\d+)", "$1REC_$2")


def site_code_padded(c: Column | str) -> Column:
    """First letters+digits become upper case, underscore, two digits: ``rec5`` -> ``REC_05``."""
    c = as_column(c)
    pattern = r"(?s)^(.*?)([A-Za-z]+)([0-9]+)(.*)$"
    before, letters, digits, after = (F.regexp_extract(c, pattern, i) for i in (1, 2, 3, 4))
    padded = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    return F.when(
        c.rlike(pattern), F.concat(before, F.upper(letters), F.lit("_"), padded, after)
    ).otherwise(c)


def classify(c: Column | str, patterns: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """Label of the first pattern found (any case), else ``default``."""
    c = as_column(c)
    return labelled([(c.rlike("(?i)" + pattern), label) for pattern, label in patterns], default)


def labelled(cases: Sequence[tuple[Column, str]], default: Column | str | None = None) -> Column:
    """Label of the first condition that holds, else ``default``."""
    (first, label), *others = cases
    out = F.when(first, F.lit(label))
    for condition, other in others:
        out = out.when(condition, F.lit(other))
    return out if default is None else out.otherwise(default)


def recode(c: Column | str, aliases: Mapping[str, Sequence[str]]) -> Column:
    """Replace each known alias by its code; other values pass through.

    One lookup in a literal map, so the value is worked out twice whatever the number of aliases,
    also where Spark copies the expression into a filter.
    """
    c = as_column(c)
    entries = [F.lit(x) for code, names in aliases.items() for name in names for x in (name, code)]
    return F.coalesce(F.element_at(F.create_map(*entries), c), c)


def extract_first(c: Column | str, pattern: str) -> Column:
    """The first match of a pattern, missing if there is none."""
    return blank_to_null(F.regexp_extract(as_column(c), pattern, 0))


def location_id(c: Column | str) -> Column:
    """``Kelp Forest 1 Deep`` -> ``KF1_deep``; missing if any of the three parts is missing."""
    text = F.lower(as_column(c))
    return F.concat(
        classify(text, SITE_PREFIX_PATTERNS),
        extract_first(text, r"\b\d+\b"),
        F.lit("_"),
        classify(text, DEPTH_PATTERNS),
    )


def safe_name(c: Column | str) -> Column:
    """Runs of characters unfit for a file name become one underscore."""
    return F.regexp_replace(as_column(c), r"[^A-Za-z0-9_\-]+", "_")
