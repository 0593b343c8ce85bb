"""Column names and types: repair names, apply a declared schema, infer from text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.functions.dates import YEAR_FIRST, parse_date, parse_moment
from fieldspark.functions.nulls import num_text
from fieldspark.functions.text import sentinel_to_null


#: A number in plain or exponent form. Java would also read ``5d``, ``7F`` and ``NaN``.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(c: Column) -> Column:
    """Text as a number; text that is not one from end to end is missing."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def logical(c: Column) -> Column:
    """Text as true or false: ``TRUE``, ``FALSE``, ``T`` or ``F`` in any case; all else is missing."""
    letters = F.upper(c)
    return F.when(letters.isin("T", "TRUE"), True).when(letters.isin("F", "FALSE"), False)


def numbers(df: DataFrame, *names: str) -> DataFrame:
    """Text among the named columns as numbers; columns that are numbers already stay."""
    kinds = dict(df.dtypes)
    return df.withColumns({n: number(F.col(n)) for n in names if kinds.get(n) == "string"})


def clean_name(name: str) -> str:
    """snake_case: ``Site Name (2024)`` -> ``site_name_2024``, ``% cover`` -> ``percent_cover``."""
    text = name.replace("%", "_percent_").replace("#", "_number_").replace("'", "").replace('"', "")
    text = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", text)
    text = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", text)
    text = re.sub(r"[^A-Za-z0-9]+", "_", text).strip("_").lower()
    if not text:
        return "x"
    return f"x{text}" if text[0].isdigit() else text


def clean_names(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Repair all column names; repeated names get ``_2``, ``_3`` and so on. Metadata only."""
    used: set[str] = set()
    names = []
    for raw in df.columns:
        base = raw if raw in keep else clean_name(raw)
        name, i = base, 2
        while name in used:
            name, i = f"{base}_{i}", i + 1
        used.add(name)
        names.append(name)
    return df.toDF(*names)


def typed(c: Column, target: T.DataType, formats: Sequence[str] | None = None) -> Column:
    """Text to the target type; text that does not fit is missing, never an error."""
    if isinstance(target, T.DateType):
        return parse_date(c, formats or YEAR_FIRST)
    if isinstance(target, T.TimestampType) and formats:
        return parse_moment(c, formats)
    if isinstance(target, T.BooleanType):
        return logical(c)
    if isinstance(target, (T.IntegralType,)):
        return number(c).try_cast(target)
    if isinstance(target, T.NumericType):
        return number(c).try_cast(target)
    return c.try_cast(target)


def apply_schema(
    df: DataFrame,
    schema: T.StructType,
    date_formats: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Cast the columns named in ``schema``; other columns stay as they are.

    A date or time is read by the forms given in ``date_formats``, else by those in the field's metadata.
    """
    formats = date_formats or {}
    present = dict(df.dtypes)
    out = {}
    for field in schema:
        c = F.col(field.name)
        already = present[field.name] == field.dataType.simpleString()
        if already:
            continue
        text = isinstance(field.dataType, T.StringType)
        if text and present[field.name] == "double":
            out[field.name] = num_text(c)
        elif present[field.name] == "string":
            out[field.name] = typed(c, field.dataType, formats.get(field.name) or (field.metadata or {}).get(FORMATS))
        elif isinstance(field.dataType, T.DateType):
            out[field.name] = F.to_date(c)
        else:
            out[field.name] = c.try_cast(field.dataType)
    return df.withColumns(out) if out else df


def unreadable(df: DataFrame, schema: T.StructType, date_formats: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """What ``apply_schema`` would make missing: ``column, type, n_unreadable`` and the least such text as ``example``, a row for each text column.

    One aggregate over the table, whatever the number of columns.
    """
    kinds = dict(df.dtypes)
    fields = [f for f in schema if kinds[f.name] == "string" and not isinstance(f.dataType, T.StringType)]
    read = apply_schema(df.select(*[F.col(f.name).alias(f.name) for f in fields], *[F.col(f.name).alias(f"__was_{f.name}") for f in fields]), T.StructType(fields), date_formats)
    lost = {f.name: F.when(F.col(f.name).isNull(), F.col(f"__was_{f.name}")) for f in fields}
    found = F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.count(lost[f.name]).alias("n_unreadable"), F.min(lost[f.name]).alias("example"))
            for f in fields
        ]
    )
    return read.agg(found.alias("f")).select(F.explode("f").alias("f")).select("f.*")


def all_text(df: DataFrame, sentinel: str = "NULL", exclude: Sequence[str] = ()) -> DataFrame:
    """Every column as text, the sentinel as missing."""
    return df.select(
        *[
            F.col(c) if c in exclude else sentinel_to_null(F.col(c).cast("string"), sentinel).alias(c)
            for c in df.columns
        ]
    )


#: Kinds that re-inference knows, narrowest first, with the forms that make a date or a time of a text. A text that fits several is the first.
DAY_FORMS = {"year_first": ("yyyy-M-d", "yyyy/M/d"), "month_first": ("M/d/yyyy", "M-d-yyyy")}
MOMENT_FORMS = {
    "year_first": ("yyyy-M-d HH:mm", "yyyy-M-d HH:mm:ss[.SSSSSS]", "yyyy-M-d'T'HH:mm:ss[.SSSSSS]", "yyyy/M/d HH:mm", "yyyy/M/d HH:mm:ss"),
    "month_first": ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M-d-yyyy H:mm", "M-d-yyyy H:mm:ss"),
}
#: Metadata of an inferred field: the forms that its text is read by.
FORMATS = "formats"


def _lattice() -> list[tuple[T.DataType, tuple[str, ...], object]]:
    """Kinds with their forms and what reads a text as one (missing if it is not)."""
    days = [(T.DateType(), forms, lambda c, f=forms: parse_date(c, f)) for forms in DAY_FORMS.values()]
    moments = [(T.TimestampType(), forms, lambda c, f=forms: parse_moment(c, f)) for forms in MOMENT_FORMS.values()]
    return [(T.BooleanType(), (), logical), (T.DoubleType(), (), number), *days, *moments]


def infer_schema(df: DataFrame, columns: Sequence[str] | None = None) -> T.StructType:
    """Narrowest type that fits every non-missing value of a text column: logical, number, date, time or text.

    Logical is ``TRUE``, ``FALSE``, ``T`` or ``F`` in any case; dates and times have year or month first, the same order in the whole column
    (year first if both fit), which the field's metadata tells ``apply_schema``. A column of dates some of which carry a time is one of times. One aggregate
    over the table, one row to the driver, whatever the number of kinds. Columns without values stay text.
    """
    columns = list(columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    kinds = _lattice()
    checks = []
    for i, name in enumerate(columns):
        c = F.col(name)
        days = {k: kinds[2 + k][2](c) for k in range(2)}
        for j, (kind, _, read) in enumerate(kinds):
            fits = read(c).isNotNull()
            if isinstance(kind, T.TimestampType):
                fits = fits | days[j - 4].isNotNull()
            checks.append(F.coalesce(F.bool_and(F.when(c.isNotNull(), fits)), F.lit(False)).alias(f"c{i}_{j}"))
    row = df.agg(*checks).first() if checks else {}
    fields = []
    for i, name in enumerate(columns):
        kind, forms = next(((kind, forms) for j, (kind, forms, _) in enumerate(kinds) if row[f"c{i}_{j}"]), (T.StringType(), ()))
        if isinstance(kind, T.TimestampType):
            forms = (*forms, *DAY_FORMS[next(k for k, v in MOMENT_FORMS.items() if v == forms)])
        fields.append(T.StructField(name, kind, metadata={FORMATS: list(forms)} if forms else None))
    return T.StructType(fields)


def type_convert(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The table with its text columns as ``infer_schema`` finds them."""
    return apply_schema(df, infer_schema(df, columns))
