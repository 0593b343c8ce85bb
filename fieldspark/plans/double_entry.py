"""Reconciling sheets that were typed in twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.fixed_values import CANOPY_TAXON, QUADRAT_OFFICE_COLUMNS, SPECIES_OFFICE_COLUMNS, UNNAMED_COLUMNS
from fieldspark.functions.dates import in_year
from fieldspark.functions.nulls import diff_text, differs, present, sum0
from fieldspark.functions.text import site_code, strip_side
from fieldspark.operators.joins import missing_keys
from fieldspark.sources.landed import ROW_ID, drop_first_row
from fieldspark.sources.typing import apply_schema

QUADRAT_KEYS = ["site", "site_type", "zone", "survey_date", "transect", "quadrat"]
TRANSECT_KEYS = ["site", "site_type", "zone", "date", "transect"]
SPECIES_KEYS = [*TRANSECT_KEYS, "depth", "depth_units", "species"]
SIZE_KEYS = [*SPECIES_KEYS, "size"]

QUADRAT_TYPES = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("site", "site_type", "zone")]
    + [T.StructField("survey_date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in ("transect", "quadrat")]
    + [T.StructField(c, T.StringType()) for c in ("substrate", "drift_superlayer")]
)
_SPECIES_TYPES = (
    [T.StructField(c, T.StringType()) for c in ("site", "site_type", "zone", "depth_units", "species")]
    + [T.StructField("date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in ("transect", "depth", "count")]
)
SIZE_TYPES = T.StructType(_SPECIES_TYPES + [T.StructField("size", T.DoubleType())])
SWATH_TYPES = T.StructType(
    _SPECIES_TYPES
    + [T.StructField(c, T.DoubleType()) for c in ("stipe_counts_macrocystis_only", "subsample_meter")]
)
STAR_TYPES = T.StructType([*SIZE_TYPES.fields, T.StructField("diet", T.StringType())])
#: Row pairs that one task writes at a time.
PAIR_CHUNK = 65_536
#: Distinct values of a key, of each entry, that are compared at a time.
PAIR_BLOCK = 256


def prepare_entry(
    raw: DataFrame,
    types: T.StructType,
    *,
    example_row: bool = True,
    side_column: str | None = None,
    drop: Sequence[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """A landed sheet made comparable: typed, site names standardised, clerical columns dropped.

    ``drop`` lists the clerical columns; by default those of the quadrat sheet for its types, else those of the
    other sheets, which keep their notes: rows that differ in them stay two rows.
    """
    if drop is None:
        drop = QUADRAT_OFFICE_COLUMNS if "quadrat" in types.names else SPECIES_OFFICE_COLUMNS
    df = drop_first_row(raw) if example_row else raw
    if side_column is not None:
        df = df.withColumn(side_column, strip_side(side_column))
    df = apply_schema(df, types).withColumn("site", site_code("site"))
    clerical = [c for c in df.columns if c in drop or c == ROW_ID or c.startswith("windows_ctrl") or c in UNNAMED_COLUMNS]
    df = df.drop(*clerical)
    return df.distinct() if unique else df


def compare_entries(
    first: DataFrame,
    second: DataFrame,
    keys: Sequence[str],
    compare: Mapping[str, str] | Sequence[str],
    *,
    null_aware: bool = False,
    report_missing: bool = False,
    year: int | None = None,
    date_column: str | None = None,
    pairs: str = "count",
    unique: bool = False,
) -> DataFrame:
    """Value differences on shared keys, as text ``first ≠ second``.

    ``compare`` lists the value columns, or maps them to the names of the difference columns.
    Keys match when both are missing. A value missing on one side is a difference only under
    ``null_aware``. ``report_missing`` adds the keys found in one entry only, told by
    ``missing_in``. ``year`` keeps one year of ``date_column``.

    Where a key is repeated, every pair of its rows is compared. Rows equal in key and compared
    values are counted first and compared as one, so copies of a key do not multiply;
    the result has one row per distinct difference with the number of row pairs behind it in
    ``n_pairs``. With ``pairs="rows"`` each pair is a row of its own instead.

    With ``unique``, rows of an entry that agree in all columns are one row.

    Both entries are stacked and shuffled twice: by key and values to count copies, then by key. There is no join. The distinct
    values of a key meet in blocks of ``PAIR_BLOCK``, so no row holds more of them, however many a key has.
    """
    if pairs not in ("count", "rows"):
        raise ValueError("pairs must be 'count' or 'rows'")
    keys = list(keys)
    names = dict(compare) if isinstance(compare, Mapping) else {c: f"{c}_diff" for c in compare}
    if year is not None:  # a key predicate, so it holds before the join as well as after
        first, second = (d.where(in_year(date_column, year)) for d in (first, second))

    numeric = {f.name for f in first.schema if isinstance(f.dataType, T.NumericType)}
    # a fraction among the keys goes as text, in which Spark sees one partitioning through all steps
    fractions = {f.name: f.dataType for f in first.schema if f.name in keys and isinstance(f.dataType, T.FractionalType)}
    texts = {c: (F.col(c) + F.lit(0.0)).cast("string") for c in fractions}
    sides = [(d if unique else d.select(*keys, *names)).withColumn("__side", F.lit(i)).withColumns(texts) for i, d in enumerate((first, second))]
    stacked = sides[0].unionByName(sides[1], allowMissingColumns=True)
    # equal rows are counted as one before anything is brought together by key
    if unique and set(stacked.columns) == {*keys, "__side", *names}:  # nothing else tells rows apart, so there is one of each
        counted = stacked.distinct().withColumn("__n", F.lit(1).cast("bigint"))
    else:
        counted = (stacked.distinct() if unique else stacked).groupBy(*keys, "__side", *names).agg(F.count(F.lit(1)).alias("__n"))
    # all tasks of a shuffle are used: Spark would merge them by their packed bytes, and these rows are sorted, listed and counted at many times that size
    tasks = int(first.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = counted.repartition(tasks, *keys)
    of_key = Window.partitionBy(*keys).orderBy("__side")
    whole = of_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = counted.withColumns(
        {
            "__n1": F.count_if(F.col("__side") == 0).over(whole),
            "__n2": F.count_if(F.col("__side") == 1).over(whole),
            "__at": F.row_number().over(of_key) - 1,
        }
    )
    if not report_missing:
        placed = placed.where("__n1 > 0 and __n2 > 0")
    # values of a key meet block by block: the first entry's in blocks i, the second's in blocks j
    is_first, block = F.col("__side") == 0, F.floor(F.when(F.col("__side") == 0, F.col("__at")).otherwise(F.col("__at") - F.col("__n1")) / PAIR_BLOCK)
    others = F.greatest(F.lit(1), F.ceil(F.when(is_first, F.col("__n2")).otherwise(F.col("__n1")) / PAIR_BLOCK))
    spread = placed.select(
        *keys, "__side", F.struct(*names, "__n").alias("__v"), block.alias("__own"), F.explode(F.sequence(F.lit(0).cast("bigint"), others - 1)).alias("__other")
    )
    blocks = spread.groupBy(
        *keys, F.when(is_first, F.col("__own")).otherwise(F.col("__other")).alias("__i"), F.when(is_first, F.col("__other")).otherwise(F.col("__own")).alias("__j")
    ).agg(F.collect_list(F.when(is_first, F.col("__v"))).alias("__1"), F.collect_list(F.when(~is_first, F.col("__v"))).alias("__2"))
    met = blocks.select(*keys, F.explode_outer("__1").alias("__1"), "__2").select(*keys, "__1", F.explode_outer("__2").alias("__2"))
    both = F.col("__1").isNotNull() & F.col("__2").isNotNull()
    unlike = [both & _unlike(f"__1.{c}", f"__2.{c}", c in numeric, null_aware) for c in names]
    found = reduce(lambda a, b: a | b, [*unlike, *([~both] if report_missing else [])])
    result = met.where(found).select(
        *keys,
        *[
            F.when(both, diff_text(f"__1.{c}", f"__2.{c}", numeric=c in numeric, null_aware=null_aware)).alias(out)
            for c, out in names.items()
        ],
        *([F.when(F.col("__2").isNull(), "second").when(F.col("__1").isNull(), "first").alias("missing_in")] if report_missing else []),
        (F.coalesce("__1.__n", F.lit(1)) * F.coalesce("__2.__n", F.lit(1))).alias("n_pairs"),
    )
    told = [*names.values(), *(["missing_in"] if report_missing else [])]
    numbers = {c: F.col(c).cast(kind) for c, kind in fractions.items()}
    if pairs == "count":
        return result.groupBy(*keys, *told).agg(F.sum("n_pairs").alias("n_pairs")).withColumns(numbers)
    # chunks of pairs are dealt to all tasks before they become rows, so no row holds a list of all pairs of a key
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n_pairs") - 1) / PAIR_CHUNK))
    dealt = result.select(*keys, *told, "n_pairs", F.explode(chunks).alias("__chunk")).repartition(tasks, *keys, "__chunk")
    size = F.least(F.lit(PAIR_CHUNK), F.col("n_pairs") - F.col("__chunk") * PAIR_CHUNK).cast("int")
    return dealt.withColumn("__i", F.explode(F.sequence(F.lit(1), size))).select(*keys, *told).withColumns(numbers)


def _unlike(a: str, b: str, numeric: bool, null_aware: bool) -> Column:
    """Whether ``diff_text`` tells a difference, without writing it out."""
    x, y = (present(c) if numeric else F.col(c) for c in (a, b))
    return differs(x, y) if null_aware else F.coalesce(x != y, F.lit(False))


def pair_counts(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row pairs that a comparison of each key makes: ``rows_first``, ``rows_second`` and ``n_pairs``, without a join."""
    stacked = first.select(*keys, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(
        second.select(*keys, F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    )
    counts = stacked.groupBy(*keys).agg(F.sum("__a").alias("rows_first"), F.sum("__b").alias("rows_second"))
    return counts.withColumn("n_pairs", F.col("rows_first") * F.col("rows_second"))


def with_resolution(diffs: DataFrame) -> DataFrame:
    """Adds the empty column in which the decision is written by hand."""
    return diffs.withColumn("resolved", F.lit(""))


def value_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def quadrat_differences(
    first: DataFrame, second: DataFrame, year: int | None = 2025, pairs: str = "count"
) -> DataFrame:
    """Every shared value column of two prepared quadrat entries."""
    shared = [c for c in value_columns(first, QUADRAT_KEYS) if c in second.columns]
    return with_resolution(
        compare_entries(
            first, second, QUADRAT_KEYS, {c: f"{c}_raw_diff" for c in shared},
            year=year, date_column="survey_date", pairs=pairs,
        )
    )


def quadrat_missing_keys(
    first: DataFrame, second: DataFrame, both: bool = False, each_row: bool = False
) -> DataFrame:
    return missing_keys(first, second, QUADRAT_KEYS, both, each_row)


def size_differences(
    first: DataFrame, second: DataFrame, year: int | None = 2025, pairs: str = "count", unique: bool = True
) -> DataFrame:
    """Counts per species and size. Rows entered twice over count once, whether or not ``prepare_entry`` has dropped them."""
    return compare_entries(
        first, second, SIZE_KEYS, ["count"], year=year, date_column="date", pairs=pairs, unique=unique
    )


def swath_differences(
    first: DataFrame,
    second: DataFrame,
    excluded: str = CANOPY_TAXON,
    report_missing: bool = False,
    pairs: str = "count",
    unique: bool = True,
) -> DataFrame:
    """Stipes, counts and subsample length of all species but one.

    Only keys present in both entries can differ; one-sided keys come only if asked for. Rows entered twice over count once.
    """
    first, second = (d.where(F.col("species") != excluded) for d in (first, second))
    names = {
        "stipe_counts_macrocystis_only": "stipe_diff",
        "count": "count_diff",
        "subsample_meter": "subsample_diff",
    }
    return compare_entries(first, second, SPECIES_KEYS, names, report_missing=report_missing, pairs=pairs, unique=unique)


def entry_totals(
    df: DataFrame, keys: Sequence[str], value: str, n: str = "n_plants", total: str = "total_stipes"
) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n), sum0(value).alias(total))


def swath_total_differences(
    first: DataFrame, second: DataFrame, taxon: str = CANOPY_TAXON, year: int | None = 2025
) -> DataFrame:
    """Plants and stipes of one species per transect, compared null-aware."""
    totals = [
        entry_totals(d.where(F.col("species") == taxon), TRANSECT_KEYS, "stipe_counts_macrocystis_only")
        for d in (first, second)
    ]
    # one row per key on either side, so there is one pair per row and nothing to count
    diffs = compare_entries(
        *totals, TRANSECT_KEYS, ["n_plants", "total_stipes"],
        null_aware=True, year=year, date_column="date",
    )
    return with_resolution(diffs.drop("n_pairs"))


def star_differences(
    first: DataFrame, second: DataFrame, year: int | None = None, pairs: str = "count"
) -> DataFrame:
    """Counts and diets; this sheet has no example row and no year restriction."""
    return with_resolution(
        compare_entries(
            first, second, SIZE_KEYS, ["count", "diet"], year=year, date_column="date", pairs=pairs
        )
    )
