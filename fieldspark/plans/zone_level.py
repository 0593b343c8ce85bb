"""Zone level: density, sizes, simulated individuals, biomass, gonad mass and patch labels."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.fixed_values import (
    BIOMASS_COEFFICIENTS,
    DISSECTION_HEAVY_AND_SMALL,
    DISSECTION_LIGHT_AND_LARGE,
    DISSECTION_MASS_LIMIT_G,
    DISSECTION_SPECIES,
    SIZE_SPECIES,
    ZONE_AREA_M2,
)
from fieldspark.functions.models import biomass_g
from fieldspark.functions.nulls import deviation, mean, present, ratio, standard_error, sum0
from fieldspark.operators.aggregates import numeric_means
from fieldspark.operators.joins import join_suffix
from fieldspark.operators.reshape import pivot_stats
from fieldspark.operators.sampling import weighted_sample

ZONE_KEYS = ["site", "site_type", "zone", "year"]
VISIT_KEYS = ["site", "site_type", "latitude", "longitude", "zone", "survey_date"]


def with_year(df: DataFrame, day: str = "survey_date") -> DataFrame:
    return df.withColumn("year", F.year(day))


def dissection_summary(
    dissection: DataFrame,
    keys: Sequence[str] = ("year", "site_official", "site_type_official", "zone"),
    species: Sequence[str] | None = tuple(DISSECTION_SPECIES),
    keep: Sequence[str] = ("purple_urchin",),
) -> DataFrame:
    """Gonad index mean, deviation and count by zone and year, one column set per kept species.

    Zones in which only another of ``species`` was dissected keep their row; None takes all species.
    """
    if species is not None:
        dissection = dissection.where(F.col("species").isin(list(species)))
    stats = {
        "sd_gonad_index": deviation("gonad_index"),
        "mean_gonad_index": mean("gonad_index"),
        "n": F.nullif(F.count(F.lit(1)), F.lit(0)),
    }
    return pivot_stats(with_year(dissection), list(keys), "species", list(keep), stats)


def zone_density(
    quads: DataFrame,
    keys: Sequence[str] = tuple(ZONE_KEYS),
    value: str = "purple_urchin_densitym2",
    area: float = ZONE_AREA_M2,
) -> DataFrame:
    """Mean density, its error, quadrats and the number scaled up to the zone's area."""
    return (
        quads.groupBy(*keys)
        .agg(
            mean(value).alias("mean_density"),
            standard_error(value).alias("se_density"),
            F.count(F.lit(1)).alias("n_quadrats"),
        )
        .withColumn("total_urchins_zone", F.col("mean_density") * F.lit(area))
    )


def size_distribution(
    sizes: DataFrame,
    keys: Sequence[str] = tuple(ZONE_KEYS),
    size: str = "size_cm",
    count: str = "count",
) -> DataFrame:
    """Share of each size in its zone's count; zones without a count have no rows.

    Zone totals are joined rather than taken over a window, so a large zone is combined
    map-side instead of being gathered in one task.
    """
    per_size = sizes.groupBy(*keys, size).agg(sum0(count).alias("count"))
    totals = per_size.groupBy(*keys).agg(F.sum("count").alias("__total"))
    return (
        join_suffix(per_size, totals, keys)
        .withColumn("prob", ratio("count", "__total"))
        .where(F.col("prob") > 0)
        .drop("__total")
    )


def purple_sizes(size_freq: DataFrame, species: str = SIZE_SPECIES) -> DataFrame:
    return with_year(size_freq).where(F.col("species") == species)


def fallback_distribution(distribution: DataFrame, size: str = "size_cm") -> DataFrame:
    """Share of each size over all zones; the grand total is a one-value subquery."""
    per_size = distribution.groupBy(size).agg(F.sum("count").alias("__count"))
    grand = per_size.agg(F.sum("__count")).scalar()
    return per_size.select(size, ratio(F.col("__count"), grand).alias("prob"))


def simulate_sizes(
    density: DataFrame,
    distribution: DataFrame,
    fallback: DataFrame,
    keys: Sequence[str] = tuple(ZONE_KEYS),
    size: str = "size_cm",
    uniform: Callable[[Column], Column] | None = None,
    seed: int = 1985,
) -> DataFrame:
    """One row per simulated individual of each zone."""
    return weighted_sample(
        density, distribution, keys, "total_urchins_zone", size, "prob",
        fallback=fallback, uniform=uniform, seed=seed,
    )


def individual_biomass(
    individuals: DataFrame, size_cm: str = "size_cm", coefficients=BIOMASS_COEFFICIENTS
) -> DataFrame:
    return individuals.withColumn("test_diameter_mm", F.col(size_cm) * 10).withColumn(
        "biomass_g", biomass_g("test_diameter_mm", coefficients)
    )


def site_biomass(individuals: DataFrame, keys: Sequence[str] = tuple(ZONE_KEYS)) -> DataFrame:
    return individuals.groupBy(*keys).agg(
        F.sum(present("biomass_g")).alias("total_biomass_g"),
        F.count(F.lit(1)).alias("n_biomass"),
        deviation("biomass_g").alias("sd_biomass"),
    )


def gonad_summary(dissections: DataFrame) -> DataFrame:
    """The dissection summary under the names used from here on."""
    return dissections.withColumnsRenamed(
        {
            "site_official": "site",
            "site_type_official": "site_type",
            "mean_gonad_index_purple_urchin": "mean_gi",
            "sd_gonad_index_purple_urchin": "sd_gi",
            "n_purple_urchin": "n_gi",
        }
    )


def gonad_mass(
    biomass: DataFrame, gonads: DataFrame, keys: Sequence[str] = tuple(ZONE_KEYS)
) -> DataFrame:
    """Gonad mass per individual and zone from biomass and gonad index."""
    joined = join_suffix(biomass, gonads, keys, "left")
    share, spread = F.col("mean_gi") / 100, F.col("sd_gi") / 100
    return joined.withColumn("mean_biomass_g", ratio("total_biomass_g", "n_biomass")).withColumns(
        {
            "mean_gonad_mass_g": share * F.col("mean_biomass_g"),
            "total_gonad_mass_g": share * F.col("total_biomass_g"),
            "se_gonad_mass_g": ratio(spread * F.col("mean_biomass_g"), F.sqrt("n_gi")),
        }
    )


def plausible_dissections(
    dissection: DataFrame,
    species: str = "purple_urchin",
    mass: str = "animal_24hr_mass_g",
    diameter: str = "test_diameter_mm",
) -> DataFrame:
    """Rows fit for the growth model: complete, of one species and without judged outliers."""
    heavy = [(F.col(mass) > m) & (F.col(diameter) < d) for m, d in DISSECTION_HEAVY_AND_SMALL]
    light = [(F.col(mass) < m) & (F.col(diameter) > d) for m, d in DISSECTION_LIGHT_AND_LARGE]
    return dissection.where(
        (F.col("species") == species)
        & F.col(mass).isNotNull()
        & F.col(diameter).isNotNull()
        & (F.col(mass) < DISSECTION_MASS_LIMIT_G)
        & ~reduce(lambda a, b: a | b, heavy + light)
    )


def benthic_average(
    df: DataFrame, keys: Sequence[str] = tuple(VISIT_KEYS), drop: Sequence[str] = ("transect",)
) -> DataFrame:
    """Mean of all numeric columns per visit."""
    return numeric_means(df, keys, drop)


def zone_table(kelp: DataFrame, quads: DataFrame, gonads: DataFrame) -> DataFrame:
    """Kelp and quadrat averages per visit, with the zone's gonad figures of the year.

    Either average has one row per visit already, so their join has as well.
    """
    visits = join_suffix(
        benthic_average(kelp, drop=("transect", "macro_stipe_sd_20m2")),
        benthic_average(quads, drop=("transect", "quadrat")),
        VISIT_KEYS, "inner", ("_kelp", "_quad"),
    )
    return join_suffix(with_year(visits), gonads, ZONE_KEYS, "left")


def site_lookup(
    zones: DataFrame,
    keys: Sequence[str] = ("site", "site_type", "zone"),
    position: Sequence[str] = ("latitude", "longitude"),
) -> DataFrame:
    return zones.select(*keys, *position).distinct()


def label_patches(
    zones: DataFrame,
    transitions: DataFrame,
    keys: Sequence[str] = ("site", "site_type", "zone"),
    day: str = "survey_date",
) -> DataFrame:
    """Adds ``pred_patch``: the patch predicted for the visit's year, missing in other years."""
    labels = transitions.select(*keys, "patch_2024", "patch_2025")
    year = F.year(day)
    return (
        join_suffix(zones, labels, keys, "left")
        .withColumn(
            "pred_patch",
            F.when(year == 2024, F.col("patch_2024")).when(year == 2025, F.col("patch_2025")),
        )
        .drop("patch_2024", "patch_2025")
    )


LEADING = [
    "latitude", "longitude", "survey_date", "year", "site", "site_type", "pred_patch", "patch_cat",
    "zone", "total_biomass_g", "n_biomass", "sd_biomass", "sd_gi", "mean_gi", "n_gi",
    "mean_biomass_g", "mean_gonad_mass_g", "total_gonad_mass_g", "se_gonad_mass_g",
]


def tidy_zones(labelled: DataFrame, leading: Sequence[str] = tuple(LEADING)) -> DataFrame:
    """Season label, patch falling back to the site type, main columns first."""
    out = (
        labelled.withColumn(
            "patch_cat",
            F.when(F.year("survey_date") == 2024, "predicted 2024")
            .when(F.col("survey_date").isNotNull(), "predicted 2025"),
        )
        .withColumn("pred_patch", F.coalesce("pred_patch", "site_type"))
        .where(F.col("pred_patch").isNotNull())
    )
    front = [c for c in leading if c in out.columns]
    return out.select(*front, *[c for c in out.columns if c not in front])
