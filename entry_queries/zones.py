"""Zone-level biology over the order lines: suppliers are sites, lines are quadrats or animals."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.registry import query, rounded, text_of
from fieldspark.plans import zone_level as zl

_ZONES = """z AS (SELECT l_suppkey AS site, l_returnflag AS site_type, l_linestatus AS zone,
  CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_shipdate AS DATE) AS survey_date,
  nullif(l_quantity, 13) / 16 AS density, CAST(l_linenumber AS DOUBLE) AS size_cm, l_quantity AS count,
  CASE WHEN l_discount > 0.095 THEN 'Purple' ELSE 'Red' END AS species, l_tax, l_extendedprice FROM lineitem)"""
_K = "site, site_type, zone, year"


def _zones(t):
    return zl.with_year(
        t.lineitem.select(
            F.col("l_suppkey").alias("site"),
            F.col("l_returnflag").alias("site_type"),
            F.col("l_linestatus").alias("zone"),
            F.to_date("l_shipdate").alias("survey_date"),
            (F.nullif("l_quantity", F.lit(13.0)) / 16).alias("density"),
            F.col("l_linenumber").cast("double").alias("size_cm"),
            F.col("l_quantity").alias("count"),
            F.when(F.col("l_discount") > 0.095, "Purple").otherwise("Red").alias("species"),
            "l_tax",
            "l_extendedprice",
        )
    )


_DENSITY = f"""density AS (SELECT {_K}, avg(density) AS mean_density,
    stddev_samp(density) / sqrt(count(*)) AS se_density, count(*) AS n_quadrats,
    avg(density) * 80 AS total_urchins_zone FROM z GROUP BY ALL)"""


def _density(t):
    return zl.zone_density(_zones(t), value="density")


@query(
    "zone_density",
    f"""WITH {_ZONES}, {_DENSITY} SELECT {_K}, round(mean_density, 6) AS mean_density,
        round(se_density, 6) AS se_density, n_quadrats, round(total_urchins_zone, 6) AS total_urchins_zone FROM density""",
)
def zone_density(t):
    return rounded(_density(t))


_DIST = f"""per_size AS (SELECT {_K}, size_cm, coalesce(sum(count), 0) AS count FROM z WHERE species = 'Purple' GROUP BY ALL),
  dist AS (SELECT * FROM (SELECT *, count / nullif(sum(count) OVER (PARTITION BY {_K}), 0) AS prob FROM per_size)
           WHERE prob > 0),
  fallback AS (SELECT size_cm, sum(count) / (SELECT sum(count) FROM dist) AS prob FROM dist GROUP BY size_cm)"""


def _dist(t):
    return zl.size_distribution(zl.purple_sizes(_zones(t)))


@query(
    "size_distribution",
    f"WITH {_ZONES}, {_DIST} SELECT {_K}, size_cm, count, round(prob, 6) AS prob FROM dist",
)
def size_distribution(t):
    return rounded(_dist(t))


@query("fallback_distribution", f"WITH {_ZONES}, {_DIST} SELECT size_cm, round(prob, 6) AS prob FROM fallback")
def fallback_distribution(t):
    return rounded(zl.fallback_distribution(_dist(t)))


def _uniform(i):
    """A number both engines can compute from zone and draw."""
    seed = (
        F.col("site") * 7919 + F.ascii("site_type").cast("bigint") * 15485863 + F.ascii("zone").cast("bigint") * 32452843
        + F.col("year").cast("bigint") * 49979687 + i * 104729
    )
    return F.pmod(seed * 48271, F.lit(2147483647)) / F.lit(2147483647.0)


_DRAWS = f"""{_ZONES}, {_DENSITY}, {_DIST},
  units AS (SELECT {_K}, size_cm, greatest(CAST(round_even(prob * 1099511627776, 0) AS BIGINT), 1) AS u FROM dist),
  own AS (SELECT *, coalesce(sum(u) OVER (PARTITION BY {_K} ORDER BY size_cm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
            sum(u) OVER (PARTITION BY {_K}) AS total FROM units),
  gunits AS (SELECT size_cm, greatest(CAST(round_even(prob * 1099511627776, 0) AS BIGINT), 1) AS u FROM fallback),
  overall AS (SELECT *, coalesce(sum(u) OVER (ORDER BY size_cm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b,
             sum(u) OVER () AS total FROM gunits),
  totals AS (SELECT {_K}, max(total) AS own_total FROM own GROUP BY ALL),
  wanted AS (SELECT d.site, d.site_type, d.zone, d.year, CAST(round_even(total_urchins_zone, 0) AS BIGINT) AS n, own_total
             FROM density d LEFT JOIN totals t ON d.site = t.site AND d.site_type = t.site_type AND d.zone = t.zone AND d.year = t.year),
  draws AS (SELECT {_K}, own_total, i AS draw,
              ((site * 7919 + CAST(ascii(site_type) AS BIGINT) * 15485863 + CAST(ascii(zone) AS BIGINT) * 32452843 + CAST(year AS BIGINT) * 49979687 + i * 104729)
               * 48271 % 2147483647) / 2147483647.0::DOUBLE AS r
            FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM wanted WHERE n >= 1)),
  sim AS (
    SELECT d.site, d.site_type, d.zone, d.year, draw, size_cm FROM draws d
    JOIN own o ON d.site = o.site AND d.site_type = o.site_type AND d.zone = o.zone AND d.year = o.year
      AND floor(r * own_total) >= b AND floor(r * own_total) < b + u WHERE own_total IS NOT NULL
    UNION ALL
    SELECT d.site, d.site_type, d.zone, d.year, draw, size_cm FROM draws d
    JOIN overall o ON floor(r * total) >= b AND floor(r * total) < b + u WHERE own_total IS NULL)"""


def _individuals(t):
    dist = _dist(t)
    return zl.simulate_sizes(_density(t), dist, zl.fallback_distribution(dist), uniform=_uniform)


@query(
    "weighted_sample",
    f"WITH {_DRAWS} SELECT {_K}, size_cm, count(*) AS n, CAST(sum(draw) AS BIGINT) AS draws FROM sim GROUP BY ALL",
)
def weighted_sample(t):
    return _individuals(t).groupBy(*zl.ZONE_KEYS, "size_cm").agg(
        F.count(F.lit(1)).alias("n"), F.sum("draw").alias("draws")
    )


_MASS = "greatest(-14.2 + 7.44 * exp(0.041 * (size_cm * 10)), 0.5)"


@query(
    "biomass_model",
    f"""WITH {_DRAWS} SELECT {_K}, round(sum({_MASS}), 4) AS total_biomass_g, count(*) AS n_biomass,
        round(stddev_samp({_MASS}), 4) AS sd_biomass FROM sim GROUP BY ALL""",
)
def biomass_model(t):
    return rounded(zl.site_biomass(zl.individual_biomass(_individuals(t))), 4)


@query(
    "group_stats",
    f"""WITH {_ZONES} SELECT {_K}, round(sum({_MASS}), 4) AS total_biomass_g, count(*) AS n_biomass,
        round(stddev_samp({_MASS}), 4) AS sd_biomass FROM z GROUP BY ALL""",
)
def group_stats(t):
    return rounded(zl.site_biomass(zl.individual_biomass(_zones(t))), 4)


# --- dissections ----------------------------------------------------------------------------------
_DISSECTIONS = """dis AS (SELECT CAST(l_shipdate AS DATE) AS survey_date, l_suppkey AS site_official,
  CASE WHEN l_tax > 0.035 THEN 'A' ELSE 'N' END AS site_type_official, l_linestatus AS zone,
  CASE l_returnflag WHEN 'A' THEN 'purple_urchin' ELSE 'red_urchin' END AS species,
  nullif(l_discount, 0) * 100 AS gonad_index, l_quantity AS test_diameter_mm,
  CASE WHEN l_linenumber < 7 THEN l_extendedprice / 1000 END AS animal_24hr_mass_g, l_orderkey FROM lineitem)"""


def _dissections(t):
    return t.lineitem.select(
        F.to_date("l_shipdate").alias("survey_date"),
        F.col("l_suppkey").alias("site_official"),
        F.when(F.col("l_tax") > 0.035, "A").otherwise("N").alias("site_type_official"),
        F.col("l_linestatus").alias("zone"),
        F.when(F.col("l_returnflag") == "A", "purple_urchin").otherwise("red_urchin").alias("species"),
        (F.nullif("l_discount", F.lit(0.0)) * 100).alias("gonad_index"),
        F.col("l_quantity").alias("test_diameter_mm"),
        F.when(F.col("l_linenumber") < 7, F.col("l_extendedprice") / 1000).alias("animal_24hr_mass_g"),
        "l_orderkey",
    )


@query(
    "outlier_filter",
    f"""WITH {_DISSECTIONS} SELECT l_orderkey, test_diameter_mm, animal_24hr_mass_g FROM dis
        WHERE species = 'purple_urchin' AND animal_24hr_mass_g < 100 AND test_diameter_mm IS NOT NULL
          AND NOT (animal_24hr_mass_g > 20 AND test_diameter_mm < 30)
          AND NOT (animal_24hr_mass_g > 38 AND test_diameter_mm < 40)
          AND NOT (animal_24hr_mass_g < 20 AND test_diameter_mm > 45)""",
)
def outlier_filter(t):
    return zl.plausible_dissections(_dissections(t)).select(
        "l_orderkey", "test_diameter_mm", "animal_24hr_mass_g"
    )


_PIVOT = f"""piv AS (SELECT CAST(year(survey_date) AS INTEGER) AS year, site_official, site_type_official, zone,
    stddev_samp(gonad_index) FILTER (WHERE species = 'purple_urchin') AS sd_gonad_index_purple_urchin,
    avg(gonad_index) FILTER (WHERE species = 'purple_urchin') AS mean_gonad_index_purple_urchin,
    nullif(count(*) FILTER (WHERE species = 'purple_urchin'), 0) AS n_purple_urchin
  FROM dis GROUP BY ALL)"""


@query(
    "pivot_stats",
    f"""WITH {_DISSECTIONS}, {_PIVOT} SELECT year, site_official, site_type_official, zone,
        round(sd_gonad_index_purple_urchin, 6) AS sd_gonad_index_purple_urchin,
        round(mean_gonad_index_purple_urchin, 6) AS mean_gonad_index_purple_urchin, n_purple_urchin FROM piv""",
)
def pivot_stats(t):
    return rounded(zl.dissection_summary(_dissections(t)))


_GONADS = f"""{_ZONES}, {_DISSECTIONS}, {_PIVOT},
  mass AS (SELECT {_K}, sum({_MASS}) AS total_biomass_g, count(*) AS n_biomass, stddev_samp({_MASS}) AS sd_biomass
           FROM z GROUP BY ALL),
  gon AS (
    SELECT m.*, sd_gonad_index_purple_urchin AS sd_gi, mean_gonad_index_purple_urchin AS mean_gi, n_purple_urchin AS n_gi,
      total_biomass_g / n_biomass AS mean_biomass_g,
      mean_gonad_index_purple_urchin / 100 * (total_biomass_g / n_biomass) AS mean_gonad_mass_g,
      mean_gonad_index_purple_urchin / 100 * total_biomass_g AS total_gonad_mass_g,
      sd_gonad_index_purple_urchin / 100 * (total_biomass_g / n_biomass) / sqrt(n_purple_urchin) AS se_gonad_mass_g
    FROM mass m LEFT JOIN piv p ON m.site = p.site_official AND m.site_type = p.site_type_official
      AND m.zone = p.zone AND m.year = p.year)"""
_GON_COLUMNS = [
    "total_biomass_g", "sd_biomass", "sd_gi", "mean_gi", "mean_biomass_g",
    "mean_gonad_mass_g", "total_gonad_mass_g", "se_gonad_mass_g",
]


def _gonads(t):
    biomass = zl.site_biomass(zl.individual_biomass(_zones(t)))
    return zl.gonad_mass(biomass, zl.gonad_summary(zl.dissection_summary(_dissections(t))))


@query(
    "derived_metrics",
    f"""WITH {_GONADS} SELECT {_K}, n_biomass, n_gi,
        {', '.join(f'round({c}, 6) AS {c}' for c in _GON_COLUMNS)} FROM gon""",
)
def derived_metrics(t):
    return rounded(_gonads(t), 6)


# --- benthic averages and patch labels --------------------------------------------------------------
_VISIT = """l_suppkey AS site, l_returnflag AS site_type, CAST(l_suppkey AS DOUBLE) / 10 AS latitude,
  CAST(NULL AS DOUBLE) AS longitude, CASE WHEN l_tax > 0.035 THEN 'F' ELSE 'O' END AS zone,
  CAST(date_trunc('year', l_shipdate) AS DATE) AS survey_date, CAST(l_linenumber AS DOUBLE) AS transect"""


def _visits(t, status):
    return t.lineitem.where(F.col("l_linestatus") == status).select(
        F.col("l_suppkey").alias("site"), F.col("l_returnflag").alias("site_type"),
        (F.col("l_suppkey").cast("double") / 10).alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.when(F.col("l_tax") > 0.035, "F").otherwise("O").alias("zone"),
        F.trunc(F.to_date("l_shipdate"), "year").alias("survey_date"),
        F.col("l_linenumber").cast("double").alias("transect"),
        "l_quantity", "l_extendedprice", "l_discount",
    )


def _kelp(t):
    return _visits(t, "F").select(
        *zl.VISIT_KEYS, "transect", F.col("l_quantity").alias("stipes"),
        F.col("l_discount").alias("cover"), F.col("l_extendedprice").alias("macro_stipe_sd_20m2"),
    )


def _quads(t):
    return _visits(t, "O").select(
        *zl.VISIT_KEYS, "transect", F.col("transect").alias("quadrat"),
        F.col("l_discount").alias("cover"), F.col("l_quantity").alias("purple_urchin_densitym2"),
    )


@query(
    "numeric_means",
    f"""SELECT site, site_type, latitude, longitude, zone, survey_date, round(avg(l_quantity), 6) AS stipes,
          round(avg(l_discount), 6) AS cover, round(avg(l_extendedprice), 6) AS macro_stipe_sd_20m2
        FROM (SELECT {_VISIT}, l_quantity, l_discount, l_extendedprice FROM lineitem WHERE l_linestatus = 'F')
        GROUP BY ALL""",
)
def numeric_means(t):
    return rounded(zl.benthic_average(_kelp(t)), 6, "stipes", "cover", "macro_stipe_sd_20m2")


_ZONE_TABLE = f"""{_GONADS},
  kelp AS (SELECT site, site_type, latitude, longitude, zone, survey_date, avg(l_quantity) AS stipes, avg(l_discount) AS cover
           FROM (SELECT {_VISIT}, l_quantity, l_discount FROM lineitem WHERE l_linestatus = 'F') GROUP BY ALL),
  quad AS (SELECT site, site_type, latitude, longitude, zone, survey_date, avg(l_discount) AS cover,
             avg(l_quantity) AS purple_urchin_densitym2
           FROM (SELECT {_VISIT}, l_quantity, l_discount FROM lineitem WHERE l_linestatus = 'O') GROUP BY ALL),
  zt AS (
    SELECT k.site, k.site_type, k.latitude, k.longitude, k.zone, k.survey_date, k.stipes, k.cover AS cover_kelp,
           q.cover AS cover_quad, q.purple_urchin_densitym2, CAST(year(k.survey_date) AS INTEGER) AS year,
           g.total_biomass_g, g.n_biomass, g.sd_biomass, g.sd_gi, g.mean_gi, g.n_gi, g.mean_biomass_g,
           g.mean_gonad_mass_g, g.total_gonad_mass_g, g.se_gonad_mass_g
    FROM kelp k JOIN quad q ON k.site = q.site AND k.site_type = q.site_type AND k.zone = q.zone
      AND k.latitude IS NOT DISTINCT FROM q.latitude AND k.longitude IS NOT DISTINCT FROM q.longitude
      AND k.survey_date = q.survey_date
    LEFT JOIN gon g ON k.site = g.site AND k.site_type = g.site_type AND k.zone = g.zone
      AND year(k.survey_date) = g.year)"""
_ZT_ROUND = ["stipes", "cover_kelp", "cover_quad", "purple_urchin_densitym2", *_GON_COLUMNS]


def _zone_table(t):
    return zl.zone_table(_kelp(t), _quads(t), _gonads(t))


@query(
    "zone_table",
    f"""WITH {_ZONE_TABLE} SELECT site, site_type, latitude, longitude, zone, survey_date, year, n_biomass, n_gi,
        {', '.join(f'round({c}, 6) AS {c}' for c in _ZT_ROUND)} FROM zt""",
)
def zone_table(t):
    return rounded(_zone_table(t), 6, *_ZT_ROUND)


@query("site_lookup", f"WITH {_ZONE_TABLE} SELECT DISTINCT site, site_type, zone, latitude, longitude FROM zt")
def site_lookup(t):
    return zl.site_lookup(_zone_table(t))


_LABELS = """tr AS (SELECT s_suppkey AS site, 'A' AS site_type, 'F' AS zone,
    CASE WHEN s_acctbal > 0 THEN 'FOR' ELSE 'BAR' END AS patch_2024, CASE WHEN s_acctbal > 5000 THEN 'INCIP' END AS patch_2025
  FROM supplier)"""


@query(
    "label_by_year",
    f"""WITH {_LABELS}, v AS (
          SELECT CAST(l_suppkey AS DOUBLE) / 10 AS latitude, CAST(NULL AS DOUBLE) AS longitude,
            CAST(l_shipdate + INTERVAL 25 YEAR AS DATE) AS survey_date, l_suppkey AS site,
            CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS site_type, l_linestatus AS zone, l_quantity
          FROM lineitem),
        p AS (SELECT v.*, CASE year(survey_date) WHEN 2024 THEN patch_2024 WHEN 2025 THEN patch_2025 END AS label
              FROM v LEFT JOIN tr ON v.site = tr.site AND v.site_type = tr.site_type AND v.zone = tr.zone)
        SELECT latitude, longitude, survey_date, CAST(year(survey_date) AS INTEGER) AS year, site, site_type,
          coalesce(label, site_type) AS pred_patch,
          CASE WHEN year(survey_date) = 2024 THEN 'predicted 2024' ELSE 'predicted 2025' END AS patch_cat, zone, l_quantity
        FROM p WHERE coalesce(label, site_type) IS NOT NULL""",
)
def label_by_year(t):
    transitions = t.supplier.select(
        F.col("s_suppkey").alias("site"), F.lit("A").alias("site_type"), F.lit("F").alias("zone"),
        F.when(F.col("s_acctbal") > 0, "FOR").otherwise("BAR").alias("patch_2024"),
        F.when(F.col("s_acctbal") > 5000, "INCIP").alias("patch_2025"),
    )
    visits = t.lineitem.select(
        (F.col("l_suppkey").cast("double") / 10).alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.to_date(F.col("l_shipdate") + F.expr("interval 25 years")).alias("survey_date"),
        F.col("l_suppkey").alias("site"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("site_type"),
        F.col("l_linestatus").alias("zone"),
        "l_quantity",
    )
    return zl.tidy_zones(zl.label_patches(zl.with_year(visits), transitions))
