"""Double entry and joins.

The two entries are the lines of either line status: an order line may occur under both, under
one, and several times, with values of its own each time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.registry import query, rounded, sql_differ, text_of
from fieldspark.operators.joins import join_suffix, keep_members
from fieldspark.plans import double_entry as de


def _lines(t):
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))


_SITE_TYPE = "CASE WHEN l_linenumber > 4 THEN NULL ELSE 'BAR' END"
_ZONE = "CASE WHEN l_linenumber IN (1, 3, 5, 7) THEN 'shallow' ELSE 'deep' END"


def _quadrats(t, status):
    raw = _lines(t).where(F.col("l_linestatus") == status).select(
        F.concat(F.lit("REC"), text_of("l_orderkey")).alias("site"),
        F.expr(_SITE_TYPE).alias("site_type"),
        F.expr(_ZONE).alias("zone"),
        text_of(F.to_date("o_orderdate")).alias("survey_date"),
        text_of("l_linenumber").alias("transect"),
        F.concat(text_of("l_linenumber"), F.lit("R")).alias("quadrat"),
        F.col("l_returnflag").alias("substrate"),
        F.lit("none").alias("drift_superlayer"),
        F.col("l_quantity").alias("purple"),
        F.nullif("l_discount", F.lit(0.0)).alias("cover"),
        F.col("o_orderpriority").alias("notes"),
    )
    return de.prepare_entry(raw, de.QUADRAT_TYPES, example_row=False, side_column="quadrat")


_QUADRATS = f"""
  q AS (SELECT l_linestatus, 'REC_' || l_orderkey AS site, {_SITE_TYPE} AS site_type, {_ZONE} AS zone,
               CAST(o_orderdate AS DATE) AS survey_date, CAST(l_linenumber AS DOUBLE) AS transect,
               CAST(l_linenumber AS DOUBLE) AS quadrat, l_returnflag AS substrate,
               l_quantity AS purple, nullif(l_discount, 0) AS cover
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  a AS (SELECT * FROM q WHERE l_linestatus = 'F'),
  b AS (SELECT * FROM q WHERE l_linestatus = 'O')"""


def _same(keys):
    return " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)


def _keys(keys):
    return ", ".join(f"a.{k}" for k in keys)


@query(
    "double_entry_diff",
    f"""WITH {_QUADRATS},
         d AS (SELECT {_keys(de.QUADRAT_KEYS)},
                 {sql_differ('a.substrate', 'b.substrate', False)} AS substrate_raw_diff,
                 CAST(NULL AS VARCHAR) AS drift_superlayer_raw_diff,
                 {sql_differ('a.purple', 'b.purple')} AS purple_raw_diff,
                 {sql_differ('a.cover', 'b.cover')} AS cover_raw_diff
               FROM a JOIN b ON {_same(de.QUADRAT_KEYS)} WHERE year(a.survey_date) = 1997)
       SELECT *, count(*) AS n_pairs, '' AS resolved FROM d
       WHERE coalesce(substrate_raw_diff, purple_raw_diff, cover_raw_diff) IS NOT NULL GROUP BY ALL""",
)
def double_entry_diff(t):
    return de.quadrat_differences(_quadrats(t, "F"), _quadrats(t, "O"), year=1997)


@query(
    "double_entry_rows",
    f"""WITH {_QUADRATS},
         d AS (SELECT {_keys(de.QUADRAT_KEYS)},
                 {sql_differ('a.substrate', 'b.substrate', False)} AS substrate_raw_diff,
                 CAST(NULL AS VARCHAR) AS drift_superlayer_raw_diff,
                 {sql_differ('a.purple', 'b.purple')} AS purple_raw_diff,
                 {sql_differ('a.cover', 'b.cover')} AS cover_raw_diff
               FROM a JOIN b ON {_same(de.QUADRAT_KEYS)} WHERE year(a.survey_date) = 1997)
       SELECT *, '' AS resolved FROM d
       WHERE coalesce(substrate_raw_diff, purple_raw_diff, cover_raw_diff) IS NOT NULL""",
)
def double_entry_rows(t):
    return de.quadrat_differences(_quadrats(t, "F"), _quadrats(t, "O"), year=1997, pairs="rows")


_MISSING = f"""WITH {_QUADRATS},
  m AS (SELECT {_keys(de.QUADRAT_KEYS)}, 'second' AS missing_in FROM a
        WHERE NOT EXISTS (SELECT 1 FROM b WHERE {_same(de.QUADRAT_KEYS)})
        UNION ALL
        SELECT {_keys(de.QUADRAT_KEYS).replace('a.', 'b.')}, 'first' FROM b
        WHERE NOT EXISTS (SELECT 1 FROM a WHERE {_same(de.QUADRAT_KEYS)}))"""


@query("missing_keys", f"{_MISSING} SELECT *, count(*) AS n_rows FROM m GROUP BY ALL")
def missing(t):
    return de.quadrat_missing_keys(_quadrats(t, "F"), _quadrats(t, "O"), both=True)


@query("missing_key_rows", f"{_MISSING} SELECT * EXCLUDE (missing_in) FROM m WHERE missing_in = 'second'")
def missing_rows(t):
    return de.quadrat_missing_keys(_quadrats(t, "F"), _quadrats(t, "O"), each_row=True)


def _species_rows(t, status, types, unique=False, **extra):
    raw = _lines(t).where(F.col("l_linestatus") == status).select(
        F.concat(F.lit("REC"), text_of("l_orderkey")).alias("site"),
        F.expr(_SITE_TYPE).alias("site_type"),
        F.expr(_ZONE).alias("zone"),
        text_of(F.to_date("o_orderdate")).alias("date"),
        text_of("l_linenumber").alias("transect"),
        F.lit(None).cast("string").alias("depth"),
        F.lit("m").alias("depth_units"),
        F.col("l_returnflag").alias("species"),
        text_of("l_quantity").alias("count"),
        *[c.alias(n) for n, c in extra.items()],
    )
    return de.prepare_entry(raw, types, example_row=False, unique=unique)


_SPECIES = f"""
  q AS (SELECT l_linestatus, 'REC_' || l_orderkey AS site, {_SITE_TYPE} AS site_type, {_ZONE} AS zone,
               CAST(o_orderdate AS DATE) AS date, CAST(l_linenumber AS DOUBLE) AS transect,
               CAST(NULL AS DOUBLE) AS depth, 'm' AS depth_units, l_returnflag AS species,
               CAST(l_linenumber AS DOUBLE) AS size, l_quantity AS count,
               nullif(l_tax, 0) * 100 AS stipes, l_discount AS subsample, CAST(l_suppkey AS VARCHAR) AS diet
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


@query(
    "distinct_entry_diff",
    f"""WITH {_SPECIES},
         a AS (SELECT DISTINCT {', '.join(de.SIZE_KEYS)}, count FROM q WHERE l_linestatus = 'F'),
         b AS (SELECT DISTINCT {', '.join(de.SIZE_KEYS)}, count FROM q WHERE l_linestatus = 'O'),
         d AS (SELECT {_keys(de.SIZE_KEYS)}, {sql_differ('a.count', 'b.count')} AS count_diff
               FROM a JOIN b ON {_same(de.SIZE_KEYS)})
       SELECT *, count(*) AS n_pairs FROM d
       WHERE count_diff IS NOT NULL AND year(date) = 1998 GROUP BY ALL""",
)
def distinct_entry_diff(t):
    entries = [_species_rows(t, s, de.SIZE_TYPES, size=text_of("l_linenumber")) for s in "FO"]
    return de.size_differences(*entries, year=1998)


def _swaths(t, unique=False):
    return [
        _species_rows(
            t, s, de.SWATH_TYPES, unique,
            stipe_counts_macrocystis_only=text_of(F.nullif("l_tax", F.lit(0.0)) * 100),
            subsample_meter=text_of("l_discount"),
        )
        for s in "FO"
    ]


_SWATHS = f"""{_SPECIES},
  a AS (SELECT DISTINCT {', '.join(de.SPECIES_KEYS)}, stipes, count, subsample FROM q WHERE l_linestatus = 'F'),
  b AS (SELECT DISTINCT {', '.join(de.SPECIES_KEYS)}, stipes, count, subsample FROM q WHERE l_linestatus = 'O')"""
_SWATH_DIFFS = f"""{sql_differ('a.stipes', 'b.stipes')} AS stipe_diff,
  {sql_differ('a.count', 'b.count')} AS count_diff, {sql_differ('a.subsample', 'b.subsample')} AS subsample_diff"""


@query(
    "full_join_diff",
    f"""WITH {_SWATHS},
         d AS (SELECT {_keys(de.SPECIES_KEYS)}, {_SWATH_DIFFS}
               FROM a JOIN b ON {_same(de.SPECIES_KEYS)} WHERE a.species <> 'N')
       SELECT *, count(*) AS n_pairs FROM d
       WHERE coalesce(stipe_diff, count_diff, subsample_diff) IS NOT NULL GROUP BY ALL""",
)
def full_join_diff(t):
    return de.swath_differences(*_swaths(t), excluded="N")


@query(
    "full_join_diff_missing",
    f"""WITH {_SWATHS},
         d AS (SELECT {', '.join(f'coalesce(a.{k}, b.{k}) AS {k}' for k in de.SPECIES_KEYS)}, {_SWATH_DIFFS},
                 CASE WHEN b.site IS NULL THEN 'second' WHEN a.site IS NULL THEN 'first' END AS missing_in
               FROM (SELECT * FROM a WHERE species <> 'N') a
               FULL JOIN (SELECT * FROM b WHERE species <> 'N') b ON {_same(de.SPECIES_KEYS)})
       SELECT *, count(*) AS n_pairs FROM d
       WHERE coalesce(stipe_diff, count_diff, subsample_diff, missing_in) IS NOT NULL GROUP BY ALL""",
)
def full_join_diff_missing(t):
    return de.swath_differences(*_swaths(t), excluded="N", report_missing=True)


@query(
    "grouped_entry_diff",
    f"""WITH {_SWATHS},
         x AS (SELECT {', '.join(de.TRANSECT_KEYS)}, count(*) AS n, coalesce(sum(stipes), 0) AS s
               FROM a WHERE species = 'R' GROUP BY ALL),
         y AS (SELECT {', '.join(de.TRANSECT_KEYS)}, count(*) AS n, coalesce(sum(stipes), 0) AS s
               FROM b WHERE species = 'R' GROUP BY ALL),
         d AS (SELECT {_keys(de.TRANSECT_KEYS)},
                 CASE WHEN a.n IS DISTINCT FROM b.n THEN a.n || ' ≠ ' || b.n END AS n_plants_diff,
                 {sql_differ('a.s', 'b.s')} AS total_stipes_diff
               FROM x a JOIN y b ON {_same(de.TRANSECT_KEYS)} WHERE year(a.date) = 1999)
       SELECT *, '' AS resolved FROM d WHERE coalesce(n_plants_diff, total_stipes_diff) IS NOT NULL""",
)
def grouped_entry_diff(t):
    return de.swath_total_differences(*_swaths(t, unique=True), taxon="R", year=1999)


@query(
    "two_field_diff",
    f"""WITH {_SPECIES},
         a AS (SELECT * FROM q WHERE l_linestatus = 'F'),
         b AS (SELECT * FROM q WHERE l_linestatus = 'O'),
         d AS (SELECT {_keys(de.SIZE_KEYS)}, {sql_differ('a.count', 'b.count')} AS count_diff,
                 {sql_differ('a.diet', 'b.diet', False)} AS diet_diff
               FROM a JOIN b ON {_same(de.SIZE_KEYS)})
       SELECT *, count(*) AS n_pairs, '' AS resolved FROM d
       WHERE coalesce(count_diff, diet_diff) IS NOT NULL GROUP BY ALL""",
)
def two_field_diff(t):
    entries = [
        _species_rows(t, s, de.STAR_TYPES, size=text_of("l_linenumber"), diet=text_of("l_suppkey"))
        for s in "FO"
    ]
    return de.star_differences(*entries)


@query(
    "entry_totals",
    """SELECT l_orderkey, l_linestatus, count(*) AS n_plants,
              round(coalesce(sum(nullif(l_tax, 0)), 0), 6) AS total_stipes
       FROM lineitem GROUP BY l_orderkey, l_linestatus""",
)
def totals(t):
    lines = t.lineitem.withColumn("stipes", F.nullif("l_tax", F.lit(0.0)))
    return rounded(de.entry_totals(lines, ["l_orderkey", "l_linestatus"], "stipes"))


@query(
    "join_suffix",
    """WITH c AS (SELECT nullif(c_nationkey, 0) AS k, count(*) AS n, round(avg(c_acctbal), 4) AS acctbal
                  FROM customer GROUP BY 1),
            s AS (SELECT nullif(s_nationkey, 0) AS k, count(*) AS n, round(avg(s_acctbal), 4) AS acctbal,
                         max(s_name) AS last_name FROM supplier GROUP BY 1)
       SELECT c.k AS nationkey, c.n AS n_kelp, c.acctbal AS acctbal_kelp, s.n AS n_quad,
              s.acctbal AS acctbal_quad, s.last_name
       FROM c JOIN s ON c.k IS NOT DISTINCT FROM s.k""",
)
def suffixed(t):
    customers = t.customer.groupBy(F.nullif("c_nationkey", F.lit(0)).alias("nationkey")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 4).alias("acctbal")
    )
    suppliers = t.supplier.groupBy(F.nullif("s_nationkey", F.lit(0)).alias("nation")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("s_acctbal"), 4).alias("acctbal"),
        F.max("s_name").alias("last_name"),
    )
    return join_suffix(customers, suppliers, [("nationkey", "nation")], suffix=("_kelp", "_quad"))


@query(
    "semi_filter",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE'))""",
)
def semi_filter(t):
    chosen = F.col("c_mktsegment").isin("MACHINERY", "FURNITURE")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return keep_members(orders, t.customer, ("o_custkey", "c_custkey"), chosen)
