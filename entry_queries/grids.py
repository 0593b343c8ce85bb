"""Grids and temperature series over the order lines: the ship date is time, two measures a box."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from entry_queries.registry import query, rounded
from fieldspark.operators.grid import grid_subset, last_settled_day
from fieldspark.plans import sst

BOX = {"l_quantity": (10.0, 40.0), "l_discount": (0.015, 0.085)}
_INSIDE = "l_quantity BETWEEN 10 AND 40 AND l_discount BETWEEN 0.015 AND 0.085"
_DAILY = f"""daily AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(year(l_shipdate) AS INTEGER) AS year,
  CAST(dayofyear(l_shipdate) AS INTEGER) AS doy, avg(l_extendedprice) AS anom_mean
  FROM lineitem WHERE {_INSIDE} GROUP BY ALL)"""


@query(
    "grid_subset",
    f"""SELECT l_shipdate, l_quantity, l_discount, l_extendedprice FROM lineitem WHERE {_INSIDE}
        AND CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1999-12-27'""",
)
def subset(t):
    return grid_subset(
        t.lineitem, BOX, "l_shipdate", date(1996, 3, 1), last_settled_day(date(2000, 1, 1)),
        ["l_shipdate", "l_quantity", "l_discount", "l_extendedprice"],
    )


def daily_mean(t, years=()):
    return sst.daily_regional_mean(t.lineitem, BOX, "l_shipdate", "l_extendedprice", years=years)


@query(
    "daily_regional_mean",
    f"WITH {_DAILY} SELECT date, year, doy, round(anom_mean, 6) AS anom_mean FROM daily",
)
def daily_regional_mean(t):
    return rounded(daily_mean(t, years=range(1995, 2002)), 6)


@query(
    "climatology",
    f"""WITH {_DAILY} SELECT doy, round(avg(anom_mean), 6) AS anom_mean FROM daily
        WHERE year BETWEEN 1995 AND 1999 GROUP BY doy""",
)
def climatology(t):
    return rounded(sst.climatology(daily_mean(t), range(1995, 2000)), 6)


@query(
    "climatology_excl",
    f"""WITH {_DAILY} SELECT doy, round(avg(anom_mean), 6) AS anom_mean FROM daily
        WHERE year <> 2000 AND doy <= 360 GROUP BY doy""",
)
def climatology_excl(t):
    return rounded(sst.climatology_excluding(daily_mean(t), 2000), 6)


@query(
    "series_align",
    f"""WITH {_DAILY},
      last AS (SELECT max(doy) AS d FROM daily WHERE year = 2001),
      mean AS (SELECT doy, avg(anom_mean) AS anom_mean FROM daily WHERE year BETWEEN 1995 AND 1999 GROUP BY doy),
      rows AS (
        SELECT CAST(year AS VARCHAR) AS line, year, doy, anom_mean, false AS mean_ext FROM daily
          WHERE year IN (1996, 1998, 1997, 2000, 2001)
        UNION ALL SELECT 'Mean (1995–1999)', NULL, doy, anom_mean, false FROM mean
        UNION ALL SELECT 'Mean (1995–1999)', NULL, doy, anom_mean, true FROM mean)
      SELECT line, CAST(CASE line WHEN 'Mean (1995–1999)' THEN 1 WHEN '1997' THEN 2 WHEN '1996' THEN 3
               WHEN '1998' THEN 4 WHEN '2000' THEN 5 ELSE 6 END AS INTEGER) AS line_rank,
             year, doy, round(anom_mean, 6) AS anom_mean, mean_ext,
             CAST(CASE WHEN line = '2001' OR mean_ext THEN doy + 365 ELSE doy END AS INTEGER) AS xplot
      FROM rows, last
      WHERE (line <> '2001' AND NOT mean_ext AND doy BETWEEN 150 AND 365)
         OR (line = '2001' AND doy <= d) OR (mean_ext AND doy <= d)""",
)
def series_align(t):
    series = sst.aligned_series(
        daily_mean(t), faint=[1996, 1998], highlight=1997, last_full=2000, continuation=2001,
        baseline=range(1995, 2000),
    )
    return rounded(series, 6)


@query(
    "grid_stride",
    """SELECT CAST(l_shipdate AS DATE) AS date, 32 + l_quantity / 100 AS lat_dd, -130 + l_linenumber / 100.0::DOUBLE AS long_dd,
              l_tax AS sst_anom_c, l_linenumber AS mask
       FROM lineitem
       WHERE CAST(l_quantity AS BIGINT) % 10 = 0 AND l_linenumber % 2 = 0 AND l_quantity <= 40
         AND CAST(l_shipdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-05-27'""",
)
def grid_stride(t):
    grid = t.lineitem.select(
        F.col("l_shipdate").alias("time"),
        (F.lit(32) + F.col("l_quantity") / 100).alias("latitude"),
        (F.lit(-130) + F.col("l_linenumber") / F.lit(100.0)).alias("longitude"),
        F.col("l_tax").alias("sstAnom"),
        F.col("l_linenumber").alias("mask"),
    )
    return sst.tidy_fine_grid(
        grid, date(2001, 6, 1), {"latitude": (32.0, 32.405), "longitude": (-130.0, -114.0)},
        stride=(1, 10, 2), first=date(1995, 1, 1),
    )
