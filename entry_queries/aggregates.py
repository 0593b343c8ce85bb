"""Plain aggregates, distinct rows and the statistics on large groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.registry import query, rounded
from fieldspark.functions.models import growth, offset_log10
from fieldspark.functions.nulls import deviation, mean, row_sum, standard_error, sum0
from fieldspark.operators import quality
from fieldspark.operators.aggregates import annotation, count_by, last_per_group, profile, summarise
from fieldspark.operators.joins import join_suffix
from fieldspark.operators.statistics import box_summary, fit_growth, fit_quality, histogram
from fieldspark.sources.typing import clean_names


@query(
    "count_sorted",
    """SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL ORDER BY n DESC""",
)
def count_sorted(t):
    return count_by(t.orders, ["o_orderpriority", "o_orderstatus"]).orderBy(F.desc_nulls_last("n"))


@query(
    "distinct_pairs",
    "SELECT DISTINCT l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS day FROM lineitem",
)
def distinct_pairs(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", F.to_date("l_shipdate").alias("day")).distinct()


@query(
    "dup_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def dup_keys(t):
    return quality.dup_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "last_per_group",
    """SELECT user_id, event_type, ts, event_id, day FROM (
         SELECT user_id, event_type, ts, event_id, CASE WHEN value > 1 THEN CAST(ts AS DATE) END AS day FROM events)
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type
                                  ORDER BY day DESC NULLS FIRST, ts DESC NULLS FIRST, event_id DESC) = 1""",
)
def last_event(t):
    events = t.events.select(
        "user_id", "event_type", "ts", "event_id",
        F.when(F.col("value") > 1, F.to_date("ts")).alias("day"),
    )
    return last_per_group(events, ["user_id", "event_type"], ["day", "ts", "event_id"])


@query(
    "box_summary",
    """WITH x AS (SELECT l_returnflag, log10(l_extendedprice + 0.01) AS y FROM lineitem),
            q AS (SELECT l_returnflag, count(*) AS n, quantile_cont(y, 0.25) AS q1,
                    quantile_cont(y, 0.5) AS median, quantile_cont(y, 0.75) AS q3 FROM x GROUP BY ALL)
       SELECT l_returnflag, q.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
         round(min(y) FILTER (WHERE y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS lower_whisker,
         round(max(y) FILTER (WHERE y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS upper_whisker,
         count(*) FILTER (WHERE y NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
       FROM x JOIN q USING (l_returnflag) GROUP BY ALL""",
)
def boxes(t):
    logs = t.lineitem.select("l_returnflag", offset_log10("l_extendedprice").alias("y"))
    return rounded(box_summary(logs, ["l_returnflag"], "y"))


@query(
    "log_histogram",
    """WITH x AS (SELECT l_returnflag, log10(l_extendedprice + 0.01) AS y FROM lineitem),
            b AS (SELECT min(y) AS lo, max(y) AS hi FROM x),
            c AS (SELECT l_returnflag, CAST(least(floor((y - lo) / (hi - lo) * 25), 24) AS INTEGER) AS bin,
                    lo, hi FROM x, b)
       SELECT l_returnflag, bin, count(*) AS n, round(lo + bin * ((hi - lo) / 25), 6) AS bin_start,
              round(lo + (bin + 1) * ((hi - lo) / 25), 6) AS bin_end
       FROM c GROUP BY ALL""",
)
def log_histogram(t):
    logs = t.lineitem.select("l_returnflag", offset_log10("l_extendedprice").alias("y"))
    return rounded(histogram(logs, "y", ["l_returnflag"]))


_TRUE = (-14.2, 7.44, 0.041)
_POINTS = """p AS (SELECT CAST(p_size AS DOUBLE) AS x,
  -14.2 + 7.44 * exp(0.041 * p_size) + (p_retailprice - 950) / 50 AS y FROM part)"""


def _points(t):
    x = F.col("p_size").cast("double")
    return t.part.select(
        x.alias("x"), (growth(x, _TRUE) + (F.col("p_retailprice") - 950) / 50).alias("y")
    )


@query(
    "exp_fit",
    f"""WITH RECURSIVE {_POINTS},
      s AS (SELECT x, count(*) AS m, sum(y) AS sy FROM p GROUP BY x),
      fit AS (
        SELECT 0 AS i, CAST(-20 AS DOUBLE) AS a, CAST(10 AS DOUBLE) AS b, CAST(0.03 AS DOUBLE) AS c
        UNION ALL
        SELECT i + 1, a + ((h11*h22-h12*h12)*g0 - (h01*h22-h12*h02)*g1 + (h01*h12-h11*h02)*g2) / det,
               b + (-(h01*h22-h02*h12)*g0 + (h00*h22-h02*h02)*g1 - (h00*h12-h01*h02)*g2) / det,
               c + ((h01*h12-h02*h11)*g0 - (h00*h12-h02*h01)*g1 + (h00*h11-h01*h01)*g2) / det
        FROM (
          SELECT *, h00*(h11*h22-h12*h12) - h01*(h01*h22-h12*h02) + h02*(h01*h12-h11*h02) AS det
          FROM (
            SELECT i, a, b, c, sum(m) AS h00, sum(m*e) AS h01, sum(m*b*x*e) AS h02, sum(m*e*e) AS h11,
                   sum(m*b*x*e*e) AS h12, sum(m*b*b*x*x*e*e) AS h22,
                   sum(r) AS g0, sum(e*r) AS g1, sum(b*x*e*r) AS g2
            FROM (SELECT i, a, b, c, x, m, exp(c*x) AS e, sy - m*(a + b*exp(c*x)) AS r FROM fit, s WHERE i < 40)
            GROUP BY i, a, b, c)))
      SELECT round(a, 4) AS a, round(b, 4) AS b, round(c, 6) AS c, n, round(rss, 3) AS rss, true AS converged
      FROM (SELECT a, b, c, count(*) AS n, sum((y - a - b*exp(c*x)) ** 2) AS rss
            FROM fit, p WHERE i = 40 GROUP BY a, b, c)""",
)
def exp_fit(t):
    fit = fit_growth(_points(t), "x", "y")
    return fit.select(
        F.round("a", 4).alias("a"), F.round("b", 4).alias("b"), F.round("c", 6).alias("c"),
        "n", F.round("rss", 3).alias("rss"), "converged",
    )


@query(
    "fit_r2",
    f"""WITH {_POINTS} SELECT count(*) AS n, round(sum((y + 14 - 7.4 * exp(0.041 * x)) ** 2), 3) AS rss,
          round(var_pop(y) * count(*), 3) AS tss,
          round(1 - sum((y + 14 - 7.4 * exp(0.041 * x)) ** 2) / (var_pop(y) * count(*)), 6) AS r_squared FROM p""",
)
def fit_r2(t):
    quality_row = fit_quality(_points(t), "x", "y", (-14.0, 7.4, 0.041))
    return rounded(rounded(quality_row, 3, "rss", "tss"), 6, "r_squared")


@query(
    "nan_missing",
    """WITH v AS (SELECT l_returnflag, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS x,
                         CASE WHEN l_linenumber = 3 THEN NULL ELSE l_tax END AS y FROM lineitem)
       SELECT l_returnflag, round(sum(x), 6) AS total, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS sd,
              round(stddev_samp(x) / sqrt(count(*)), 6) AS se, round(sum(coalesce(x, 0) + coalesce(y, 0)), 6) AS both
       FROM v GROUP BY ALL""",
)
def nan_missing(t):
    lost = F.col("l_linenumber") == 3
    v = t.lineitem.select(
        "l_returnflag", *[F.when(lost, F.lit(float("nan"))).otherwise(F.col(c)).alias(n) for c, n in (("l_quantity", "x"), ("l_tax", "y"))]
    )
    return rounded(
        v.groupBy("l_returnflag").agg(
            sum0("x").alias("total"), mean("x").alias("mean"), deviation("x").alias("sd"), standard_error("x").alias("se"),
            F.sum(row_sum("x", "y")).alias("both"),
        )
    )


@query(
    "clean_names",
    """SELECT l_orderkey AS line_no, l_linenumber AS percent_cover, l_quantity AS site_name, l_tax AS site_name_2,
              l_discount AS x2024_count FROM lineitem""",
)
def cleaned(t):
    raw = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount")
    return clean_names(raw.toDF("Line No.", "% Cover", "siteName", "Site  Name", "2024 count"))


@query(
    "profile",
    """SELECT 'l_tax' AS column, 'double' AS type, count(*) AS n_rows, count(*) - count(l_tax) AS n_missing,
              CAST(min(l_tax) + 0.0 AS VARCHAR) AS least, CAST(max(l_tax) + 0.0 AS VARCHAR) AS largest FROM lineitem
       UNION ALL SELECT 'l_returnflag', 'string', count(*), count(*) - count(l_returnflag), min(l_returnflag), max(l_returnflag) FROM lineitem""",
)
def profiled(t):
    return profile(t.lineitem, ["l_tax", "l_returnflag"])


@query(
    "plot_annotation",
    "SELECT l_returnflag, count(*) AS n, min(l_quantity) AS min_x, max(l_tax) AS max_y FROM lineitem GROUP BY ALL",
)
def annotated(t):
    return annotation(t.lineitem, ["l_returnflag"], "l_quantity", "l_tax")


_NAMES = ["alamo", "Alamo", "álamo", "Álamo", "beta", "Beta", "zebra", "Ökologie"]
#: The same as dictionaries have them: accents and capitals count after all letters.
_NAMES_IN_ORDER = ["alamo", "Alamo", "álamo", "Álamo", "beta", "Beta", "Ökologie", "zebra"]
_NAME = f"[{', '.join(repr(n) for n in _NAMES)}][CAST(c_custkey % {len(_NAMES)} AS INTEGER) + 1]"


@query(
    "collated_texts",
    f"""WITH x AS (SELECT DISTINCT c_nationkey, c_mktsegment, {_NAME} AS name FROM customer WHERE c_custkey % 3 > 0)
       SELECT c_nationkey, c_mktsegment, string_agg(name, ' | ' ORDER BY list_position([{', '.join(repr(n) for n in _NAMES_IN_ORDER)}], name)) AS by_collation,
              string_agg(name, ' | ' ORDER BY encode(name)) AS by_bytes
       FROM x GROUP BY ALL""",
)
def collated(t):
    names = F.array(*[F.lit(n) for n in _NAMES])
    customers = t.customer.where("c_custkey % 3 > 0").withColumn("name", F.get(names, (F.col("c_custkey") % len(_NAMES)).cast("int")))
    keys = ["c_nationkey", "c_mktsegment"]
    by_collation = summarise(customers, keys, {}, sorted_texts={"by_collation": "name"}, collation="UNICODE")
    return join_suffix(by_collation, summarise(customers, keys, {}, sorted_texts={"by_bytes": "name"}), keys)


_REPORTED = """WITH x AS (
         SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority, c_name, o_totalprice - 150000 AS spare,
           CASE WHEN o_orderpriority LIKE '%URGENT' THEN 'now' WHEN o_orderpriority LIKE '%HIGH' THEN 'soon' END AS label, year(o_orderdate) AS year
         FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 9000) c ON o_custkey = c_custkey)"""


@query(
    "quality_report",
    f"""{_REPORTED}
       SELECT 'rows' AS "check", '' AS subject, '' AS finding, count(*) AS n FROM x
       UNION ALL SELECT 'duplicate_key', 'o_custkey | day', o_custkey || ' | ' || day, count(*) FROM x GROUP BY ALL HAVING count(*) > 1
       UNION ALL SELECT 'unclassified', 'o_orderpriority', o_orderpriority, count(*) FROM x WHERE label IS NULL GROUP BY ALL
       UNION ALL SELECT 'unmatched', 'c_name', CAST(o_custkey AS VARCHAR), count(*) FROM x WHERE c_name IS NULL GROUP BY ALL
       UNION ALL SELECT 'bad_duration', 'days', o_custkey || ' | ' || day || ' | ' || CAST(floor(spare / 1000) AS BIGINT), count(*) FROM x WHERE floor(spare / 1000) <= 0 GROUP BY ALL
       UNION ALL SELECT 'recode', 'label', o_orderpriority || ' -> ' || coalesce(label, 'NA'), count(*) FROM x GROUP BY ALL
       UNION ALL SELECT 'empty', 'year', CAST(y AS VARCHAR), 0 FROM (VALUES (1997), (2030)) v(y) WHERE y NOT IN (SELECT year FROM x)""",
)
def report(t):
    orders = t.orders.select(
        "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority", F.floor((F.col("o_totalprice") - 150000) / 1000).alias("days"),
        F.when(F.col("o_orderpriority").endswith("URGENT"), "now").when(F.col("o_orderpriority").endswith("HIGH"), "soon").alias("label"),
        F.year("o_orderdate").alias("year"),
    )
    joined = join_suffix(orders, t.customer.where("c_acctbal > 9000").select("c_custkey", "c_name"), [("o_custkey", "c_custkey")], "left")
    return quality.quality_report(
        joined, ["o_custkey", "day"], labels={"label": "o_orderpriority"}, partners={"c_name": ["o_custkey"]}, durations=["days"],
        recodes={"o_orderpriority": "label"}, required={"year": [1997, 2030]},
    )
