"""Sources, typing, projection, text, dates and sorting."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from entry_queries.registry import query, rounded, sql_number_text, text_of
from fieldspark.functions.dates import MONTH_FIRST, YEAR_FIRST, latest_of, stamp_text
from fieldspark.functions.nulls import level_rank, num_text, nulls_last, row_sum
from fieldspark.functions.text import safe_name, site_code, site_code_padded, squish, strip_side
from fieldspark.operators.aggregates import bounds, count_by
from fieldspark.operators.grid import month_chunks
from fieldspark.operators.reshape import to_long
from fieldspark.plans.explore import filter_choices
from fieldspark.plans.site_tables import margin_site_table, recovery_site_table
from fieldspark.sources.landed import drop_first_row
from fieldspark.sources.snapshot import expired
from fieldspark.sources.typing import all_text, apply_schema, infer_schema, type_convert, unreadable


@query(
    "src_scan",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def src_scan(t):
    return t.customer


@query(
    "drop_first_row",
    """SELECT event_id, event_type, value FROM events
       WHERE event_id > (SELECT min(event_id) FROM events)""",
)
def first_row(t):
    return drop_first_row(t.events.select("event_id", "event_type", "value"), "event_id")


TYPED_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.DateType()),
    ]
)


@query(
    "type_apply",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
              CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
              o_orderpriority
       FROM orders""",
)
def type_apply(t):
    day = F.to_date("o_orderdate")
    landed = t.orders.select(
        text_of("o_orderkey").alias("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(text_of("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "5-LOW", "not yet")
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "M/d/yyyy"))
        .otherwise(text_of(day)).alias("o_orderdate"),
        "o_orderpriority",
    )
    return apply_schema(landed, TYPED_ORDERS, {"o_orderdate": [*YEAR_FIRST, *MONTH_FIRST]})


@query(
    "null_sentinel",
    """SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey,
              CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice,
              CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
              o_orderpriority
       FROM orders""",
)
def null_sentinel(t):
    landed = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "NULL").otherwise(text_of("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "NULL")
        .otherwise(text_of(F.to_date("o_orderdate"))).alias("o_orderdate"),
        "o_orderpriority",
    )
    text = all_text(landed)
    return apply_schema(text, infer_schema(text))


_K, _DAY = "CAST(o_orderkey AS BIGINT)", "CAST(o_orderdate AS DATE)"


@query(
    "type_convert",
    f"""SELECT CAST(o_orderkey AS DOUBLE) AS id, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus = 'F' END AS filled,
              o_totalprice AS price, {_DAY} AS day, CASE WHEN {_K} % 3 > 0 THEN {_DAY} END AS shown_day,
              CAST({_DAY} AS TIMESTAMP) + to_hours({_K} % 24) + to_minutes({_K} % 60) AS sent,
              CASE WHEN {_K} % 7 = 0 THEN CAST({_DAY} AS TIMESTAMP) ELSE CAST({_DAY} AS TIMESTAMP) + to_hours({_K} % 24) + to_minutes({_K} % 60) END AS shown_sent,
              CASE WHEN {_K} % 2 = 0 THEN strftime({_DAY}, '%Y-%m-%d') ELSE strftime({_DAY}, '%-m/%-d/%Y') END AS either,
              CASE WHEN {_K} % 5 = 0 THEN 'n/a' ELSE CAST({_K} AS VARCHAR) END AS mixed
       FROM orders""",
)
def converted(t):
    """A column of each kind as text, months first and years first, with missing values; two columns that no kind fits."""
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    clock = F.concat_ws(":", (key % 24).cast("string"), F.lpad((key % 60).cast("string"), 2, "0"))
    padded = F.concat_ws(":", F.lpad((key % 24).cast("string"), 2, "0"), F.lpad((key % 60).cast("string"), 2, "0"), F.lit("00"))
    month_first, year_first = F.date_format(day, "M/d/yyyy"), day.cast("string")
    text = t.orders.select(
        text_of("o_orderkey").alias("id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "NULL").when(F.col("o_orderstatus") == "F", "T").otherwise("false").alias("filled"),
        text_of("o_totalprice").alias("price"),
        year_first.alias("day"),
        F.when(key % 3 > 0, month_first).alias("shown_day"),
        F.concat_ws(" ", year_first, padded).alias("sent"),
        F.when(key % 7 == 0, month_first).otherwise(F.concat_ws(" ", month_first, clock)).alias("shown_sent"),
        F.when(key % 2 == 0, year_first).otherwise(month_first).alias("either"),
        F.when(key % 5 == 0, "n/a").otherwise(text_of("o_orderkey")).alias("mixed"),
    )
    return type_convert(all_text(text))


@query(
    "unreadable_cells",
    f"""WITH x AS (SELECT {_K} AS k FROM orders)
       SELECT 'day' AS "column", 'date' AS type, count(*) FILTER (WHERE k % 4 = 0) AS n_unreadable,
              CASE WHEN count(*) FILTER (WHERE k % 4 = 0) > 0 THEN '2025-02-30' END AS example FROM x
       UNION ALL SELECT 'price', 'double', count(*) FILTER (WHERE k % 5 = 0), min(CASE WHEN k % 5 = 0 THEN k || 'd' END) FROM x
       UNION ALL SELECT 'sent', 'timestamp', 0, NULL""",
)
def unread(t):
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    text = t.orders.select(
        F.when(key % 4 == 0, "2025-02-30").otherwise(F.date_format(day, "M/d/yyyy")).alias("day"),
        F.when(key % 5 == 0, F.concat(text_of("o_orderkey"), F.lit("d"))).when(key % 5 > 1, text_of("o_totalprice")).alias("price"),
        F.concat_ws(" ", day.cast("string"), F.lit("10:11:12")).alias("sent"),
    )
    schema = T.StructType([T.StructField("day", T.DateType()), T.StructField("price", T.DoubleType()), T.StructField("sent", T.TimestampType())])
    return unreadable(text, schema, {"day": ["M/d/yyyy"], "sent": ["yyyy-MM-dd HH:mm:ss"]})


@query(
    "profile_range",
    """SELECT count(*) AS n, min(l_shipdate) AS min_l_shipdate, max(l_shipdate) AS max_l_shipdate,
              min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity,
              min(l_extendedprice) AS min_l_extendedprice, max(l_extendedprice) AS max_l_extendedprice
       FROM lineitem""",
)
def profile_range(t):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            f(c).alias(f"{n}_{c}")
            for c in ("l_shipdate", "l_quantity", "l_extendedprice")
            for n, f in (("min", F.min), ("max", F.max))
        ],
    )


@query(
    "profile_year_counts",
    "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n FROM lineitem GROUP BY ALL",
)
def profile_year_counts(t):
    return count_by(t.lineitem.select(F.year("l_shipdate").alias("year")), ["year"])


@query(
    "proj_reorder",
    """SELECT CAST(o_orderdate AS DATE) AS survey_date, o_orderkey AS survey_key,
              o_totalprice AS total, o_orderstatus, o_orderpriority
       FROM orders ORDER BY survey_date, survey_key""",
)
def proj_reorder(t):
    return (
        t.orders.drop("o_custkey")
        .withColumnsRenamed({"o_orderkey": "survey_key", "o_totalprice": "total"})
        .withColumn("survey_date", F.to_date("o_orderdate"))
        .select("survey_date", "survey_key", "total", "o_orderstatus", "o_orderpriority")
        .orderBy(*nulls_last("survey_date", "survey_key"))
    )


@query(
    "squish",
    r"""SELECT doc_id, trim(regexp_replace(text, '[\t-\r \x{85}\p{Z}]+', ' ', 'g')) AS text
        FROM documents""",
)
def squish_texts(t):
    return t.documents.select("doc_id", squish("text").alias("text"))


@query(
    "strip_suffix",
    """SELECT l_orderkey, l_linenumber,
              CAST(regexp_replace(l_linenumber || l_returnflag, '[RL]$', '') AS VARCHAR) AS quadrat
       FROM lineitem""",
)
def strip_suffix(t):
    raw = F.concat(text_of("l_linenumber"), "l_returnflag")
    return t.lineitem.select("l_orderkey", "l_linenumber", strip_side(raw).alias("quadrat"))


@query(
    "site_code",
    r"""SELECT p_partkey,
               upper(regexp_extract(p_brand, '([A-Za-z]+)#([0-9]+)', 1)) || '_' ||
                 CASE WHEN length(regexp_extract(p_brand, '#([0-9]+)', 1)) < 2 THEN '0' ELSE '' END ||
                 regexp_extract(p_brand, '#([0-9]+)', 1) AS padded,
               regexp_replace('site REC' || p_size || ' of REC' || p_partkey, 'REC([0-9]+)', 'REC_\1') AS plain,
               p_name AS unmatched
        FROM part""",
)
def site_codes(t):
    return t.part.select(
        "p_partkey",
        site_code_padded(F.regexp_replace("p_brand", "#", "")).alias("padded"),
        site_code(
            F.concat(F.lit("site REC"), text_of("p_size"), F.lit(" of REC"), text_of("p_partkey"))
        ).alias("plain"),
        site_code_padded("p_name").alias("unmatched"),
    )


@query(
    "label_text",
    f"""SELECT c_custkey,
               c_name || ' | ' || c_mktsegment || ' | value: ' || {sql_number_text('c_acctbal')} AS label,
               {sql_number_text('CAST(c_custkey AS DOUBLE)')} AS key_text
        FROM customer""",
)
def label_text(t):
    return t.customer.select(
        "c_custkey",
        F.concat("c_name", F.lit(" | "), "c_mktsegment", F.lit(" | value: "), num_text("c_acctbal")).alias("label"),
        num_text(F.col("c_custkey").cast("double")).alias("key_text"),
    )


@query(
    "safe_name",
    r"""SELECT o_orderkey,
               'backup_' || regexp_replace(o_orderpriority || ' / ' || o_orderstatus, '[^A-Za-z0-9_\-]+', '_', 'g')
                 || '_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') AS name
        FROM orders""",
)
def safe_names(t):
    tab = F.concat("o_orderpriority", F.lit(" / "), "o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        F.concat(F.lit("backup_"), safe_name(tab), F.lit("_"), stamp_text("o_orderdate")).alias("name"),
    )


@query(
    "official_date",
    """SELECT l_orderkey, l_linenumber,
              coalesce(CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END,
                       CAST(o_orderdate AS DATE)) AS survey_date
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def official_date(t):
    resurvey = F.when(F.col("l_returnflag") == "R", F.to_date("l_shipdate"))
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", latest_of(resurvey, F.to_date("o_orderdate")).alias("survey_date")
    )


@query(
    "month_chunks",
    """WITH span AS (
         SELECT o_orderstatus, CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS first_day,
                CAST(max(o_orderdate) AS DATE) AS last_day
         FROM orders GROUP BY o_orderstatus)
       SELECT o_orderstatus, first_day, last_day, CAST(s AS DATE) AS chunk_start,
              least(CAST(s + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), last_day) AS chunk_end
       FROM span, unnest(generate_series(first_day, last_day, INTERVAL 1 MONTH)) AS u(s)""",
)
def month_steps(t):
    span = t.orders.groupBy("o_orderstatus").agg(
        F.trunc(F.min(F.to_date("o_orderdate")), "month").alias("first_day"),
        F.max(F.to_date("o_orderdate")).alias("last_day"),
    )
    return month_chunks(span, "first_day", "last_day")


@query(
    "retention_expired",
    """SELECT o_orderdate AS taken, count(*) AS n FROM orders
       WHERE floor(date_diff('second', o_orderdate, TIMESTAMP '2001-08-01 12:00:00') / 86400.0) > 90
       GROUP BY o_orderdate""",
)
def retention_expired(t):
    listing = t.orders.groupBy(F.col("o_orderdate").alias("taken")).agg(F.count(F.lit(1)).alias("n"))
    return expired(listing, "taken", datetime(2001, 8, 1, 12))


@query(
    "row_total",
    """SELECT l_orderkey, l_linenumber,
              round(coalesce(l_quantity, 0) + coalesce(nullif(l_discount, 0), 0) + coalesce(nullif(l_tax, 0), 0), 6) AS total
       FROM lineitem""",
)
def row_totals(t):
    zero = F.lit(0.0)
    total = row_sum("l_quantity", F.nullif("l_discount", zero), F.nullif("l_tax", zero))
    return rounded(t.lineitem.select("l_orderkey", "l_linenumber", total.alias("total")))


@query(
    "unpivot_taxa",
    """SELECT l_orderkey, l_linenumber, taxon, count FROM (
         SELECT l_orderkey, l_linenumber, l_quantity AS purple, nullif(l_tax, 0) AS red,
                l_extendedprice AS crabs FROM lineitem)
       UNPIVOT INCLUDE NULLS (count FOR taxon IN (purple, red, crabs))""",
)
def unpivot_taxa(t):
    wide = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("purple"),
        F.nullif("l_tax", F.lit(0.0)).alias("red"), F.col("l_extendedprice").alias("crabs"),
    )
    return to_long(wide, ["l_orderkey", "l_linenumber"], ["purple", "red", "crabs"], "taxon", "count")


PRIORITIES = ["5-LOW", "3-MEDIUM", "1-URGENT"]


@query(
    "level_sort",
    """SELECT o_orderpriority, CAST(CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2
              WHEN '1-URGENT' THEN 3 END AS INTEGER) AS rank, count(*) AS n
       FROM orders GROUP BY ALL ORDER BY rank NULLS LAST""",
)
def level_sort(t):
    counted = count_by(t.orders, ["o_orderpriority"])
    ranked = counted.withColumn("rank", level_rank("o_orderpriority", PRIORITIES))
    return ranked.orderBy(*nulls_last("rank"))


@query(
    "filter_choices",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus, o_orderpriority FROM orders)
       SELECT 'day' AS field, CAST(NULL AS VARCHAR) AS choice, min(day) AS first_day, max(day) AS last_day FROM d
       UNION ALL SELECT 'o_orderstatus', o_orderstatus, min(day), max(day) FROM d GROUP BY o_orderstatus
       UNION ALL SELECT 'o_orderpriority', o_orderpriority, min(day), max(day) FROM d GROUP BY o_orderpriority""",
)
def choices(t):
    days = t.orders.select(F.to_date("o_orderdate").alias("day"), "o_orderstatus", "o_orderpriority")
    return filter_choices(days, "day", ["o_orderstatus", "o_orderpriority"])


@query(
    "bbox",
    """SELECT min(c_acctbal) AS min_c_acctbal, max(c_acctbal) AS max_c_acctbal,
              min(c_nationkey) AS min_c_nationkey, max(c_nationkey) AS max_c_nationkey FROM customer""",
)
def bbox(t):
    return bounds(t.customer, "c_acctbal", "c_nationkey")


_CODE = """upper(regexp_extract(p_brand, '[A-Za-z]+')) || '_' || lpad(regexp_extract(p_brand, '[0-9]+'),
           CAST(greatest(2, length(regexp_extract(p_brand, '[0-9]+'))) AS INTEGER), '0')"""


@query(
    "site_table",
    f"""SELECT p_type AS survey_type, p_name AS region, {_CODE} AS site_name_2024, {_CODE} AS site_name_2025,
               CAST(p_size AS DOUBLE) AS transect, CAST(p_partkey AS DOUBLE) AS heading_out,
               CASE WHEN p_size > 30 THEN p_retailprice ELSE p_retailprice / 2 END AS latitude,
               -p_retailprice AS longitude,
               CASE WHEN p_size > 40 THEN DATE '2025-08-01' + p_size ELSE DATE '2025-07-01' + p_size END AS survey_date,
               DATE '2025-07-01' + p_size AS date_surveyed_originally
        FROM part WHERE p_size > 3""",
)
def margin_sites(t):
    code = F.regexp_replace("p_brand", "#", "")
    landed = t.part.select(
        F.col("p_type").alias("survey_type"),
        F.col("p_name").alias("region"),
        F.lower(code).alias("site_name_2024"),
        F.when(F.col("p_size") > 3, code).alias("site_name_2025"),
        text_of("p_size").alias("transect"),
        text_of("p_partkey").alias("heading_out"),
        text_of(F.col("p_retailprice") / 2).alias("target_latitude"),
        text_of(-F.col("p_retailprice")).alias("target_longitude"),
        F.when(F.col("p_size") > 30, text_of("p_retailprice")).otherwise("see map").alias("actual_latitude"),
        F.lit(None).cast("string").alias("actual_longitude"),
        text_of(F.date_add(F.lit("2025-07-01").cast("date"), F.col("p_size"))).alias("date_surveyed"),
        F.when(F.col("p_size") > 40, text_of(F.date_add(F.lit("2025-08-01").cast("date"), F.col("p_size"))))
        .otherwise("none").alias("resite_date"),
    )
    return margin_site_table(landed)


@query(
    "site_table_two_year",
    f"""SELECT p_type AS survey_type, CASE WHEN p_size > 10 THEN p_name END AS region,
               {_CODE} AS site_name_2025, p_type AS site_type_2025,
               CASE WHEN p_size > 20 THEN {_CODE} END AS site_name_2024, p_type AS site_type_2024,
               CAST(p_size AS VARCHAR) AS zone,
               CASE WHEN p_size > 30 THEN p_retailprice END AS latitude, -p_retailprice AS longitude,
               p_retailprice / 2 AS latitude_old, CAST(p_size AS DOUBLE) AS longitude_old,
               CASE WHEN p_size > 25 THEN DATE '2024-08-01' + p_size ELSE DATE '2024-07-01' + p_size END AS survey_date_2024,
               DATE '2025-07-01' + p_size AS survey_date_2025, CAST(NULL AS VARCHAR) AS notes
        FROM part""",
)
def recovery_sites(t):
    code = F.regexp_replace("p_brand", "#", "")
    size = F.col("p_size")

    def day(start, fmt):
        return F.date_format(F.date_add(F.lit(start).cast("date"), size), fmt)

    landed = t.part.select(
        F.col("p_type").alias("survey_type"),
        F.when(size > 10, F.col("p_name")).otherwise("NULL").alias("region"),
        F.when(size > 20, code).otherwise("NULL").alias("site_name_2024"),
        F.col("p_type").alias("site_type_2024"),
        code.alias("site_name_2025"),
        F.col("p_type").alias("site_type_2025"),
        size.alias("transect"),
        (F.col("p_retailprice") / 2).alias("old_latitude"),
        size.alias("old_longitude"),
        F.when(size > 30, text_of("p_retailprice")).otherwise("NULL").alias("new_latitude"),
        (-F.col("p_retailprice")).alias("new_longitude"),
        day("2024-07-01", "yyyy-MM-dd").alias("original_date_surveyed_2024"),
        F.when(size > 25, day("2024-08-01", "yyyy-MM-dd")).otherwise("NULL").alias("resite_date_2024"),
        day("2025-07-01", "M/d/yyyy").alias("original_date_surveyed_2025"),
        F.lit("NULL").alias("resite_date_2025"),
        F.lit("NULL").alias("notes"),
    )
    return recovery_site_table(landed)
