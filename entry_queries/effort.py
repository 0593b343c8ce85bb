"""Effort form, as-of pairing, recruitment counts and checks.

The forms are read from ``events``: the event type tells the kind of form row, the number in
``props`` the place, and the value what was handled or counted.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from entry_queries.registry import query, rounded
from fieldspark.fixed_values import COUNT_SITE_ALIASES
from fieldspark.functions.dates import days_between
from fieldspark.functions.text import location_id, recode, squish
from fieldspark.operators import quality
from fieldspark.operators.asof import prior_event_asof
from fieldspark.operators.statistics import box_summary
from fieldspark.plans import effort as ef
from fieldspark.plans import explore as ex
from fieldspark.plans import recruitment as rc

# --- the form, written once and read by both engines ---------------------------------------------
_PLACE = """coalesce(nullif(split_part('KF1_deep,KF1_shallow,KF2_deep,KF2_shallow,BR1_deep,BR1S,BR2_deep,BR2_shallow',
  ',', CAST(floor(k / 8) AS INT) + 1), ''), concat('Plot  ', user_id))"""
_MEDIA = """CASE WHEN value < 3 THEN 'Benthic brush 1, benthic  BRUSH 2,,Suspended recruitment plate'
  WHEN value < 8 THEN 'suspended brush 1,Benthic recruitment plate 2' WHEN value < 12 THEN ' '
  WHEN value < 20 THEN 'Suspended Brush 2,mystery crate' END"""
_FORM_COLUMNS = {
    "timestamp": "ts",
    "_row_id": "event_id",
    "email_address": "CASE WHEN k < 90 THEN concat(' diver', user_id, '@example.org') END",
    "event_record": """CASE event_type WHEN 'signup' THEN 'Deployment' WHEN 'purchase' THEN ' Collection '
                       WHEN 'view' THEN 'Survey' ELSE event_type END""",
    "date_deployed": "CASE WHEN k < 25 OR k > 27 THEN ts END",
    "date_collected": "ts",
    "site_5": f"concat(' ', {_PLACE})",
    "site_9": _PLACE,
    "site_surveyed": _PLACE,
    "samples_deployed": _MEDIA,
    "samples_collected": _MEDIA,
    "notes_7": "CASE WHEN k > 50 THEN concat('swell  ', k) ELSE ' ' END",
    "notes_11": "CASE WHEN k > 30 THEN 'calm' END",
    "notes_13": "concat('survey ', k)",
}


def effort_form(t):
    numbered = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    form = numbered.select(*[F.expr(e).alias(n) for n, e in _FORM_COLUMNS.items()])
    # as landed: dates are text in either order, and what the SQL has as missing is text that cannot be read
    written = {
        "date_deployed": F.coalesce(F.date_format("date_deployed", "M/d/yyyy"), F.lit("rubbish")),
        "date_collected": F.coalesce(F.date_format("date_collected", "yyyy-MM-dd HH:mm:ss"), F.lit("n/a")),
    }
    return form.withColumns(written)


_E = "e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"
_FORM = f"{_E}, form AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _FORM_COLUMNS.items())} FROM e)"
_SQUISH = r"nullif(trim(regexp_replace({0}, '\s+', ' ', 'g')), '')"


def _sq(c):
    return _SQUISH.format(c)


_RECODE = """CASE WHEN {0} = 'KF1_deep' THEN 'KF1D' WHEN {0} = 'KF1_shallow' THEN 'KF1S'
  WHEN {0} = 'KF2_deep' THEN 'KF2D' WHEN {0} = 'KF2_shallow' THEN 'KF2S' WHEN {0} = 'BR1_deep' THEN 'BR1D'
  WHEN {0} = 'BR2_deep' THEN 'BR2D' WHEN {0} = 'BR2_shallow' THEN 'BR2S' ELSE {0} END"""
_CLEAN = f"""{_FORM},
  kinds AS (SELECT * REPLACE ({_sq('event_record')} AS event_record) FROM form),
  effort AS (
    SELECT timestamp, {_sq('email_address')} AS email_address, event_record,
      CAST(CASE event_record WHEN 'Deployment' THEN date_deployed WHEN 'Collection' THEN date_collected
           WHEN 'Survey' THEN timestamp ELSE coalesce(date_collected, date_deployed, timestamp) END AS DATE) AS event_date,
      {_RECODE.format(_sq("CASE event_record WHEN 'Deployment' THEN site_9 WHEN 'Collection' THEN site_5 WHEN 'Survey' THEN site_surveyed ELSE coalesce(site_5, site_9, site_surveyed) END"))} AS site,
      {_sq("CASE event_record WHEN 'Deployment' THEN samples_deployed WHEN 'Collection' THEN samples_collected END")} AS samples,
      {_sq("CASE event_record WHEN 'Deployment' THEN notes_11 WHEN 'Collection' THEN notes_7 WHEN 'Survey' THEN notes_13 ELSE coalesce(notes_7, notes_11, notes_13) END")} AS notes,
      _row_id
    FROM kinds)"""
_MEDIA_EVENTS = f"""{_CLEAN},
  pieces AS (
    SELECT timestamp, email_address, event_record, event_date, site, {_sq('piece')} AS samples, notes, _row_id
    FROM (SELECT *, unnest(string_split(samples, ',')) AS piece FROM effort
          WHERE event_record IN ('Deployment', 'Collection'))),
  media AS (
    SELECT timestamp, email_address, event_record, event_date, site, samples,
      CASE WHEN regexp_matches(samples, '(?i)^benthic\\s+brush') THEN 'benthic_brush'
           WHEN regexp_matches(samples, '(?i)^suspended\\s+brush') THEN 'suspended_brush'
           WHEN regexp_matches(samples, '(?i)^benthic\\s+recruitment\\s+plate') THEN 'benthic_plate'
           WHEN regexp_matches(samples, '(?i)^suspended\\s+recruitment\\s+plate') THEN 'suspended_plate' END AS sample_type,
      notes, _row_id
    FROM pieces WHERE samples IS NOT NULL)"""
_TABLE = f"""{_MEDIA_EVENTS},
  typed AS (SELECT * FROM media WHERE sample_type IS NOT NULL),
  note AS (SELECT site, event_date, event_record, sample_type, notes, min((timestamp, _row_id)) AS o
           FROM typed WHERE notes IS NOT NULL GROUP BY ALL),
  noted AS (SELECT site, event_date, event_record, sample_type, string_agg(notes, ' | ' ORDER BY o) AS notes
            FROM note GROUP BY ALL),
  base AS (SELECT site, event_date, event_record, sample_type, min(timestamp) AS timestamp,
             first(email_address ORDER BY timestamp, _row_id) FILTER (WHERE email_address IS NOT NULL) AS email_address
           FROM typed GROUP BY ALL),
  collapsed AS (
    SELECT base.*, noted.notes FROM base LEFT JOIN noted
      ON base.site IS NOT DISTINCT FROM noted.site AND base.event_date IS NOT DISTINCT FROM noted.event_date
     AND base.event_record = noted.event_record AND base.sample_type = noted.sample_type)"""
_SOAK = f"""{_TABLE},
  dep AS (SELECT site, sample_type, timestamp AS deploy_timestamp, event_date AS date_deployed, notes AS deploy_notes
          FROM collapsed WHERE event_record = 'Deployment'),
  col AS (SELECT site, sample_type, timestamp AS collect_timestamp, event_date AS date_collected, notes AS collect_notes
          FROM collapsed WHERE event_record = 'Collection'),
  soak AS (
    SELECT col.site, col.sample_type, date_deployed, date_collected,
           CAST(date_diff('day', date_deployed, date_collected) AS DOUBLE) AS soak_time,
           deploy_timestamp, collect_timestamp, deploy_notes, collect_notes
    FROM col LEFT JOIN dep ON col.site = dep.site AND col.sample_type = dep.sample_type
    WHERE date_deployed IS NULL OR date_deployed < date_collected
    QUALIFY row_number() OVER (PARTITION BY col.site, col.sample_type, collect_timestamp, date_collected
                               ORDER BY date_deployed DESC NULLS FIRST, deploy_timestamp DESC NULLS FIRST) = 1)"""


@query("event_dispatch", f"WITH {_CLEAN} SELECT * FROM effort")
def event_dispatch(t):
    return ef.standardise_form(effort_form(t))


@query(
    "event_subset",
    f"WITH {_CLEAN} SELECT timestamp, email_address, event_date, site, notes FROM effort WHERE event_record = 'Survey'",
)
def event_subset(t):
    return ef.survey_table(ef.standardise_form(effort_form(t)))


def _media(t):
    return ef.media_events(ef.standardise_form(effort_form(t)))


@query("list_explode", f"WITH {_MEDIA_EVENTS} SELECT * FROM media")
def list_explode(t):
    return _media(t)


@query(
    "classify_regex",
    f"WITH {_MEDIA_EVENTS} SELECT sample_type, samples, count(*) AS n FROM media GROUP BY ALL",
)
def classify_regex(t):
    return quality.count_by(_media(t), ["sample_type", "samples"])


@query("unclassified", f"WITH {_MEDIA_EVENTS} SELECT DISTINCT samples FROM media WHERE sample_type IS NULL")
def unclassified(t):
    return quality.unclassified(_media(t), "sample_type", "samples")


def _table(t):
    return ef.effort_table(_media(t))


@query("collapse_events", f"WITH {_TABLE} SELECT * FROM collapsed")
def collapse_events(t):
    return _table(t)


def _soak(t, unmatched="drop"):
    return ef.soak_time(_table(t), unmatched)


@query("soak_time", f"WITH {_SOAK} SELECT * FROM soak")
def soak(t):
    return _soak(t)


@query(
    "unmatched",
    f"""WITH {_SOAK} SELECT site, sample_type, date_collected, count(*) AS n FROM soak
        WHERE date_deployed IS NULL GROUP BY ALL""",
)
def unmatched(t):
    return quality.unmatched(_soak(t), "date_deployed", ["site", "sample_type", "date_collected"])


_EVENT_DATE = "CASE WHEN user_id > 20 OR k < 97 THEN CAST(ts AS DATE) END"


@query(
    "prior_event_asof",
    f"""WITH {_E},
      d AS (SELECT nullif(user_id, 3) AS u, {_EVENT_DATE} AS day, ts, value FROM e WHERE event_type = 'signup' AND user_id <> 5),
      c AS (SELECT event_id, nullif(user_id, 3) AS u, {_EVENT_DATE} AS day FROM e WHERE event_type = 'purchase')
    SELECT c.event_id, c.u AS user_id, c.day AS collected, d.day AS deployed, d.ts AS deployed_at,
           d.value AS deployed_value, CAST(date_diff('day', d.day, c.day) AS DOUBLE) AS soak
    FROM c LEFT JOIN d ON c.u IS NOT DISTINCT FROM d.u
    WHERE d.day IS NULL OR d.day < c.day
    QUALIFY row_number() OVER (PARTITION BY c.event_id ORDER BY d.day DESC NULLS FIRST, d.ts DESC NULLS FIRST) = 1""",
)
def prior_event(t):
    e = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn(
        "user_id_or_none", F.nullif("user_id", F.lit(3))
    )
    deployed = e.where((F.col("event_type") == "signup") & (F.col("user_id") != 5)).select(
        F.col("user_id_or_none").alias("user_id"), F.expr(_EVENT_DATE).alias("deployed"),
        F.col("ts").alias("deployed_at"), F.col("value").alias("deployed_value"),
    )
    collected = e.where(F.col("event_type") == "purchase").select(
        "event_id", F.col("user_id_or_none").alias("user_id"), F.expr(_EVENT_DATE).alias("collected")
    )
    paired = prior_event_asof(collected, deployed, ["user_id"], "collected", "deployed", "deployed_at")
    return paired.withColumn("soak", days_between("collected", "deployed"))


@query(
    "bad_duration",
    """SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate,
              CAST(date_diff('day', o_orderdate, l_shipdate) - 30 AS DOUBLE) AS days_late
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE date_diff('day', o_orderdate, l_shipdate) <= 30""",
)
def bad_duration(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate",
        (days_between("l_shipdate", "o_orderdate") - 30).alias("days_late"),
    )
    return quality.bad_duration(lines, "days_late")


# --- the count form -----------------------------------------------------------------------------
_LOCATION = """coalesce(nullif(split_part('Kelp Forest 1 Deep,Kelp  Forest 1 Shallow,Kelp Forest 2 Deep,Kelp Forest 2 Shallow,Baren reef 1 Deep,Barrens Reef 1 Shallow,Baren Reef 2 Deep, Barrens Reef 2 Shallow',
  ',', CAST(floor(k / 8) AS INT) + 1), ''), concat('Plot ', user_id))"""
_COUNT_COLUMNS = {
    "timestamp": "ts",
    "collection_date": "CASE WHEN event_type <> 'error' OR k < 95 THEN ts END",
    "sorting_date": "CASE WHEN k < 70 THEN ts END",
    "location": _LOCATION,
    "substrate_type": "CASE WHEN value < 6 THEN 'Benthic' WHEN value < 12 THEN ' suspended ' ELSE 'Plate' END",
    "name_of_person_sorting_first_last": "CASE WHEN k > 10 THEN event_type END",
    "notes": "CASE WHEN k > 85 THEN concat('torn  bag ', k) ELSE ' ' END",
    "sample_number": "CASE WHEN k <> 33 THEN concat('s', k) END",
    "number_of_vials_in_sample": "CAST(k AS DOUBLE)",
    "number_of_purple_urchins": "CASE WHEN k < 80 THEN CAST(CAST(floor(value) AS BIGINT) AS STRING) END",
    "number_of_red_urchins": "CASE WHEN k < 50 THEN CAST(k AS STRING) ELSE 'n/a' END",
    "number_of_unidentified_urchins": "CASE WHEN value > 5 THEN '1' END",
    "number_of_crabs": "floor(value / 2)",
    "number_of_gastropods": "CAST(k AS DOUBLE)",
    "number_of_bivalves": "CASE WHEN k > 20 THEN 2.0e0 END",
    "number_of_plastic": "CAST(NULL AS DOUBLE)",
}
_CORRECTIONS = [("BR2S", "2024-01-10", "2024-01-09"), ("BR1D", "2024-01-20", "2024-01-15")]


def count_form(t):
    numbered = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    form = numbered.select(*[F.expr(e).alias(n) for n, e in _COUNT_COLUMNS.items()])
    # as landed: text, and what the SQL has as missing is text that cannot be read
    unreadable = ["n/a", "5d", "7F", "nan", ""]
    counts = [c for c in _COUNT_COLUMNS if c.startswith("number_of_")]
    written = {c: F.coalesce(F.col(c).cast("string"), F.lit(unreadable[i % 5])) for i, c in enumerate(counts)}
    written |= {c: F.coalesce(F.date_format(c, "M/d/yyyy"), F.lit("rubbish")) for c in ("collection_date", "sorting_date")}
    return form.withColumns(written)


def _samples(t):
    return rc.clean_counts(count_form(t), corrections=_CORRECTIONS)


_COUNTS = f"{_E}, counts AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _COUNT_COLUMNS.items())} FROM e)"
_LOC = r"trim(regexp_replace(location, '\s+', ' ', 'g'))"
_SITE = f"""CASE WHEN {_LOC} = 'Kelp Forest 1 Deep' THEN 'KF1D' WHEN {_LOC} = 'Kelp Forest 1 Shallow' THEN 'KF1S'
  WHEN {_LOC} = 'Kelp Forest 2 Deep' THEN 'KF2D' WHEN {_LOC} = 'Kelp Forest 2 Shallow' THEN 'KF2S'
  WHEN {_LOC} = 'Baren reef 1 Deep' THEN 'BR1D' WHEN {_LOC} = 'Barrens Reef 1 Shallow' THEN 'BR1S'
  WHEN {_LOC} = 'Baren Reef 2 Deep' THEN 'BR2D' WHEN {_LOC} = 'Barrens Reef 2 Shallow' THEN 'BR2S'
  ELSE {_LOC} END"""
_CLEAN_COUNTS = f"""{_COUNTS},
  numbered AS (
    SELECT * REPLACE (TRY_CAST(number_of_purple_urchins AS DOUBLE) AS number_of_purple_urchins,
                      TRY_CAST(number_of_red_urchins AS DOUBLE) AS number_of_red_urchins,
                      TRY_CAST(number_of_unidentified_urchins AS DOUBLE) AS number_of_unidentified_urchins,
                      CAST(sorting_date AS DATE) AS sorting_date,
                      {_LOC} AS location, trim(substrate_type) AS substrate_type,
                      {_sq('notes')} AS notes),
           {_SITE} AS site, CAST(collection_date AS DATE) AS collection_date_raw,
           name_of_person_sorting_first_last AS sorter_name
    FROM counts),
  clean AS (
    SELECT * REPLACE (CASE WHEN site = 'BR2S' AND collection_date_raw = DATE '2024-01-10' THEN DATE '2024-01-09'
                           WHEN site = 'BR1D' AND collection_date_raw = DATE '2024-01-20' THEN DATE '2024-01-15'
                           ELSE collection_date_raw END AS collection_date),
           coalesce(number_of_purple_urchins, 0) + coalesce(number_of_red_urchins, 0)
             + coalesce(number_of_unidentified_urchins, 0) AS total_urchins
    FROM numbered)"""


@query(
    "date_correction",
    f"""WITH {_CLEAN_COUNTS}
        SELECT timestamp, site, collection_date_raw, collection_date,
               collection_date <> collection_date_raw AS collection_date_corrected, total_urchins FROM clean""",
)
def date_correction(t):
    return _samples(t).select(
        "timestamp", "site", "collection_date_raw", "collection_date", "collection_date_corrected", "total_urchins"
    )


@query(
    "date_correction_table",
    f"""WITH {_CLEAN_COUNTS},
          fix AS (SELECT site, collection_date_raw, min(sorting_date) AS corrected FROM numbered
                  WHERE substrate_type = 'Plate' GROUP BY ALL)
        SELECT n.timestamp, n.site, n.collection_date_raw, corrected,
               coalesce(corrected, n.collection_date_raw) AS collection_date,
               coalesce(corrected, n.collection_date_raw) <> n.collection_date_raw AS collection_date_corrected
        FROM numbered n LEFT JOIN fix ON n.site IS NOT DISTINCT FROM fix.site
          AND n.collection_date_raw IS NOT DISTINCT FROM fix.collection_date_raw""",
)
def date_correction_table(t):
    samples = _samples(t).drop("collection_date", "collection_date_corrected")
    fixes = (
        samples.where(F.col("substrate_type") == "Plate")
        .groupBy("site", "collection_date_raw").agg(F.min("sorting_date").alias("corrected"))
    )
    return rc.correct_dates(
        samples.select("timestamp", "site", "collection_date_raw"),
        fixes, ["site"], "collection_date_raw", "corrected", "collection_date",
    )


@query(
    "recode_alias",
    f"""WITH {_CLEAN_COUNTS} SELECT timestamp, location, site FROM clean""",
)
def recode_alias(t):
    squished = count_form(t).select("timestamp", squish("location").alias("location"))
    return squished.withColumn("site", recode("location", COUNT_SITE_ALIASES))


@query("recode_audit", f"WITH {_CLEAN_COUNTS} SELECT location, site, count(*) AS n FROM clean GROUP BY ALL")
def recode_audit(t):
    return quality.recode_audit(_samples(t), "location", "site")


@query(
    "derive_id",
    f"""WITH {_COUNTS}, low AS (SELECT timestamp, location, lower(location) AS x FROM counts)
        SELECT timestamp, location,
          CASE WHEN regexp_matches(x, 'kelp\\s*forest') THEN 'KF' WHEN regexp_matches(x, 'bar+en') THEN 'BR' END
          || nullif(regexp_extract(x, '\\b\\d+\\b'), '') || '_' ||
          CASE WHEN contains(x, 'shallow') THEN 'shallow' WHEN contains(x, 'deep') THEN 'deep' END AS site_id
        FROM low""",
)
def derive_id(t):
    return count_form(t).select("timestamp", "location", location_id("location").alias("site_id"))


def _ordered_notes(rows, keys, column, order):
    """SQL: distinct texts per key joined in order of first appearance."""
    k = ", ".join(keys)
    return (
        f"SELECT {k}, string_agg({column}, ' | ' ORDER BY o) AS {column} FROM "
        f"(SELECT {k}, {column}, min({order}) AS o FROM {rows} WHERE {column} IS NOT NULL GROUP BY ALL) GROUP BY ALL"
    )


_SUMMARY = f"""{_CLEAN_COUNTS},
  noted_samples AS ({_ordered_notes('clean', rc.SAMPLE_KEYS, 'notes', 'timestamp')}),
  numbers AS (
    SELECT site, collection_date, count(*) AS n_rows, count(DISTINCT sample_number) AS n_unique_sample_numbers,
      coalesce(sum(number_of_vials_in_sample), 0) AS total_vials,
      coalesce(sum(number_of_purple_urchins), 0) AS total_purple_urchins,
      coalesce(sum(number_of_red_urchins), 0) AS total_red_urchins,
      coalesce(sum(number_of_unidentified_urchins), 0) AS total_unidentified_urchins,
      coalesce(sum(total_urchins), 0) AS total_urchins,
      coalesce(sum(number_of_crabs), 0) AS total_crabs, coalesce(sum(number_of_gastropods), 0) AS total_gastropods,
      coalesce(sum(number_of_bivalves), 0) AS total_bivalves, coalesce(sum(number_of_plastic), 0) AS total_plastic,
      min(sorting_date) AS first_sorting_date, max(sorting_date) AS last_sorting_date,
      coalesce(bool_or(collection_date <> collection_date_raw), false) AS any_collection_date_corrected,
      string_agg(DISTINCT substrate_type, ' | ' ORDER BY substrate_type) AS substrate_types,
      string_agg(DISTINCT sorter_name, ' | ' ORDER BY sorter_name) AS sorters,
      string_agg(DISTINCT CAST(collection_date_raw AS VARCHAR), ' | ' ORDER BY CAST(collection_date_raw AS VARCHAR)) AS raw_collection_dates
    FROM clean GROUP BY site, collection_date),
  summary AS (SELECT numbers.*, notes FROM numbers LEFT JOIN noted_samples n
    ON numbers.site = n.site AND numbers.collection_date IS NOT DISTINCT FROM n.collection_date)"""


@query("count_summary", f"WITH {_SUMMARY} SELECT * FROM summary")
def count_summary(t):
    return rc.sample_summary(_samples(t))


_EFFORT_SUMMARY = f"""
  noted_deploy AS ({_ordered_notes('soak', rc.EFFORT_KEYS, 'deploy_notes', '(sample_type, collect_timestamp)')}),
  noted_collect AS ({_ordered_notes('soak', rc.EFFORT_KEYS, 'collect_notes', '(sample_type, collect_timestamp)')}),
  effort_numbers AS (
    SELECT site, date_collected, min(date_deployed) AS date_deployed, max(soak_time) AS soak_time,
           string_agg(DISTINCT sample_type, ' | ' ORDER BY sample_type) AS sample_types
    FROM soak GROUP BY site, date_collected),
  effort_summary AS (
    SELECT n.*, deploy_notes, collect_notes FROM effort_numbers n
    LEFT JOIN noted_deploy d ON n.site = d.site AND n.date_collected IS NOT DISTINCT FROM d.date_collected
    LEFT JOIN noted_collect c ON n.site = c.site AND n.date_collected IS NOT DISTINCT FROM c.date_collected)"""


@query("effort_summary", f"WITH {_SOAK}, {_EFFORT_SUMMARY} SELECT * FROM effort_summary")
def effort_summary(t):
    return rc.effort_summary(_soak(t))


# both forms derive from the same events CTE
_BOTH = f"{_SOAK}, {_EFFORT_SUMMARY}, {_SUMMARY.removeprefix(_E + ', ')}"


@query(
    "cpue",
    f"""WITH {_BOTH}
        SELECT s.site, s.collection_date, raw_collection_dates, any_collection_date_corrected, date_deployed, soak_time,
          total_purple_urchins, total_red_urchins, total_unidentified_urchins, total_urchins,
          round(total_purple_urchins / nullif(soak_time, 0), 6) AS daily_purple_urchins,
          round(total_red_urchins / nullif(soak_time, 0), 6) AS daily_red_urchins,
          round(total_unidentified_urchins / nullif(soak_time, 0), 6) AS daily_unidentified_urchins,
          round(total_urchins / nullif(soak_time, 0), 6) AS daily_counts,
          total_crabs, total_gastropods, total_bivalves, total_plastic, total_vials, n_rows, n_unique_sample_numbers,
          first_sorting_date, last_sorting_date, substrate_types, sample_types, sorters, notes, deploy_notes, collect_notes
        FROM summary s LEFT JOIN effort_summary e
          ON s.site IS NOT DISTINCT FROM e.site AND s.collection_date IS NOT DISTINCT FROM e.date_collected""",
)
def cpue(t):
    return rounded(rc.site_rates(rc.sample_summary(_samples(t)), rc.effort_summary(_soak(t))))


_RATES = f"""{_SOAK}, {_CLEAN_COUNTS.removeprefix(_E + ', ')},
  by_type AS (
    SELECT site, collection_date, CASE lower(substrate_type) WHEN 'benthic' THEN 'benthic_brush'
             WHEN 'suspended' THEN 'suspended_brush' END AS sample_type, coalesce(sum(total_urchins), 0) AS total_urchins
    FROM clean WHERE lower(substrate_type) IN ('benthic', 'suspended') GROUP BY ALL),
  rates AS (
    SELECT b.*, soak_time, total_urchins / nullif(soak_time, 0) AS daily_counts,
      CASE WHEN b.site LIKE 'KF%' THEN 'forest' WHEN b.site LIKE 'BR%' THEN 'barren' END AS patch_type,
      CASE b.sample_type WHEN 'benthic_brush' THEN 'benthic' ELSE 'suspended' END AS position
    FROM by_type b LEFT JOIN soak s ON b.site IS NOT DISTINCT FROM s.site AND b.sample_type = s.sample_type
      AND b.collection_date IS NOT DISTINCT FROM s.date_collected),
  kept AS (SELECT * FROM rates WHERE daily_counts IS NOT NULL AND patch_type IS NOT NULL)"""


def _rates(t):
    return rc.type_rates(_samples(t), _soak(t))


@query(
    "cpue_by_type",
    f"""WITH {_RATES}
        SELECT site, collection_date, sample_type, total_urchins, soak_time, round(daily_counts, 6) AS daily_counts,
          patch_type, position, CAST(CASE patch_type WHEN 'forest' THEN 1 ELSE 2 END AS INTEGER) AS patch_rank,
          CAST(CASE position WHEN 'benthic' THEN 1 ELSE 2 END AS INTEGER) AS position_rank,
          round(daily_counts + 0.01, 6) AS daily_counts_adj, round(log10(daily_counts + 0.01), 6) AS log_daily_counts
        FROM kept""",
)
def cpue_by_type(t):
    return rounded(_rates(t))


@query(
    "weekly_totals",
    f"""WITH {_RATES} SELECT CAST(date_trunc('week', collection_date) AS DATE) AS week, position,
          sum(total_urchins) AS total_urchins FROM kept GROUP BY ALL""",
)
def weekly(t):
    return rc.weekly_totals(_rates(t))


@query(
    "rate_boxes",
    f"""WITH {_RATES}, x AS (SELECT patch_type, position, log10(daily_counts + 0.01) AS y FROM kept),
          q AS (SELECT patch_type, position, count(*) AS n, quantile_cont(y, 0.25) AS q1,
                  quantile_cont(y, 0.5) AS median, quantile_cont(y, 0.75) AS q3 FROM x GROUP BY ALL)
        SELECT patch_type, position, q.n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
          round(min(y) FILTER (WHERE y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS lower_whisker,
          round(max(y) FILTER (WHERE y BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS upper_whisker,
          count(*) FILTER (WHERE y NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
        FROM x JOIN q USING (patch_type, position) GROUP BY ALL""",
)
def rate_boxes(t):
    return rounded(box_summary(_rates(t), ["patch_type", "position"], "log_daily_counts"))


@query(
    "explore_summary",
    f"""WITH {_CLEAN_COUNTS}, h AS (
          SELECT *, CASE WHEN regexp_matches(location, '(?i)kelp\\s*forest') THEN 'Forest'
                         WHEN regexp_matches(location, '(?i)bar+en') THEN 'Barren' ELSE 'Other' END AS habitat
          FROM clean WHERE collection_date_raw BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
            AND substrate_type IN ('Benthic', 'suspended')),
        long AS (
          SELECT habitat, substrate_type, 'total_urchins' AS taxon, coalesce(total_urchins, 0) AS count FROM h
          UNION ALL SELECT habitat, substrate_type, 'number_of_bivalves', coalesce(number_of_bivalves, 0) FROM h
          UNION ALL SELECT habitat, substrate_type, 'number_of_crabs', coalesce(number_of_crabs, 0) FROM h)
        SELECT habitat, substrate_type, taxon, round(avg(count), 6) AS value,
          CASE taxon WHEN 'total_urchins' THEN 'Total urchins' WHEN 'number_of_crabs' THEN 'Crabs'
            ELSE 'Bivalves' END AS taxon_label,
          CAST(CASE taxon WHEN 'total_urchins' THEN 1 WHEN 'number_of_crabs' THEN 5 ELSE 7 END AS INTEGER) AS taxon_rank
        FROM long GROUP BY ALL""",
)
def explore_summary(t):
    form = count_form(t)
    squished = form.withColumn("substrate_type", squish("substrate_type"))
    chosen = ex.select_counts(
        ex.prepare_counts(squished), first=date(2024, 1, 5), last=date(2024, 1, 25),
        substrate_type=["Benthic", "suspended"], location=None,
    )
    taxa = ["total_urchins", "number_of_bivalves", "number_of_crabs"]
    return rounded(ex.with_taxon_order(ex.count_summary(chosen, "habitat", taxa, "mean")))


@query(
    "explore_map",
    """WITH c AS (SELECT 'NATION_' || c_nationkey AS site_id, c_mktsegment AS substrate_type,
                    coalesce(floor(abs(c_acctbal)), 0) + coalesce(CASE WHEN c_acctbal > 0 THEN 5.0 END, 0) AS v
                  FROM customer),
            s AS (SELECT n_name AS site_id, n_name AS location,
                    CASE WHEN n_regionkey > 0 THEN 30.5 + n_nationkey END AS lat, -120.25 - n_nationkey AS lon,
                    r_name AS mpa, CAST(n_regionkey AS DOUBLE) AS depth_m
                  FROM nation JOIN region ON n_regionkey = r_regionkey),
            m AS (SELECT c.site_id, substrate_type, sum(v) AS value FROM c
                  WHERE site_id IN (SELECT site_id FROM s WHERE location <> 'NATION_7') GROUP BY ALL),
            p AS (SELECT m.*, location, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, mpa, depth_m
                  FROM m LEFT JOIN s ON m.site_id = s.site_id WHERE lat IS NOT NULL AND lon IS NOT NULL),
            b AS (SELECT min(ln(1 + value)) AS lo, max(ln(1 + value)) AS hi FROM p)
       SELECT p.*, round(5 + (ln(1 + value) - lo) / (hi - lo) * 20, 6) AS radius,
              location || ' | ' || substrate_type || ' | value: ' || CAST(CAST(value AS BIGINT) AS VARCHAR) AS label
       FROM p, b""",
)
def explore_map(t):
    counts = t.customer.select(
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("site_id"),
        F.col("c_mktsegment").alias("substrate_type"),
        F.floor(F.abs("c_acctbal")).cast("double").alias("urchins"),
        F.when(F.col("c_acctbal") > 0, F.lit(5.0)).alias("crabs"),
    )
    sites = ex.site_positions(
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_name").alias("site_name"),
            F.when(F.col("n_regionkey") > 0, (F.lit(30.5) + F.col("n_nationkey")).cast("string"))
            .otherwise("n/a").alias("latitude"),
            (F.lit(-120.25) - F.col("n_nationkey")).cast("string").alias("longitude"),
            F.col("r_name").alias("mpa"),
            F.col("n_regionkey").cast("double").alias("depth_m"),
        )
    )
    names = [f"NATION_{i}" for i in range(25) if i != 7]
    mapped = ex.map_summary(counts, sites, ["urchins", "crabs"], "sum", locations=names)
    return rounded(ex.with_bubbles(mapped)).orderBy(F.desc_nulls_last("value"))
