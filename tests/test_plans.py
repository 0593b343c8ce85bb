"""The survey jobs on small hand-made tables, quirks included."""

import math
import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fieldspark.plans import double_entry as de
from fieldspark.plans import effort as ef
from fieldspark.plans import explore as ex
from fieldspark.plans import recruitment as rc
from fieldspark.plans import site_tables as st
from fieldspark.plans import sst
from fieldspark.plans import zone_level as zl

# --- double entry -------------------------------------------------------------------------------
QUAD = """_row_id long, site string, site_type string, zone string, survey_date string, transect string,
  quadrat string, substrate string, purple double, name_of_data_enterer string, notes string,
  windows_ctrl_alt_shift_0_mac_command_option_shift_0 string"""


def quads(spark, *rows):
    example = (1, "EXAMPLE", "X", "X", "2025-07-01", "1", "1R", "rock", 9.0, "me", "n", "z")
    body = [(i + 2, *r, "someone", f"note {i}", None) for i, r in enumerate(rows)]
    return de.prepare_entry(spark.createDataFrame([example, *body], QUAD), de.QUADRAT_TYPES.__class__(
        [f for f in de.QUADRAT_TYPES if f.name != "drift_superlayer"]), side_column="quadrat")


def test_quadrat_differences(spark, rows):
    first = quads(
        spark,
        ("REC7", "FOR", "deep", "2025-07-01", "1", "12R", "rock", 3.0),
        ("REC12", None, "deep", "2025-07-01", "1", "3L", "sand", 3.0),
        ("REC_3", "BAR", "deep", "2025-07-02", "1", "4", "sand", None),
        ("REC_4", "BAR", "deep", "2024-07-02", "1", "4", "sand", 1.0),
        ("REC_5", "BAR", "deep", "rubbish", "1", "4", "sand", 1.0),
    )
    second = quads(
        spark,
        ("REC_7", "FOR", "deep", "2025-07-01", "1", "12", "cobble", 4.5),
        ("REC_12", None, "deep", "2025-07-01", "1", "3", "sand", 4.0),
        ("REC3", "BAR", "deep", "2025-07-02", "1", "4R", "sand", 2.0),
        ("REC_4", "BAR", "deep", "2024-07-02", "1", "4", "sand", 2.0),
    )
    assert "EXAMPLE" not in [r.site for r in first.collect()]
    got = de.quadrat_differences(first, second)
    assert got.columns == [*de.QUADRAT_KEYS, "substrate_raw_diff", "purple_raw_diff", "n_pairs", "resolved"]
    day = date(2025, 7, 1)
    assert rows(got) == [
        ("REC_12", None, "deep", day, 1.0, 3.0, None, "3 ≠ 4", 1, ""),
        ("REC_7", "FOR", "deep", day, 1.0, 12.0, "rock ≠ cobble", "3 ≠ 4.5", 1, ""),
    ]
    assert rows(de.quadrat_missing_keys(first, second)) == [("REC_5", "BAR", "deep", None, 1.0, 4.0, 1)]


def test_repeated_keys_compare_every_pair(spark):
    rng = random.Random(11)
    make = lambda n: [("s" if rng.random() < 0.4 else rng.choice("tuv"), float(rng.randrange(3))) for _ in range(n)]
    a, b = make(40), make(30)
    frames = [spark.createDataFrame(x, "k string, v double") for x in (a, b)]
    want = Counter((k, f"{int(v)} ≠ {int(w)}") for k, v in a for j, w in b if k == j and v != w)
    counted = de.compare_entries(*frames, ["k"], ["v"])
    assert {(r.k, r.v_diff): r.n_pairs for r in counted.collect()} == dict(want)
    each = de.compare_entries(*frames, ["k"], ["v"], pairs="rows")
    assert each.columns == ["k", "v_diff"] and Counter(tuple(r) for r in each.collect()) == want


def test_labels_follow_the_argument_order(spark):
    a = spark.createDataFrame([("k", 1.0)], "k string, v double")
    b = spark.createDataFrame([("k", 2.0)], "k string, v double")
    assert de.compare_entries(a, b, ["k"], ["v"]).first().v_diff == "1 ≠ 2"
    assert de.compare_entries(b, a, ["k"], ["v"]).first().v_diff == "2 ≠ 1"


def brute_differences(a, b, null_aware, report_missing):
    """Rows (key, difference, missing_in) with the number of pairs behind them; a value may be missing or not a number."""
    plain = lambda v: None if v is None or math.isnan(v) else v
    shown = lambda v: "NA" if v is None else str(int(v)) if v == int(v) else str(v)
    want = Counter()
    for k, v in a:
        for j, w in b:
            if k != j:
                continue
            x, y = plain(v), plain(w)
            if x != y and (null_aware or None not in (x, y)):
                want[k, f"{shown(x)} ≠ {shown(y)}", None] += 1
    if report_missing:
        known = [{k for k, _ in rows} for rows in (a, b)]
        for rows, other, side in ((a, known[1], "second"), (b, known[0], "first")):
            want.update((k, None, side) for k, _ in rows if k not in other)
    return want


@pytest.mark.parametrize("block", [2, 256])
@pytest.mark.parametrize("null_aware, report_missing", [(False, False), (True, False), (False, True), (True, True)])
def test_blocks_compare_every_pair_of_a_key(spark, monkeypatch, block, null_aware, report_missing):
    """A hot key with many distinct values, keys that are fractions or missing, copies, and values that are missing or not numbers."""
    monkeypatch.setattr(de, "PAIR_BLOCK", block)
    rng = random.Random(block)
    key = lambda: 0.5 if rng.random() < 0.4 else rng.choice([None, 1.0, 2.25, 1e-7, 1e20, rng.random()])
    value = lambda: rng.choice([None, float("nan"), 0.25, *map(float, range(9))])
    a, b = ([(key(), value()) for _ in range(n)] for n in (60, 45))
    frames = [spark.createDataFrame(x, "k double, v double") for x in (a, b)]
    got = de.compare_entries(*frames, ["k"], ["v"], null_aware=null_aware, report_missing=report_missing)
    found = {(r.k, r.v_diff, r["missing_in"] if report_missing else None): r.n_pairs for r in got.collect()}
    assert found == dict(brute_differences(a, b, null_aware, report_missing))


def test_pairs_over_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(de, "PAIR_CHUNK", 7)
    a = spark.createDataFrame([("k", 1.0)] * 9 + [("k", 2.0)], "k string, v double")
    b = spark.createDataFrame([("k", 3.0)] * 11, "k string, v double")
    each = Counter(tuple(r) for r in de.compare_entries(a, b, ["k"], ["v"], pairs="rows").collect())
    assert each == {("k", "1 ≠ 3"): 99, ("k", "2 ≠ 3"): 11}


def test_tiny_numbers_and_negative_zero(spark, rows):
    a = spark.createDataFrame([(0.0, 1e-15), (1.0, 1.5e-7), (2.0, 3.0)], "k double, v double")
    b = spark.createDataFrame([(-0.0, 2e-15), (1.0, 1.5e-7), (2.0, 3.0000000000000004)], "k double, v double")
    assert rows(de.compare_entries(a, b, ["k"], ["v"]), "k", "v_diff") == [
        (0.0, "0.000000000000001 ≠ 0.000000000000002"), (2.0, "3 ≠ 3.0000000000000004"),
    ]


def test_rows_that_differ_in_their_notes_stay_two(spark):
    schema = "site string, site_type string, zone string, date string, transect string, depth string, depth_units string, species string, size string, count string, notes string"
    row = ("REC1", "FOR", "deep", "2025-07-01", "1", "10", "m", "S", "7")
    first = spark.createDataFrame([(*row, "1", "a"), (*row, "1", "b"), (*row, "1", "b")], schema)
    second = spark.createDataFrame([(*row, "2", "c")], schema)
    first, second = (de.prepare_entry(d, de.SIZE_TYPES, example_row=False) for d in (first, second))
    assert [(r.count_diff, r.n_pairs) for r in de.size_differences(first, second).collect()] == [("1 ≠ 2", 2)]
    assert [r.n_pairs for r in de.size_differences(first, second, unique=False).collect()] == [3]


@pytest.mark.parametrize("unique, most", [(False, 2), (True, 3)])
def test_comparison_shuffles_twice(spark, unique, most):
    frames = [spark.range(10).selectExpr("cast(id AS double) AS k", "id AS v", "id AS w") for _ in range(2)]
    got = de.compare_entries(*frames, ["k"], ["v"], unique=unique)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == most and "Join" not in plan


def test_rows_told_apart_by_nothing_else_are_not_counted_again(spark):
    frames = [spark.createDataFrame(r, "k string, v double") for r in ([("a", 1.0)] * 3 + [("b", 2.0)], [("a", 4.0)] * 2 + [("a", 5.0)])]
    got = de.compare_entries(*frames, ["k"], ["v"], unique=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count(" HashAggregate(") == 4  # rows once and results once, each before and after it is brought together
    assert {tuple(r) for r in got.collect()} == {("a", "1 ≠ 4", 1), ("a", "1 ≠ 5", 1)}


def test_values_of_keys_meet_in_all_tasks(spark):
    """Few bytes are not merged into fewer tasks than the session has."""
    frames = [spark.range(400).selectExpr("cast(id AS string) AS k", f"cast(id + {i} AS double) AS v") for i in range(2)]
    got = de.compare_entries(*frames, ["k"], ["v"])
    parts = Counter(r[0] for r in got.select(F.spark_partition_id()).collect())
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and parts.total() == 400


SWATH = """site string, site_type string, zone string, date string, transect string, depth string,
  depth_units string, species string, stipe_counts_macrocystis_only string, count string, subsample_meter string"""


def swath(spark, *rows):
    df = spark.createDataFrame([("REC1", "FOR", "deep", "2025-07-01", "1", "10", "m", *r) for r in rows], SWATH)
    return de.prepare_entry(df, de.SWATH_TYPES, example_row=False, unique=True)


def test_swath_differences(spark, rows):
    first = swath(spark, ("PTECAL", None, "3", "30"), ("LAMSET", None, "1", None), ("MACPYR", "4", "1", None), ("MACPYR", "6", "1", None))
    second = swath(spark, ("PTECAL", None, "4", "30"), ("EISARB", None, "1", None), ("MACPYR", "4", "1", None))
    one = rows(de.swath_differences(first, second), "species", "stipe_diff", "count_diff", "subsample_diff")
    assert one == [("PTECAL", None, "3 ≠ 4", None)]
    both = de.swath_differences(first, second, report_missing=True)
    assert rows(both, "species", "count_diff", "missing_in") == [
        ("EISARB", None, "first"), ("LAMSET", None, "second"), ("PTECAL", "3 ≠ 4", None),
    ]
    total = de.swath_total_differences(first, second)
    assert rows(total, "site", "n_plants_diff", "total_stipes_diff", "resolved") == [("REC_1", "2 ≠ 1", "10 ≠ 4", "")]


def test_star_differences(spark, rows):
    schema = """site string, site_type string, zone string, date string, transect string, depth string,
      depth_units string, species string, size string, count string, diet string"""
    make = lambda count, diet: de.prepare_entry(
        spark.createDataFrame([("REC1", "FOR", "deep", "2024-07-01", "1", "10", "m", "DERIMB", "7", count, diet)], schema),
        de.STAR_TYPES, example_row=False)
    got = de.star_differences(make("1", "anemone"), make("2", "crab"))
    assert rows(got, "count_diff", "diet_diff", "resolved") == [("1 ≠ 2", "anemone ≠ crab", "")]
    assert de.star_differences(make("1", None), make("1", "crab")).count() == 0


# --- site tables --------------------------------------------------------------------------------
def test_margin_sites(spark):
    columns = [f.name for f in st.MARGIN_TYPES]
    row = dict.fromkeys(columns) | {
        "survey_type": "margin", "region": "North", "site_name_2024": "mar5", "site_name_2025": "MAR12", "transect": "1",
        "target_latitude": "36.5", "actual_latitude": "bad", "target_longitude": "-121.9", "actual_longitude": "-121.8",
        "date_surveyed": "2025-07-01", "resite_date": "2025-08-02",
    }
    unnamed = row | {"site_name_2025": None}
    schema = ", ".join(f"{c} string" for c in columns)
    df = spark.createDataFrame([tuple(r[c] for c in columns) for r in (row, unnamed)], schema)
    got = [r.asDict() for r in st.margin_site_table(df).collect()]
    assert got == [{
        "survey_type": "margin", "region": "North", "site_name_2024": "MAR_05", "site_name_2025": "MAR_12", "transect": 1.0,
        "heading_out": None, "latitude": 36.5, "longitude": -121.8, "survey_date": date(2025, 8, 2),
        "date_surveyed_originally": date(2025, 7, 1),
    }]


def test_recovery_sites(spark):
    columns = [f.name for f in st.RECOVERY_TYPES]
    row = dict.fromkeys(columns, "NULL") | {
        "site_name_2024": "REC7", "site_name_2025": "REC_07", "transect": "deep", "new_latitude": "36.6",
        "original_date_surveyed_2024": "2024-07-01", "original_date_surveyed_2025": "7/1/2025", "resite_date_2025": "8/15/2025",
    }
    df = spark.createDataFrame([tuple(row[c] for c in columns)], ", ".join(f"{c} string" for c in columns))
    got = st.recovery_site_table(df).first()
    assert (got.site_name_2024, got.site_name_2025, got.zone, got.latitude, got.latitude_old) == ("REC_07", "REC_07", "deep", 36.6, None)
    assert (got.survey_date_2024, got.survey_date_2025, got.notes) == (date(2024, 7, 1), date(2025, 8, 15), None)


# --- effort -------------------------------------------------------------------------------------
FORM = """_row_id long, timestamp timestamp_ntz, email_address string, event_record string, date_deployed timestamp_ntz,
  date_collected timestamp_ntz, site_5 string, site_9 string, site_surveyed string, samples_deployed string,
  samples_collected string, notes_7 string, notes_11 string, notes_13 string"""
MEDIA = "Benthic brush 1, benthic  BRUSH 2,,Suspended recruitment plate, crate"


def form(spark):
    d = lambda m, n, h=8: datetime(2026, m, n, h)
    deploy = lambda i, day, site, note=None, media=MEDIA: (
        i, day, " a@x ", "Deployment", day, None, None, site, None, media, None, None, note, None)
    collect = lambda i, day, site, note=None, media=MEDIA: (
        i, day, None, " Collection ", None, day, site, None, None, None, media, note, None, None)
    return spark.createDataFrame([
        deploy(1, d(1, 1), "KF1_deep", "calm"),
        deploy(2, d(1, 1, 9), " KF1D", "calm"),
        deploy(3, d(1, 1, 10), "KF1D", "swell"),
        collect(4, d(2, 1), "KF1D"),
        deploy(5, d(2, 1), "KF1D"),                       # same day: replacement gear
        collect(6, d(3, 1), "KF1_deep", "  "),
        collect(7, d(1, 1), "BR1D"),                      # only a later deployment
        deploy(8, d(1, 5), "BR1D"),
        collect(9, d(1, 9), "BR2S", media="Benthic brush 1"),  # no deployment at all
        (10, d(1, 3), "", "Survey", None, None, None, None, "KF2_shallow", None, None, None, None, " seen "),
    ], FORM)


def test_form_dispatch(spark, rows):
    effort = ef.standardise_form(form(spark))
    assert rows(ef.survey_table(effort)) == [(datetime(2026, 1, 3, 8), None, date(2026, 1, 3), "KF2S", "seen")]
    first = effort.where("_row_id = 1").first()
    assert (first.site, first.event_date, first.email_address, first.notes) == ("KF1D", date(2026, 1, 1), "a@x", "calm")
    assert effort.where("_row_id = 6").first().notes is None


def test_media_and_collapse(spark, rows):
    media = ef.media_events(ef.standardise_form(form(spark)))
    one = media.where("_row_id = 1")
    assert rows(one, "samples", "sample_type") == [
        ("Benthic brush 1", "benthic_brush"), ("Suspended recruitment plate", "suspended_plate"),
        ("benthic BRUSH 2", "benthic_brush"), ("crate", None),
    ]
    table = ef.effort_table(media)
    day = table.where("site = 'KF1D' AND event_date = DATE'2026-01-01' AND sample_type = 'benthic_brush'")
    assert rows(day, "timestamp", "email_address", "notes") == [(datetime(2026, 1, 1, 8), "a@x", "calm | swell")]


def test_soak_time(spark, rows):
    table = ef.effort_table(ef.media_events(ef.standardise_form(form(spark))))
    brushes = ef.soak_time(table).where("sample_type = 'benthic_brush'")
    got = rows(brushes, "site", "date_collected", "date_deployed", "soak_time")
    assert got == [
        ("BR2S", date(2026, 1, 9), None, None),
        ("KF1D", date(2026, 2, 1), date(2026, 1, 1), 31.0),
        ("KF1D", date(2026, 3, 1), date(2026, 2, 1), 28.0),
    ]
    kept = ef.soak_time(table, unmatched="keep").where("site = 'BR1D'")
    assert {r.date_deployed for r in kept.collect()} == {None} and kept.count() == 2


# --- recruitment --------------------------------------------------------------------------------
COUNTS = """_row_id long, timestamp timestamp_ntz, collection_date timestamp_ntz, sorting_date timestamp_ntz,
  location string, substrate_type string, name_of_person_sorting_first_last string, notes string, sample_number string,
  number_of_vials_in_sample double, number_of_purple_urchins string, number_of_red_urchins string,
  number_of_unidentified_urchins string, number_of_crabs double, number_of_gastropods double, number_of_bivalves double,
  number_of_plastic double"""


def samples(spark):
    d = lambda m, n: datetime(2026, m, n)
    base = (None, None, None, None)
    df = spark.createDataFrame([
        (1, d(3, 9), d(2, 1), d(2, 9), "Kelp Forest 1 Deep", "Benthic", " Ann  B ", "b note", "1", 2.0, "3", None, "x", *base),
        (2, d(3, 8), d(2, 1), None, "KF1_deep", " benthic ", "Zed", "a note", "1", 1.0, "1", "2", None, 5.0, *base[1:]),
        (3, d(3, 8), d(2, 1), None, "KF1D", "suspended", None, "b note", None, None, None, None, None, *base),
        (4, d(3, 8), d(2, 27), None, "Baren Reef 2 Shallow", "benthic", None, " ", "4", 1.0, "7", None, None, *base),
    ], COUNTS)
    return rc.clean_counts(df)


def soak(spark):
    return spark.createDataFrame([
        ("KF1D", "benthic_brush", date(2026, 1, 1), date(2026, 2, 1), 31.0, None, None, "x", None),
        ("KF1D", "suspended_brush", date(2026, 1, 12), date(2026, 2, 1), 20.0, None, None, "x", None),
        ("BR2S", "benthic_brush", None, date(2026, 2, 26), None, None, None, None, "y"),
    ], """site string, sample_type string, date_deployed date, date_collected date, soak_time double,
          deploy_timestamp timestamp_ntz, collect_timestamp timestamp_ntz, deploy_notes string, collect_notes string""")


def test_sample_summary_and_rates(spark):
    rates = rc.site_rates(rc.sample_summary(samples(spark)), rc.effort_summary(soak(spark)))
    got = {r.site: r for r in rates.collect()}
    kf, br = got["KF1D"], got["BR2S"]
    assert (kf.n_rows, kf.n_unique_sample_numbers, kf.total_vials, kf.total_urchins) == (3, 1, 3.0, 6.0)
    assert (kf.total_purple_urchins, kf.total_red_urchins, kf.total_unidentified_urchins) == (4.0, 2.0, 0.0)
    assert (kf.substrate_types, kf.sorters, kf.notes) == ("Benthic | benthic | suspended", "Ann B | Zed", "b note | a note")
    assert (kf.date_deployed, kf.soak_time, kf.sample_types) == (date(2026, 1, 1), 31.0, "benthic_brush | suspended_brush")
    assert (kf.deploy_notes, kf.collect_notes, kf.total_plastic) == ("x", None, 0.0)
    assert abs(kf.daily_counts - 6 / 31) < 1e-12 and kf.first_sorting_date == date(2026, 2, 9)
    assert (br.collection_date, br.raw_collection_dates, br.any_collection_date_corrected) == (
        date(2026, 2, 26), "2026-02-27", True)
    assert (br.soak_time, br.daily_counts, br.collect_notes, br.notes) == (None, None, "y", None)


def test_type_rates_and_weeks(spark, rows):
    rates = rc.type_rates(samples(spark), soak(spark))
    assert rows(rates, "site", "position", "total_urchins", "soak_time", "patch_type") == [
        ("KF1D", "benthic", 6.0, 31.0, "forest"), ("KF1D", "suspended", 0.0, 20.0, "forest"),
    ]
    assert rows(rc.weekly_totals(rates)) == [(date(2026, 1, 26), "benthic", 6.0), (date(2026, 1, 26), "suspended", 0.0)]


def test_notes_come_in_the_order_of_the_types_given(spark):
    schema = "site string, sample_type string, date_deployed date, date_collected date, soak_time double, deploy_timestamp timestamp, collect_timestamp timestamp, deploy_notes string, collect_notes string"
    day, at = date(2025, 7, 1), lambda h: datetime(2025, 7, 2, h)
    soak = spark.createDataFrame(
        [("s", kind, day, day, 1.0, None, at(h), None, note) for kind, h, note in (("zeta", 1, "first sent"), ("alpha", 2, "second sent"), ("other", 0, "no label"), (None, 3, "no type"))], schema
    )
    patterns = [("(?i)z", "zeta"), ("(?i)a", "alpha")]
    assert rc.effort_summary(soak, patterns).first().collect_notes == "no type | second sent | first sent | no label"


def test_zero_soak_gives_no_rate(spark):
    zero = soak(spark).withColumn("soak_time", F.lit(0.0))
    assert rc.type_rates(samples(spark), zero).count() == 0


# --- zone level ---------------------------------------------------------------------------------
def test_zone_biology(spark, rows):
    sizes = spark.createDataFrame([
        ("a", "F", "d", date(2024, 7, 1), "Purple", 2.0, 3.0), ("a", "F", "d", date(2024, 7, 2), "Purple", 3.0, 1.0),
        ("b", "F", "d", date(2024, 7, 1), "Purple", 5.0, 0.0), ("a", "F", "d", date(2024, 7, 1), "Red", 9.0, 9.0),
    ], "site string, site_type string, zone string, survey_date date, species string, size_cm double, count double")
    dist = zl.size_distribution(zl.purple_sizes(sizes))
    assert rows(dist, "site", "size_cm", "prob") == [("a", 2.0, 0.75), ("a", 3.0, 0.25)]
    fallback = zl.fallback_distribution(dist)
    quads_ = spark.createDataFrame([
        ("a", "F", "d", date(2024, 7, 1), 1.0), ("a", "F", "d", date(2024, 7, 1), None), ("b", "F", "d", date(2024, 7, 1), 0.5),
        ("c", "F", "d", date(2024, 7, 1), None),
    ], "site string, site_type string, zone string, survey_date date, purple_urchin_densitym2 double")
    density = zl.zone_density(zl.with_year(quads_))
    assert rows(density, "site", "mean_density", "n_quadrats", "total_urchins_zone") == [
        ("a", 1.0, 2, 80.0), ("b", 0.5, 1, 40.0), ("c", None, 1, None)]
    people = zl.simulate_sizes(density, dist, fallback)
    biomass = zl.site_biomass(zl.individual_biomass(people))
    assert rows(biomass, "site", "n_biomass") == [("a", 80), ("b", 40)]
    dissections = spark.createDataFrame([
        (date(2024, 8, 1), "a", "F", "d", "purple_urchin", 10.0), (date(2024, 8, 1), "a", "F", "d", "purple_urchin", 14.0),
        (date(2024, 8, 1), "b", "F", "d", "red_urchin", 9.0),
    ], "survey_date date, site_official string, site_type_official string, zone string, species string, gonad_index double")
    summary = zl.dissection_summary(dissections)
    assert rows(summary, "site_official", "mean_gonad_index_purple_urchin", "n_purple_urchin") == [("a", 12.0, 2), ("b", None, None)]
    gonads = {r.site: r for r in zl.gonad_mass(biomass, zl.gonad_summary(summary)).collect()}
    a = gonads["a"]
    assert abs(a.total_gonad_mass_g - 0.12 * a.total_biomass_g) < 1e-9
    assert abs(a.se_gonad_mass_g - (8 ** 0.5 / 100) * a.mean_biomass_g / 2 ** 0.5) < 1e-9
    assert gonads["b"].total_gonad_mass_g is None


def test_zone_table_and_labels(spark, rows):
    visit = ("a", "F", 36.5, None, "d", date(2025, 7, 1))
    keys = "site string, site_type string, latitude double, longitude double, zone string, survey_date date, "
    kelp = spark.createDataFrame([(*visit, 1.0, 4.0, 9.0), (*visit, 2.0, 6.0, 9.0)],
                                 keys + "transect double, cover double, macro_stipe_sd_20m2 double")
    quad = spark.createDataFrame([(*visit, 1.0, 1.0, 10.0)], keys + "transect double, quadrat double, cover double")
    gon = spark.createDataFrame([("a", "F", "d", 2025, 7.0)], "site string, site_type string, zone string, year int, mean_gi double")
    zones = zl.zone_table(kelp, quad, gon)
    assert zones.columns == ["site", "site_type", "latitude", "longitude", "zone", "survey_date", "cover_kelp", "cover_quad", "year", "mean_gi"]
    assert rows(zones, "longitude", "cover_kelp", "cover_quad", "mean_gi") == [(None, 5.0, 10.0, 7.0)]
    assert rows(zl.site_lookup(zones)) == [("a", "F", "d", 36.5, None)]
    labels = spark.createDataFrame([("a", "F", "d", "FOR", "BAR")],
                                   "site string, site_type string, zone string, patch_2024 string, patch_2025 string")
    tidy = zl.tidy_zones(zl.label_patches(zones, labels))
    assert tidy.columns[:8] == ["latitude", "longitude", "survey_date", "year", "site", "site_type", "pred_patch", "patch_cat"]
    assert rows(tidy, "pred_patch", "patch_cat") == [("BAR", "predicted 2025")]
    later = zl.tidy_zones(zl.label_patches(zones.withColumn("survey_date", F.lit(date(2026, 1, 1))), labels))
    assert rows(later, "pred_patch", "patch_cat") == [("F", "predicted 2025")]


# --- temperature --------------------------------------------------------------------------------
def test_series(spark):
    # the date is only looked at for its year
    days = [(date(y, 1, 1), y, doy, float(y + doy)) for y in (2010, 2014, 2020, 2022, 2024, 2025) for doy in (1, 149, 150, 365, 366)]
    days += [(date(2026, 1, 1), 2026, doy, 1.0) for doy in (1, 2)]
    daily = spark.createDataFrame(days, "date date, year int, doy int, anom_mean double")
    got = sst.aligned_series(daily)
    lines = {r.line: r.line_rank for r in got.collect()}
    assert lines == {"Mean (2010–2024)": 1, "2014": 2, "2020": 3, "2022": 4, "2024": 5, "2025": 6, "2026": 7}
    mean = [(r.doy, r.mean_ext, r.xplot) for r in got.where("year IS NULL").collect()]
    assert sorted(mean) == [(1, True, 366), (150, False, 150), (365, False, 365)]
    assert sorted(r.xplot for r in got.where("line = '2026'").collect()) == [366, 367]
    value = got.where("year IS NULL AND doy = 150").first().anom_mean
    assert value == sum(y + 150 for y in (2010, 2014, 2020, 2022, 2024)) / 5


def test_partitioned_grid_is_pruned_by_year(spark, tmp_path, rows):
    from fieldspark.sources.sinks import write_grid

    days = [datetime(y, m, 1, 12) for y in range(2009, 2027) for m in (1, 6)]
    grid = spark.createDataFrame([(d, 33.0, -120.0, float(d.year)) for d in days],
                                 "time timestamp_ntz, latitude double, longitude double, anom double")
    write_grid(grid, str(tmp_path / "g"))
    landed = spark.read.parquet(str(tmp_path / "g"))
    daily = sst.daily_regional_mean(landed, year_column="year")
    assert rows(daily) == rows(sst.daily_regional_mean(grid))
    baseline = sst.climatology(daily)
    assert rows(baseline) == rows(sst.climatology(sst.daily_regional_mean(grid)))
    plan = baseline._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [cast(year" in plan or "PartitionFilters: [year" in plan
    part = sst.daily_regional_mean(landed, first=date(2012, 1, 1), last=date(2013, 3, 1), year_column="year")
    assert [r[1] for r in rows(part)] == [2012, 2012, 2013]


def test_daily_mean_and_fine_grid(spark, rows):
    noon = datetime(2025, 3, 1, 12)
    grid = spark.createDataFrame([(noon, 33.0, -120.0, 1.0), (noon, 34.0, -120.0, None), (noon, 42.1, -114.0, 3.0), (noon, 43.0, -120.0, 99.0)],
                                 "time timestamp_ntz, latitude double, longitude double, anom double")
    assert rows(sst.daily_regional_mean(grid)) == [(date(2025, 3, 1), 2025, 60, 2.0)]
    with pytest.raises(Exception, match="no rows for year 2024"):
        sst.daily_regional_mean(grid, years=[2024, 2025]).collect()
    fine = spark.createDataFrame([(noon, 32.0 + i / 100, -130.0, float(i), 1) for i in range(25)],
                                 "time timestamp_ntz, latitude double, longitude double, sstAnom double, mask int")
    assert [r[3] for r in rows(sst.tidy_fine_grid(fine, date(2025, 4, 1)))] == [0.0, 10.0, 20.0]
    assert sst.tidy_fine_grid(fine, date(2025, 3, 5)).count() == 0


# --- explorers ----------------------------------------------------------------------------------
def test_text_columns_reach_the_explorer_as_they_were_typed(spark):
    """``5d`` and ``7F`` are no numbers, though a plain cast reads them as such."""
    columns = ["collection_date", "location", "substrate_type", *ex.COUNT_COLUMNS]
    row = dict.fromkeys(columns) | {"collection_date": "2024-01-05", "location": "Kelp forest 1", "substrate_type": "Benthic"}
    forms = [row | {ex.URCHIN_COLUMNS[0]: v} for v in ("5d", "7F", "NaN", " 3 ", "1e1")]
    form = spark.createDataFrame([tuple(r[c] for c in columns) for r in forms], ", ".join(f"{c} string" for c in columns))
    assert sorted(r.total_urchins for r in ex.prepare_counts(form).collect()) == [0, 0, 0, 3, 10]
    assert sorted(r[ex.URCHIN_COLUMNS[0]] or 0 for r in rc.clean_counts(form.withColumns(dict.fromkeys(("timestamp", "sorting_date", "name_of_person_sorting_first_last", "notes", "sample_number"), F.lit(None).cast("string")))).collect()) == [0, 0, 0, 3, 10]


def test_rubbish_dates_become_missing_in_every_plan(spark):
    columns = ["timestamp", "email_address", "event_record", "date_deployed", "date_collected", "site_5", "site_9", "site_surveyed", "samples_deployed", "samples_collected", "notes_7", "notes_11", "notes_13"]
    row = dict.fromkeys(columns) | {"event_record": "Deployment", "site_9": "KF1", "samples_deployed": "benthic brush 1"}
    written = {"2025-02-30": None, "7/4/2025": date(2025, 7, 4), "soon": None, "2025-07-04 08:00:00": date(2025, 7, 4), "": None}
    form = spark.createDataFrame([tuple((row | {"date_deployed": w, "timestamp": w, "notes_11": w})[c] for c in columns) for w in written], ", ".join(f"{c} string" for c in columns))
    got = {r.notes or "": (r.event_date, r.timestamp and r.timestamp.date()) for r in ef.standardise_form(form).collect()}
    assert got == {w: (day, day) for w, day in written.items()}


def test_explorers(spark, rows):
    counts = spark.createDataFrame([
        (datetime(2026, 1, 1), "Kelp Forest 1 Deep", "benthic", 1.0, None, 2.0),
        (datetime(2026, 1, 2), "Kelp Forest 1 Deep", "benthic", 3.0, 1.0, None),
        (datetime(2026, 1, 9), "Barrens Reef 1 Deep", "plate", 7.0, None, None),
    ], """collection_date timestamp_ntz, location string, substrate_type string, number_of_purple_urchins double,
          number_of_red_urchins double, number_of_unidentified_urchins double""")
    ready = ex.prepare_counts(counts)
    taxa = ["total_urchins", "number_of_red_urchins"]
    assert rows(ex.count_summary(ready, "habitat", taxa, "sum")) == [
        ("Barren", "plate", "number_of_red_urchins", 0.0), ("Barren", "plate", "total_urchins", 7.0),
        ("Forest", "benthic", "number_of_red_urchins", 1.0), ("Forest", "benthic", "total_urchins", 7.0),
    ]
    early = ex.select_counts(ready, last=date(2026, 1, 5), substrate_type=[], location=None)
    assert early.count() == 2
    assert rows(ex.count_summary(early, "location", ["number_of_red_urchins"], "mean"), "value") == [(0.5,)]
    sites = ex.site_positions(spark.createDataFrame([("KF1_deep", "36.5", "-121.9", "yes", 12.0), ("BR1_deep", "x", "-121.9", "no", 9.0)],
                                                    "site_name string, latitude string, longitude string, mpa string, depth_m double"))
    mapped = ex.with_bubbles(ex.map_summary(ready, sites, taxa, "sum"))
    assert rows(mapped, "site_id", "value", "radius", "label") == [("KF1_deep", 8.0, 15.0, "KF1_deep | benthic | value: 8")]
    assert ex.map_summary(ready, sites, taxa, locations=["BR1_deep"]).count() == 0
    choices = rows(ex.filter_choices(ready, "collection_date", ["habitat"]))
    assert choices == [("collection_date", None, date(2026, 1, 1), date(2026, 1, 9)),
                       ("habitat", "Barren", date(2026, 1, 9), date(2026, 1, 9)),
                       ("habitat", "Forest", date(2026, 1, 1), date(2026, 1, 2))]
