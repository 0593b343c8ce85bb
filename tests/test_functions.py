"""Missing-value, text and date rules on hand-made rows."""

from datetime import date

from pyspark.sql import functions as F

from fieldspark.functions import dates as d
from fieldspark.functions import models as m
from fieldspark.functions import nulls as n
from fieldspark.functions import text as t


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first().asDict()


def test_empty_groups(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 2.0, True), ("b", None, None), ("c", 5.0, False)],
                               "k string, x double, f boolean")
    got = {
        r["k"]: r for r in df.groupBy("k").agg(
            n.sum0("x").alias("s"), F.avg("x").alias("m"), F.stddev_samp("x").alias("sd"),
            n.any0("f").alias("any"), F.min("x").alias("lo"), n.standard_error("x").alias("se"),
        ).collect()
    }
    assert (got["a"]["s"], got["a"]["m"], got["a"]["any"], got["a"]["lo"]) == (0, None, False, None)
    assert got["b"]["any"] is True and got["b"]["sd"] is None
    assert got["c"]["any"] is False and got["c"]["se"] is None


def test_standard_error_counts_missing_rows(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (None,)], "x double")
    assert abs(df.agg(n.standard_error("x").alias("se")).first()["se"] - 2 ** 0.5 / 2) < 1e-12


def test_division_and_rounding(spark):
    got = one(spark, a=n.ratio(F.lit(1.0), F.lit(0.0)), b=n.ratio(F.lit(0), F.lit(0)), c=n.half_even(F.lit(2.5)),
              e=n.half_even(F.lit(3.5)), f=n.row_sum(F.lit(None).cast("double"), F.lit(2.0)))
    assert got == {"a": None, "b": None, "c": 2.0, "e": 4.0, "f": 2.0}


def test_number_text(spark):
    values = [3.0, 3.5, 12345678.0, 12345678.25, -2.0, 0.0, 0.05, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r["t"] for r in df.select("i", n.num_text("x").alias("t")).orderBy("i").collect()]
    assert got == ["3", "3.5", "12345678", "12345678.25", "-2", "0", "0.05", None]


def test_difference_text(spark):
    none = F.lit(None).cast("double")
    got = one(
        spark,
        a=n.diff_text(F.lit(1.0), F.lit(2.5), numeric=True),
        b=n.diff_text(F.lit(1.0), none, numeric=True),
        c=n.diff_text(F.lit(1.0), none, numeric=True, null_aware=True),
        e=n.diff_text(none, none, numeric=True, null_aware=True),
        f=n.diff_text(F.lit("x"), F.lit("x"), numeric=False),
    )
    assert got == {"a": "1 ≠ 2.5", "b": None, "c": "1 ≠ NA", "e": None, "f": None}


def test_text_rules(spark):
    got = one(
        spark,
        nbsp=t.squish(F.lit(" a  b\t c ")),
        blank=t.squish_to_null(F.lit("   ")),
        side=t.strip_side(F.lit("12R")),
        once=t.site_code(F.lit("REC7 and REC12")),
        done=t.site_code(F.lit("REC_3")),
        pad=t.site_code_padded(F.lit("rec5")),
        long=t.site_code_padded(F.lit("REC123b")),
        same=t.site_code_padded(F.lit("REC_3")),
        name=t.safe_name(F.lit("Form  responses (1)-x")),
        ident=t.location_id(F.lit("Barren Reef 2 DEEP")),
        typo=t.location_id(F.lit("Baren reef 10 shallow")),
        nothing=t.location_id(F.lit("Kelp Forest deep")),
    )
    assert got == {
        "nbsp": "a b c", "blank": None, "side": "12", "once": "REC_7 and REC12", "done": "REC_3",
        "pad": "REC_05", "long": "REC_123b", "same": "REC_3", "name": "Form_responses_1_-x",
        "ident": "BR2_deep", "typo": "BR10_shallow", "nothing": None,
    }


def test_recode_and_classify(spark):
    df = spark.createDataFrame([("KF1_deep",), ("Elsewhere",), (None,)], "s string")
    coded = df.select(t.recode("s", {"KF1D": ["KF1_deep"], "X": ["x"]}).alias("c"), t.classify("s", [("^kf", "kelp")]).alias("k"))
    assert [tuple(r) for r in coded.collect()] == [("KF1D", "kelp"), ("Elsewhere", None), (None, None)]


def test_dates(spark):
    both = [*d.YEAR_FIRST, *d.MONTH_FIRST]
    got = one(
        spark,
        a=d.parse_date(F.lit("2025-07-01")), b=d.parse_date(F.lit("7/1/2025"), both),
        c=d.parse_date(F.lit("rubbish"), both), e=d.week_start(F.lit(date(2026, 3, 8))),
        f=d.latest_of(F.lit(None).cast("date"), F.lit(date(2024, 1, 2))),
        g=d.days_between(F.lit(date(2024, 3, 1)), F.lit(date(2024, 2, 28))),
        h=d.parse_date(F.lit("20250701")),
    )
    assert got == {
        "a": date(2025, 7, 1), "b": date(2025, 7, 1), "c": None, "e": date(2026, 3, 2),
        "f": date(2024, 1, 2), "g": 2.0, "h": date(2025, 7, 1),
    }


#: Every form with good, bad and borderline text.
WRITTEN = [
    "2024-01-05", "2024-1-5", "2024/2/30", "2024/2/29", "20240105", "20241305", "2024-01-05 10:11:12", "2024-01-05T10:11:12", "2024-01-05T10:11:12.123",
    "2024-01-05 25:11:12", "1/5/2024", "13/5/2024", "1-5-2024", "1/5/2024 9:05", "1/5/2024 9:05:59", "1/5/2024 24:05", "2024", "2024-05", " 2024-01-05",
    "2024-01-05 ", "rubbish", "", "2024-01-05 1:02:03", "2024-13-01", "2024-02-29\n", "2023-02-29", "12/31/1999", "5d", "7F", None, "2024-01-05 10:11",
    "99999-01-01", "+2024-01-01", "2024-01-05Z", "2/30/2024", "1/5/24", "2024-00-10", "0/5/2024",
]


def test_one_parse_reads_what_a_parse_for_each_form_reads(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(WRITTEN)], "i int, c string")
    moments = [*d.MOMENTS, *d.YEAR_FIRST, *d.MONTH_FIRST]
    by_form = {
        "any": (d.parse_date("c", d.ANY_DATE), F.coalesce(*[F.try_to_date("c", f) for f in d.ANY_DATE])),
        "year_first": (d.parse_date("c"), F.coalesce(*[F.try_to_date("c", f) for f in d.YEAR_FIRST])),
        "moment": (d.parse_moment("c"), F.coalesce(*[F.try_to_timestamp(F.col("c"), F.lit(f)) for f in moments])),
    }
    for name, (got, want) in by_form.items():
        for r in df.select("c", got.alias("got"), want.alias("want")).collect():
            assert r.got == r.want, (name, r)


def test_forms_given_by_the_caller(spark):
    df = spark.createDataFrame([("31/1/2024",), ("2/1/2024",), ("5 Jan 2024",), ("1/31/2024",)], "c string")
    read = lambda *forms: [r.x for r in df.select(d.day_of(df, "c", forms).alias("x")).collect()]
    assert read("d/M/yyyy") == [date(2024, 1, 31), date(2024, 1, 2), None, None]
    # the first form that can be meant is taken; a form with a month's name is left to the parser
    assert read("M/d/yyyy", "d/M/yyyy", "d MMM yyyy") == [date(2024, 1, 31), date(2024, 2, 1), date(2024, 1, 5), date(2024, 1, 31)]


def test_a_cell_is_parsed_once(spark):
    """The plan holds one pattern for a date column, whatever the number of forms and of columns built on it."""
    df = spark.createDataFrame([("2024-01-05",)], "c string").withColumn("day", d.parse_date("c", d.ANY_DATE))
    df = df.select("day", F.coalesce("day", F.current_date()).alias("x"), F.when(F.col("day") > date(2024, 1, 1), F.col("day")).alias("y"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 1 and "gettimestamp" not in plan


def test_models(spark):
    got = one(
        spark, small=m.biomass_g(F.lit(1.0)), none=m.biomass_g(F.lit(None).cast("double")),
        flat=m.rescale(F.lit(3.0), F.lit(3.0), F.lit(3.0), (5.0, 25.0)),
        top=m.rescale(F.lit(4.0), F.lit(2.0), F.lit(4.0), (5.0, 25.0)),
        rank=n.level_rank(F.lit("b"), ["a", "b"]), norank=n.level_rank(F.lit("z"), ["a", "b"]),
    )
    assert got == {"small": 0.5, "none": None, "flat": 15.0, "top": 25.0, "rank": 2, "norank": None}


def test_missing_sorts_last_both_ways(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert [r.x for r in df.orderBy(*n.nulls_last("x")).collect()] == [1, 2, None]
    assert [r.x for r in df.orderBy(*n.nulls_last("x", descending=True)).collect()] == [2, 1, None]
