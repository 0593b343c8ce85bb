"""Operators against brute force, with hot keys and missing keys."""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark.operators import aggregates as ag
from fieldspark.operators import ordered, quality, reshape, sampling
from fieldspark.operators.asof import prior_event_asof, prior_event_in_place
from fieldspark.operators.joins import join_suffix, keep_members, missing_keys
from fieldspark.operators.sampling import weighted_sample
from fieldspark.operators.statistics import box_summary, fit_growth, histogram

DAY0 = date(2025, 1, 1)


def hot_keys(rng, n, names="abcd"):
    """A third of the rows under one key, some under none."""
    return [names[0] if rng.random() < 0.35 else rng.choice([*names, None]) for _ in range(n)]


@pytest.mark.parametrize("how", ["inner", "left", "full", "left_anti", "left_semi"])
def test_null_safe_join_is_a_nested_loop(spark, how):
    rng = random.Random(how)
    left = [(k, rng.choice([1, None]), i) for i, k in enumerate(hot_keys(rng, 30))]
    right = [(k, rng.choice([1, None]), 100 + i) for i, k in enumerate(hot_keys(rng, 12, "abxy"))]
    lf = spark.createDataFrame(left, "k string, j int, v int")
    rf = spark.createDataFrame(right, "kk string, j int, v int")
    got = Counter(tuple(r) for r in join_suffix(lf, rf, [("k", "kk"), "j"], how).collect())
    pairs = [(a, b) for a in left for b in right if a[:2] == b[:2]]
    want = Counter((a[0], a[1], a[2], b[2]) for a, b in pairs)
    alone = [a for a in left if not any(a[:2] == b[:2] for b in right)]
    if how in ("left", "full"):
        want += Counter((*a, None) for a in alone)
    if how == "full":
        want += Counter((b[0], b[1], None, b[2]) for b in right if not any(a[:2] == b[:2] for a in left))
    if how == "left_anti":
        want = Counter(alone)
    if how == "left_semi":
        want = Counter(a for a in left if a not in alone)
    assert got == want


def test_missing_keys_keeps_repeats_and_both_sides(spark, rows):
    a = spark.createDataFrame([("x", None), ("x", None), ("y", 1), (None, 1)], "k string, j int")
    b = spark.createDataFrame([("y", 1), ("z", 2), (None, 1)], "k string, j int")
    assert rows(missing_keys(a, b, ["k", "j"])) == [("x", None, 2)]
    assert rows(missing_keys(a, b, ["k", "j"], both=True)) == [("x", None, 2, "second"), ("z", 2, 1, "first")]
    assert rows(missing_keys(a, b, ["k", "j"], each_row=True)) == [("x", None), ("x", None)]
    assert rows(missing_keys(a, b, ["k", "j"], both=True, each_row=True)) == [
        ("x", None, "second"), ("x", None, "second"), ("z", 2, "first"),
    ]


def test_keep_members(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    lookup = spark.createDataFrame([("a", "north"), ("a", "north"), ("b", "south")], "id string, place string")
    assert rows(keep_members(df, lookup, ("k", "id"), F.col("place") == "north")) == [("a", 1)]


def asof_by_hand(left, right, keep):
    """left: (id, key, day); right: (key, day, ts, note)."""
    out = []
    for i, key, day in left:
        mine = [r for r in right if r[0] == key]
        fit = [r for r in mine if r[1] is None or (day is not None and r[1] < day)]
        if fit:
            last = max(fit, key=lambda r: (r[1] is None, r[1] or DAY0, r[2] is None, r[2] or 0))
            out.append((i, key, day, *last[1:]))
        elif not mine or keep:
            out.append((i, key, day, None, None, None))
    return Counter(out)


@pytest.mark.parametrize("unmatched", ["drop", "keep"])
def test_asof_against_brute_force(spark, unmatched):
    rng = random.Random(unmatched)
    day = lambda: None if rng.random() < 0.05 else DAY0 + timedelta(days=rng.randrange(8))
    left = [(i, k, day()) for i, k in enumerate(hot_keys(rng, 120, "abcdefgh"))]
    right = []
    for n, k in enumerate(hot_keys(rng, 25, "abcdxyz")):
        d = day() if k != "b" else DAY0 + timedelta(days=7)  # b has late events only
        right.append((k, d, rng.choice([None, n]), f"note {n}"))
    # equal (key, day, ts) would leave the winner open
    right = list({(r[0], r[1], r[2]): r for r in right}.values())
    lf = spark.createDataFrame(left, "id int, key string, asked date")
    rf = spark.createDataFrame(right, "key string, day date, ts int, note string")
    got = prior_event_asof(lf, rf, ["key"], "asked", "day", tie="ts", unmatched=unmatched)
    want = asof_by_hand(left, right, unmatched == "keep")
    assert Counter(tuple(r) for r in got.collect()) == want
    again = prior_event_asof(lf.repartition(7), rf.repartition(3), ["key"], "asked", "day", tie="ts", unmatched=unmatched)
    assert Counter(tuple(r) for r in again.collect()) == want


@pytest.mark.parametrize("unmatched", ["drop", "keep"])
def test_asof_in_place_is_the_same(spark, unmatched):
    rng = random.Random(7)
    seen, table = set(), []
    for _ in range(150):
        row = (rng.choice(["a", "b", "c", None]), rng.choice([None, *[DAY0 + timedelta(days=i) for i in range(25)]]),
               rng.choice(["in", "out"]))
        if row not in seen and not (row[1] is None and row[0] in ("a", "b")):
            seen.add(row)
            table.append((*row, len(table)))
    df = spark.createDataFrame(table, "key string, day date, kind string, n int")
    got = prior_event_in_place(df, ["key"], "day", F.col("kind") == "in", {"in_day": "day", "in_n": "n"}, unmatched)
    events = df.where("kind = 'in'").select("key", F.col("day").alias("in_day"), F.col("n").alias("in_n"))
    want = prior_event_asof(df.where("kind = 'out'"), events, ["key"], "day", "in_day", "in_n", unmatched)
    assert Counter(tuple(r) for r in got.collect()) == Counter(tuple(r) for r in want.collect())


def test_asof_rejects_bad_arguments(spark):
    df = spark.createDataFrame([("a", DAY0)], "k string, d date")
    with pytest.raises(ValueError):
        prior_event_asof(df, df, ["k"], "d", "d")
    with pytest.raises(ValueError):
        prior_event_asof(df, df.withColumnRenamed("d", "e"), ["k"], "d", "e", unmatched="maybe")


def test_summarise_against_brute_force(spark):
    rng = random.Random(3)
    data = []
    for i, k in enumerate(hot_keys(rng, 200)):
        data.append((i, k, rng.choice([None, 1.0, 2.5]), rng.choice([None, "x", "y", "zz"]),
                     rng.choice([None, True, False]), rng.choice([None, "n1", "n2", "n3"])))
    df = spark.createDataFrame(data, "i long, k string, v double, s string, f boolean, note string")
    got = ag.summarise(
        df.repartition(5), ["k"],
        {"n": ("rows", None), "total": ("sum", "v"), "lo": ("min", "v"), "any": ("any", "f")},
        distinct_counts={"kinds": "s"}, sorted_texts={"all": "s"}, ordered_texts={"notes": "note"},
        first_texts={"first": "note"}, order=F.col("i"),
    )
    groups = defaultdict(list)
    for r in data:
        groups[r[1]].append(r)
    want = {}
    for k, g in groups.items():
        v = [r[2] for r in g if r[2] is not None]
        s = {r[3] for r in g if r[3] is not None}
        notes = list(dict.fromkeys(r[5] for r in g if r[5] is not None))
        want[k] = (len(g), sum(v), min(v, default=None), any(r[4] for r in g), len(s),
                   " | ".join(sorted(s)) or None, " | ".join(notes) or None, notes[0] if notes else None)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_summarise_of_nothing(spark):
    df = spark.createDataFrame([("a", None, None)], "k string, v double, s string")
    row = ag.summarise(df, ["k"], {"n": ("rows", None), "t": ("sum", "v"), "m": ("max", "v")},
                       sorted_texts={"s": "s"}, distinct_counts={"d": "s"}).first()
    assert tuple(row) == ("a", 1, 0.0, None, 0, None)


def test_arrival_order(spark):
    from datetime import datetime

    df = spark.createDataFrame(
        [(3, datetime(2025, 1, 1)), (1, datetime(2025, 1, 1)), (2, None), (0, datetime(2025, 1, 2))],
        "_row_id long, ts timestamp_ntz",
    )
    got = [r._row_id for r in df.orderBy(ag.arrival_order("ts", "_row_id")).collect()]
    assert got == [1, 3, 0, 2]


def test_last_per_group_puts_missing_last(spark, rows):
    df = spark.createDataFrame([("a", DAY0, 1), ("a", None, 2), ("b", DAY0, 3), ("b", DAY0, 4), (None, DAY0, 5)],
                               "k string, d date, n int")
    assert rows(ag.last_per_group(df, ["k"], ["d", "n"])) == [("a", None, 2), ("b", DAY0, 4), (None, DAY0, 5)]


def test_numeric_means_and_pivot(spark, rows):
    df = spark.createDataFrame([("a", "p", 1.0, 2), ("a", "q", None, 4), ("b", "r", 5.0, None)],
                               "k string, sp string, x double, y int")
    assert rows(ag.numeric_means(df, ["k"])) == [("a", 1.0, 3.0), ("b", 5.0, None)]
    wide = reshape.pivot_stats(df, ["k"], "sp", ["p", "q"],
                               {"m": F.avg("x"), "n": F.nullif(F.count(F.lit(1)), F.lit(0))})
    assert wide.columns == ["k", "m_p", "m_q", "n_p", "n_q"]
    assert rows(wide) == [("a", 1.0, None, 1, 1), ("b", None, None, None, None)]


def test_split_and_unpivot(spark, rows):
    df = spark.createDataFrame([(1, "a b, ,c  d,"), (2, None), (3, " ")], "i int, s string")
    assert rows(reshape.split_to_rows(df, "s")) == [(1, "a b"), (1, "c d")]
    long = reshape.to_long(spark.createDataFrame([(1, 2.0, None)], "i int, a double, b double"), ["i"], ["a", "b"], "t", "v")
    assert rows(long) == [(1, "a", 2.0), (1, "b", None)]


def test_running_total_with_hot_key(spark):
    rng = random.Random(5)
    data = {(k, round(rng.uniform(-3, 2000), 3)): rng.randrange(1, 9) for k in hot_keys(rng, 300)}
    df = spark.createDataFrame([(k, x, w) for (k, x), w in data.items()], "k string, x double, w long")
    got = {(r.k, r.x): (r.weight_before, r.weight_total) for r in ordered.running_total(df, ["k"], "x", "w").collect()}
    for (k, x), pair in got.items():
        mine = [(y, w) for (kk, y), w in data.items() if kk == k]
        assert pair == (sum(w for y, w in mine if y < x), sum(w for _, w in mine))
    assert len(got) == len(data)


def test_exact_quantiles_with_hot_key(spark):
    rng = np.random.default_rng(1)
    values = {"a": rng.lognormal(2, 1, 400).round(1), "b": np.array([3.0]), "c": np.repeat(7.5, 9),
              "d": rng.normal(0, 5, 100)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs] + [("a", None)], "k string, v double")
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    got = {r.k: r for r in ordered.exact_quantiles(df, ["k"], "v", probs).collect()}
    for k, vs in values.items():
        assert got[k].n == len(vs)
        for name, p in probs.items():
            assert abs(got[k][name] - np.quantile(vs, p)) < 1e-9


def test_box_summary(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values] + [(None, 5.0)], "k string, v double")
    got = {r.k: r for r in box_summary(df, ["k"], "v").collect()}
    a = got["a"]
    assert (a.q1, a.median, a.q3, a.lower_whisker, a.upper_whisker, a.n_outliers) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)
    assert got[None].median == 5.0


@pytest.mark.parametrize("low, step", [(7.0, 1e-10), (-5e8, 1e5), (1e-12, 1e-15)])
def test_a_narrow_or_wide_range_has_many_cells(spark, low, step):
    """No task orders more than a small share of a group's values, however close together they lie."""
    df = spark.range(20_000).select(F.lit("a").alias("k"), (F.lit(low) + F.col("id") * F.lit(step)).alias("v"))
    counted = ordered.with_cells(df.unionByName(df.limit(1).withColumn("k", F.lit("b"))), ["k"], "v")
    sizes = [r["count"] for r in counted.where("k = 'a'").groupBy("__cell").count().collect()]
    assert len(sizes) >= 200 and max(sizes) <= 20_000 // 100
    rising = counted.where("k = 'a'").groupBy("__cell").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("__cell").collect()
    assert all(x.hi < y.lo for x, y in zip(rising, rising[1:]))
    got = {r.k: r for r in ordered.exact_quantiles(df, ["k"], "v", {"q": 0.25, "m": 0.5}).collect()}
    values = np.array([r.v for r in df.collect()])
    assert got["a"].m == pytest.approx(np.quantile(values, 0.5), rel=1e-12) and got["a"].q == pytest.approx(np.quantile(values, 0.25), rel=1e-12)


def test_infinite_and_missing_values_are_left_out_of_charts(spark, rows):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([("a", v) for v in (1.0, 3.0, inf, -inf, nan, None)] + [("b", inf)], "k string, v double")
    got = box_summary(df, ["k"], "v").collect()
    assert [(r.k, r.n, r.q1, r.median, r.q3, r.lower_whisker, r.upper_whisker, r.n_outliers) for r in got] == [("a", 2, 1.5, 2.0, 2.5, 1.0, 3.0, 0)]
    assert rows(histogram(df, "v", ["k"], 2), "k", "bin", "n", "bin_start", "bin_end") == [("a", 0, 1, 1.0, 2.0), ("a", 1, 1, 2.0, 3.0)]


def test_histogram_ends(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "v double")
    got = {r.bin: (r.n, r.bin_start, r.bin_end) for r in histogram(df, "v", [], 5).collect()}
    assert got == {0: (1, 0.0, 2.0), 2: (1, 4.0, 6.0), 4: (1, 8.0, 10.0)}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [(r.bin, r.n) for r in histogram(flat, "v", [], 5).collect()] == [(0, 2)]


def test_growth_fit_recovers_coefficients(spark):
    rng = np.random.default_rng(1985)
    x = rng.uniform(10, 70, 400)
    y = -14.2 + 7.44 * np.exp(0.041 * x) + rng.normal(0, 1, 400)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0)], "x double, y double")
    fit = fit_growth(df, "x", "y").first()
    assert fit.converged and fit.n == 400
    assert abs(fit.a + 14.2) < 2 and abs(fit.b - 7.44) < 1 and abs(fit.c - 0.041) < 0.002
    # at the optimum no small step lowers the residual sum
    rss = lambda a, b, c: float(np.sum((y - a - b * np.exp(c * x)) ** 2))
    assert abs(rss(fit.a, fit.b, fit.c) - fit.rss) < 1e-6 * fit.rss
    for step in ((0.01, 0, 0), (0, 0.01, 0), (0, 0, 1e-5)):
        assert rss(fit.a + step[0], fit.b + step[1], fit.c + step[2]) >= fit.rss - 1e-9


@pytest.mark.parametrize("a, b, c, noise", [
    (-14.2, 7.44, 0.041, 0.0), (1e9, 7.44, 0.041, 0.5), (3.0, -2.0, -0.2, 0.01), (0.0, 1e-6, 0.3, 1e-3), (5.0, 1.0, 1e-3, 1e-6),
])
def test_growth_fit_of_other_curves(spark, a, b, c, noise):
    """No noise, a large offset, decay, a steep and a nearly straight curve; infinite and missing values are left out."""
    rng = np.random.default_rng(7)
    x = rng.uniform(10, 70, 300)
    y = a + b * np.exp(c * x) + noise * rng.normal(size=300)
    rows = [(float(p), float(q)) for p, q in zip(x, y)] + [(None, 1.0), (float("nan"), 1.0), (20.0, float("inf")), (20.0, None)]
    fit = fit_growth(spark.createDataFrame(rows, "x double, y double"), "x", "y").first()
    assert fit.converged and fit.n == 300 and fit.passes == 4
    assert abs(fit.c - c) < max(1e-7, 2e-2 * abs(c) * (noise > 0))
    grown = np.exp(fit.c * x)
    design = np.stack([np.ones(300), grown, x * grown], axis=1)
    design /= np.linalg.norm(design, axis=0)
    miss = y - fit.a - fit.b * grown
    # residuals at right angles to what each coefficient changes
    assert np.abs(design.T @ miss).max() <= 1e-5 * np.linalg.norm(miss) + 1e-9 * np.abs(y).max()


def test_growth_fit_says_when_there_is_no_curve(spark):
    flat = spark.createDataFrame([(float(i), 2.0) for i in range(9)], "x double, y double")
    with pytest.raises(ArithmeticError):
        fit_growth(flat, "x", "y")
    with pytest.warns(UserWarning, match="did not converge"):
        fit = fit_growth(flat, "x", "y", strict=False).first()
    assert not fit.converged and fit.n == 9


def test_growth_fit_needs_data(spark):
    with pytest.raises(ValueError):
        fit_growth(spark.createDataFrame([(None, 1.0)], "x double, y double"), "x", "y")


ZONES = [("a", 5000.4), ("b", 2.5), ("c", 0.4), (None, 40.0), ("d", None)]


def zone_frames(spark):
    zones = spark.createDataFrame(ZONES, "site string, n double")
    dist = spark.createDataFrame([("a", 1.0, 0.25), ("a", 2.0, 0.25), ("a", 4.0, 0.5), (None, 3.0, 1.0)],
                                 "site string, size double, prob double")
    fallback = spark.createDataFrame([(9.0, 1.0)], "size double, prob double")
    return zones, dist, fallback


def draw(spark, parts=2, **kw):
    zones, dist, fallback = zone_frames(spark)
    return weighted_sample(zones.repartition(parts), dist.repartition(parts), ["site"], "n", "size", "prob", fallback, **kw)


def test_weighted_draws(spark):
    got = Counter((r.site, r["size"]) for r in draw(spark, chunk=1000).collect())
    assert sum(v for (s, _), v in got.items() if s == "a") == 5000
    # b has no distribution of its own and draws 2 (half-even) from the fallback; c and d draw none
    assert got[("b", 9.0)] == 2 and got[(None, 3.0)] == 40
    assert not [1 for s, _ in got if s in ("c", "d")]
    for size, p in ((1.0, 0.25), (2.0, 0.25), (4.0, 0.5)):
        assert abs(got[("a", size)] / 5000 - p) < 0.03


def test_weighted_draws_repeat_exactly(spark):
    runs = [sorted(map(str, draw(spark, parts=p, chunk=c).collect())) for p, c in ((1, 100), (5, 4096))]
    assert runs[0] == runs[1]
    other = sorted(map(str, draw(spark, seed=7).collect()))
    assert other != runs[0] and len(other) == len(runs[0])


def test_places_grow_with_the_draws(spark, monkeypatch):
    """One size takes all draws of a group, and all other groups share the fallback: no place gets more than its share."""
    monkeypatch.setattr(sampling, "PLACE_DRAWS", 500)
    zones = spark.createDataFrame([("a", 20_000.0)] + [(f"z{i}", 400.0) for i in range(40)], "site string, n double")
    dist = spark.createDataFrame([("a", 1.0, 1.0)], "site string, size double, prob double")
    fallback = spark.createDataFrame([(9.0, 1.0)], "size double, prob double")
    out = weighted_sample(zones, dist, ["site"], "n", "size", "prob", fallback, chunk=100)
    got = Counter((r.site, r["size"]) for r in out.collect())
    assert got == Counter({("a", 1.0): 20_000, **{(f"z{i}", 9.0): 400 for i in range(40)}})
    seen = []
    kind = type(zones)
    join = kind.join

    def spy(self, other, *rest, **named):
        if "__place" in self.columns and "draw" in self.columns:
            seen.append(Counter(r["__place"] for r in self.select("__place").collect()))
        return join(self, other, *rest, **named)

    monkeypatch.setattr(kind, "join", spy)
    weighted_sample(zones, dist, ["site"], "n", "size", "prob", fallback, chunk=100)
    assert len(seen[0]) > 50 and max(seen[0].values()) <= 1600


def test_weighted_draws_hit_every_point_of_the_range(spark):
    zones = spark.createDataFrame([("a", 1000.0)], "site string, n double")
    dist = spark.createDataFrame([("a", float(i), 1 / 7) for i in range(7)], "site string, size double, prob double")
    even = weighted_sample(zones, dist, ["site"], "n", "size", "prob", uniform=lambda i: (i - 1) / F.lit(1000.0))
    edge = weighted_sample(zones, dist, ["site"], "n", "size", "prob", uniform=lambda i: F.lit(1 - 2**-53))
    assert even.count() == 1000
    assert {r["size"] for r in edge.collect()} == {6.0} and edge.count() == 1000


def test_quality_checks(spark, rows):
    df = spark.createDataFrame([("a", 1.0, None), ("a", -1.0, "x"), ("b", 0.0, "x"), ("c", None, None)],
                               "k string, d double, label string")
    assert rows(quality.dup_keys(df, ["k"])) == [("a", 2)]
    assert rows(quality.bad_duration(df, "d"), "k") == [("a",), ("b",)]
    assert rows(quality.unclassified(df, "label", "k")) == [("a",), ("c",)]
    assert rows(quality.unmatched(df, "d", ["k"])) == [("c", 1)]
    assert rows(quality.recode_audit(df, "k", "label")) == [("a", "x", 1), ("a", None, 1), ("b", "x", 1), ("c", None, 1)]


def test_quality_report_is_the_single_checks_in_one_pass(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 1.0, None, "x", 2024), ("a", 1, -1.0, "l", None, 2024), ("b", None, 0.0, "l", "x", 2025), (None, 2, None, None, None, 2025)],
        "k string, j int, d double, label string, partner string, year int",
    )
    report = quality.quality_report(df, ["k", "j"], {"label": "k"}, {"partner": ["k", "j"]}, ["d"], {"k": "label"}, {"year": [2024, 2026]})
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 2 and "Join" not in plan
    assert rows(report) == sorted([
        ("rows", "", "", 4), ("duplicate_key", "k | j", "a | 1", 2), ("unclassified", "k", "a", 1), ("unclassified", "k", "NA", 1),
        ("unmatched", "partner", "a | 1", 1), ("unmatched", "partner", "NA | 2", 1), ("bad_duration", "d", "a | 1 | -1.0", 1), ("bad_duration", "d", "b | NA | 0.0", 1),
        ("recode", "label", "a -> NA", 1), ("recode", "label", "a -> l", 1), ("recode", "label", "b -> l", 1), ("recode", "label", "NA -> NA", 1), ("empty", "year", "2026", 0),
    ], key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(quality.quality_report(df.limit(0), ["k"], required={"year": [2024]})) == [("empty", "year", "2024", 0)]


def test_text_lists_in_the_order_of_a_collation(spark):
    names = ["zebra", "Ökologie", "Beta", "beta", "Álamo", "alamo", "álamo", "Alamo", None]
    df = spark.createDataFrame([("k", n) for n in names] + [("none", None)], "k string, name string")
    listed = lambda **how: {r.k: r.names for r in ag.summarise(df, ["k"], {}, sorted_texts={"names": "name"}, **how).collect()}
    assert listed(collation="UNICODE") == {"k": "alamo | Alamo | álamo | Álamo | beta | Beta | Ökologie | zebra", "none": None}
    # texts that are equal to a collation stay apart
    assert listed(collation="UNICODE_CI_AI")["k"] == "Alamo | alamo | Álamo | álamo | Beta | beta | Ökologie | zebra"
    assert listed()["k"] == " | ".join(sorted(n for n in names if n))


def test_years_must_have_rows(spark, rows):
    df = spark.createDataFrame([(2024, 1), (2025, 2), (2030, 3)], "year int, v int")
    assert rows(quality.require_years(df, "year", [2024, 2025])) == rows(df)
    with pytest.raises(Exception, match="no rows for year 2026"):
        quality.require_years(df, "year", [2024, 2026]).collect()
    with pytest.raises(Exception, match="no rows for year"):
        quality.require_years(df.where("v > 5"), "year", [2024]).collect()
