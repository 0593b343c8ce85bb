"""Landing, typing, sinks and snapshots."""

import glob
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.operators import grid
from fieldspark.plans import sst
from fieldspark.sources import landed, sinks, snapshot, typing


def test_names():
    raw = ["Site Name", "siteType2024", "% Cover", "2nd try", "Windows: CTRL+ALT / mac", "", "Site name"]
    assert [typing.clean_name(c) for c in raw] == [
        "site_name", "site_type2024", "percent_cover", "x2nd_try", "windows_ctrl_alt_mac", "x", "site_name",
    ]


def test_repeated_names_are_numbered(spark):
    df = spark.range(1).select(F.lit(1).alias("A b"), F.lit(2).alias("a B"), F.lit(3).alias("a_b"))
    assert typing.clean_names(df).columns == ["a_b", "a_b_2", "a_b_3"]


def test_landed_csv_and_first_row(spark, tmp_path, rows):
    text = "_row_id,Site Name,Count\n1,example,1\n2,REC7,n/a\n3,REC8,4\n"
    (tmp_path / "sheet.csv").write_text(text)
    df = landed.drop_first_row(landed.read_landed(spark, str(tmp_path / "sheet.csv"), "csv"))
    typed = typing.apply_schema(df, T.StructType([T.StructField("count", T.DoubleType())]))
    assert rows(typed, "site_name", "count") == [("REC7", None), ("REC8", 4.0)]


def test_csv_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", date(2025, 1, 2), 1.5), ("b", None, None)], "k string, d date, x double")
    sinks.write_csv(df, str(tmp_path / "out"))
    assert rows(landed.read_csv(spark, str(tmp_path / "out"), df.schema)) == rows(df)


def test_grid_is_partitioned_by_year_and_pruned(spark, tmp_path):
    grid = spark.createDataFrame(
        [(datetime(y, 6, day), float(day)) for y in (2023, 2024, 2025) for day in (1, 2)], "time timestamp_ntz, anom double"
    )
    sinks.write_grid(grid, str(tmp_path / "grid"))
    back = landed.read_table(spark, str(tmp_path / "grid")).where("year = 2024 AND anom > 1")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == 1
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(anom), GreaterThan(anom,1.0)]" in plan


def test_sentinel_and_inference(spark):
    df = spark.createDataFrame([("1.5", "2025-07-01", "NULL", "x"), ("NULL", "NULL", "NULL", "NULL")],
                               "a string, b string, c string, d string")
    text = typing.all_text(df)
    schema = typing.infer_schema(text)
    assert [f.dataType.simpleString() for f in schema] == ["double", "date", "string", "string"]
    assert tuple(typing.apply_schema(text, schema).first()) == (1.5, date(2025, 7, 1), None, "x")


def test_every_kind_is_inferred(spark):
    cells = {
        "logical": ["T", "false", None, "TRUE"], "number": ["1", "-2.5e3", None, " 3 "], "year_first": ["2025-07-01", "2025/7/2", None, "2024-2-29"],
        "month_first": ["7/1/2025", "12-31-2024", None, "1/2/2025"], "both_orders": ["2025-07-01", "7/1/2025", None, None], "bad_day": ["2025-02-30", "2025-02-03", None, None],
        "moment": ["2025-07-01 08:00:00", "2025-07-01T08:00:00.25", None, "2025-07-02"], "month_moment": ["7/1/2025 8:05", "7/1/2025 23:59:59", None, "7/2/2025"],
        "digits": ["20250701", "20250702", None, None], "zeros": ["0", "1", None, None], "suffix": ["5d", "7F", None, None], "empty": [None] * 4, "code": ["T", "B", None, None],
    }
    df = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"{c} string" for c in cells))
    kinds = {f.name: f.dataType.simpleString() for f in typing.infer_schema(df)}
    assert kinds == {
        "logical": "boolean", "number": "double", "year_first": "date", "month_first": "date", "both_orders": "string", "bad_day": "string", "moment": "timestamp",
        "month_moment": "timestamp", "digits": "double", "zeros": "double", "suffix": "string", "empty": "string", "code": "string",
    }
    got = typing.type_convert(df).collect()
    assert [r.logical for r in got] == [True, False, None, True]
    assert [r.month_first for r in got] == [date(2025, 7, 1), date(2024, 12, 31), None, date(2025, 1, 2)]
    assert [r.moment for r in got] == [datetime(2025, 7, 1, 8), datetime(2025, 7, 1, 8, 0, 0, 250000), None, datetime(2025, 7, 2)]
    assert [r.month_moment for r in got] == [datetime(2025, 7, 1, 8, 5), datetime(2025, 7, 1, 23, 59, 59), None, datetime(2025, 7, 2)]
    assert typing.type_convert(df.limit(0)).dtypes == df.dtypes


def test_unreadable_cells_are_counted(spark):
    df = spark.createDataFrame([("1", "7/1/2025", "x"), ("5d", "soon", "y"), (None, None, "z"), ("7F", "2/30/2025", "z")], "n string, d string, t string")
    schema = T.StructType([T.StructField("n", T.DoubleType()), T.StructField("d", T.DateType()), T.StructField("t", T.StringType())])
    got = [tuple(r) for r in typing.unreadable(df, schema, {"d": ["M/d/yyyy"]}).collect()]
    assert got == [("n", "double", 2, "5d"), ("d", "date", 2, "2/30/2025")]


def test_inference_is_one_aggregate(spark, monkeypatch):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    calls = []
    kind, agg = type(df), type(df).agg
    monkeypatch.setattr(kind, "agg", lambda self, *x: calls.append(len(x)) or agg(self, *x))
    typing.infer_schema(df)
    assert calls == [12]


LAT, LON = grid.Tiling(32.0, 0.01, 10), grid.Tiling(-130.0, 0.01, 10)


@pytest.fixture(scope="module")
def tiled(spark, tmp_path_factory):
    """Four days of 100 x 100 cells, landed by stride in small row groups."""
    path = str(tmp_path_factory.mktemp("grid") / "fine")
    cells = spark.range(40_000).selectExpr(
        "timestamp_ntz '2025-06-01' + make_dt_interval(cast(id div 10000 AS int)) AS time", "32D + (id div 100) % 100 * 0.01D AS latitude",
        "-130D + id % 100 * 0.01D AS longitude", "cast(id AS double) AS sstAnom", "cast(id % 3 AS int) AS mask",
    )
    sinks.write_grid(cells.coalesce(1), path, tiles={"latitude": LAT, "longitude": LON}, row_group_bytes=16_384)
    return cells, path


def test_stride_skips_row_groups(spark, tiled):
    _, path = tiled
    strided = grid.tiled_stride(spark.read.parquet(path), {"latitude": (32.0, 10), "longitude": (-130.0, 10)}, {"latitude": LAT, "longitude": LON})
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = strided._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(latitude_residue,0)" in plan and "EqualTo(longitude_residue,0)" in plan
    groups = wanted = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            ends = [meta.row_group(g).column(names.index(f"{axis}_residue")).statistics for axis in ("latitude", "longitude")]
            groups += 1
            wanted += all(s.min <= 0 <= s.max for s in ends)
    assert groups >= 20 and wanted <= groups // 5
    assert strided.count() == 400


@pytest.mark.parametrize("first, n", [((32.0, -130.0), (10, 10)), ((32.03, -129.98), (5, 2)), ((32.0, -130.0), (4, 3)), ((32.07, -130.0), (20, 1))])
def test_tiled_stride_is_the_plain_stride(spark, tiled, first, n):
    cells, path = tiled
    axes = ("latitude", "longitude")
    strides = dict(zip(axes, zip(first, n)))
    got = grid.tiled_stride(spark.read.parquet(path), strides, {"latitude": LAT, "longitude": LON})
    want = grid.grid_stride(cells, {a: (grid.cell_index(a, start, 0.01), step) for a, (start, step) in strides.items()})
    assert sorted(r.sstAnom for r in got.collect()) == sorted(r.sstAnom for r in want.collect())


def test_fine_grid_from_a_tiled_landing(spark, tiled, rows):
    cells, path = tiled
    box = {"latitude": (32.0, 32.5), "longitude": (-130.0, -129.5)}
    plain = sst.tidy_fine_grid(cells, date(2025, 7, 1), box, stride=(2, 10, 10), first=date(2025, 6, 1))
    tiles = {"latitude": LAT, "longitude": LON}
    laid = sst.tidy_fine_grid(spark.read.parquet(path), date(2025, 7, 1), box, stride=(2, 10, 10), first=date(2025, 6, 1), year_column="year", tiles=tiles)
    assert rows(laid) == rows(plain) and laid.count() == 72


def test_typing_never_fails(spark):
    df = spark.createDataFrame([("12", "3.0", "yes"), ("x", "4", "7/4/2025")], "a string, b string, c string")
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.LongType()), T.StructField("c", T.DateType())])
    got = [tuple(r) for r in typing.apply_schema(df, schema, {"c": ["M/d/yyyy"]}).collect()]
    assert got == [(12.0, 3, None), (None, 4, date(2025, 7, 4))]


def test_snapshot_versions_and_latest(spark, tmp_path, rows):
    root = str(tmp_path)
    first = spark.createDataFrame([(1,)], "x int")
    snapshot.snapshot(first, root, "Form responses 1", datetime(2025, 1, 1))
    snapshot.snapshot(spark.createDataFrame([(2,)], "x int"), root, "Form responses 1", datetime(2025, 5, 1, 8))
    assert rows(snapshot.read_latest(spark, root, "Form responses 1")) == [(2,)]
    listing = snapshot.manifest(spark, root, "Form responses 1")
    listing = listing.select(snapshot.parse_stamp(F.col("snapshot_ts").cast("string")).alias("taken"))
    assert listing.count() == 2
    old = snapshot.expired(listing, "taken", datetime(2025, 5, 2))
    assert [r.taken for r in old.collect()] == [datetime(2025, 1, 1)]


def test_failed_snapshot_leaves_latest_alone(spark, tmp_path, rows):
    root = str(tmp_path)
    snapshot.snapshot(spark.createDataFrame([(1,)], "x int"), root, "tab", datetime(2025, 1, 1))
    broken = spark.range(3).select(F.raise_error(F.lit("mount is missing")).cast("int").alias("x"))
    with pytest.raises(Exception, match="mount is missing"):
        snapshot.snapshot(broken, root, "tab", datetime(2025, 1, 2))
    assert rows(snapshot.read_latest(spark, root, "tab")) == [(1,)]


def test_retention_counts_whole_days(spark):
    taken = [datetime(2025, 1, 1, 12), datetime(2025, 1, 2, 11, 59), datetime(2025, 1, 2, 12, 1)]
    df = spark.createDataFrame([(x,) for x in taken], "taken timestamp_ntz")
    # 91 days before 3 April noon is 2 January noon
    got = {r.taken for r in snapshot.expired(df, "taken", datetime(2025, 4, 3, 12)).collect()}
    assert got == set(taken[:2])
