"""Sinks (dynamic overwrite), GeoJSON forms, tiles and the incremental stream."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from pluvio.operators.risk import catchment_summary
from pluvio.operators.zonal import round_stats, zonal_stats
from pluvio.plans.workflow import materialise_weights
from pluvio.session import work_path
from pluvio.sources import grids, polygons, sinks
from pluvio.streaming.ingest import ingest

T0 = dt.datetime(2024, 1, 1, 0)


def _results(spark, cycles, value):
    rows = [("r", "gfs", c, 1, 0.5 * value, value, 3, T0 + dt.timedelta(days=7 * c),
             T0 + dt.timedelta(days=7 * c, hours=6)) for c in cycles]
    return spark.createDataFrame(rows, "region string, model string, cyc int, cat_id long, mean double, "
                                       "max double, count long, cycle timestamp, valid_time timestamp").drop("cyc")


def test_dynamic_overwrite_replaces_only_touched_partitions(spark):
    path = work_path(spark, "t-sink")
    sinks.write_table(_results(spark, [0, 1, 2], 1.0), path)
    sinks.write_table(_results(spark, [1], 9.0), path)
    got = {r["cycle"].day: r["max"] for r in sinks.read_table(spark, path).collect()}
    assert got == {1: 1.0, 8: 9.0, 15: 1.0}


def test_retention_and_superseded(spark):
    df = _results(spark, [0, 1, 2], 1.0)
    kept = [r["cycle"].day for r in sinks.retain_latest(df).collect()]
    gone = sorted(r["cycle"].day for r in sinks.superseded(df).collect())
    assert kept == [15] and gone == [1, 8]


def test_summary_poisoned_by_missing_mean(spark):
    df = _results(spark, [0, 1], 1.0).withColumn("mean", F.when(F.col("cycle").isNotNull(), F.lit(float("nan"))))
    df = df.withColumn("cycle", F.lit(T0).cast("timestamp"))
    ref = catchment_summary(df).collect()[0]
    clean = catchment_summary(df, semantics="clean").collect()[0]
    assert ref["cum_mean"] is None
    assert clean["cum_mean"] is None or clean["cum_mean"] == 0.0


def test_geojson_collection_and_polygon_type(spark, tmp_path):
    ring = [[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"cat_id": 7.0, "NAME": "a"},
         "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "properties": {"cat_id": 8, "NAME": "b"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring[:-1]]]}}]}
    p = tmp_path / "c.json"
    p.write_text(json.dumps(doc, indent=1))
    polys = polygons.read_geojson(spark, str(p), region="r", collection=True)
    edges = polygons.polygon_edges(polys)
    n = {r["cat_id"]: r["n"] for r in edges.groupBy("cat_id").agg(F.count("*").alias("n")).collect()}
    assert n == {7: 4, 8: 8}          # the open ring got its closing edge


def test_tiles_roundtrip(spark):
    rows = [("r", "m", 6, r, c, float(r * 10 + c) if (r + c) % 5 else None) for r in range(12) for c in range(16)]
    g = spark.createDataFrame(rows, "region string, model string, step_h int, row int, col int, value double")
    back = grids.explode_tiles(grids.make_tiles(g, size=4))
    assert {(r["row"], r["col"]): r["value"] for r in back.collect()} == {(r[3], r[4]): r[5] for r in rows}


def test_stream_equals_batch_and_is_replay_safe(spark):
    from pluvio.testing import views as V
    from pluvio.testing.suite import _polys
    sf = "/root/testdata/sf0.001"
    raw = V.raw_grid(spark, sf)
    landing, out, ck = work_path(spark, "t-land"), work_path(spark, "t-out"), work_path(spark, "t-ck")
    sinks.write_table(raw, landing)
    weights = materialise_weights(spark, _polys(spark, sf), V.grid_def(spark, sf))
    ingest(spark, landing, out, ck, weights, max_files_per_trigger=3)
    first = sorted(map(tuple, sinks.read_table(spark, out).select("model", "cycle", "valid_time", "cat_id",
                                                                  "count", "max", "mean").collect()))
    # a second run over the same checkpoint finds nothing new and changes nothing
    ingest(spark, landing, out, ck, weights, max_files_per_trigger=3)
    second = sorted(map(tuple, sinks.read_table(spark, out).select("model", "cycle", "valid_time", "cat_id",
                                                                   "count", "max", "mean").collect()))
    assert first == second
    from pluvio.operators.grid import by_accumulation, only_complete
    from pluvio.plans.catalog import models_df
    g = only_complete(by_accumulation(raw.drop("var", "level")), models_df(spark))
    batch = round_stats(zonal_stats(g, weights)).select("model", "cycle", "valid_time", "cat_id",
                                                       "count", "max", "mean")
    assert sorted(map(tuple, batch.collect())) == first


def test_step_files_time_from_name(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    for stamp in ("2024010106", "2024010112", "2024010118"):
        pq.write_table(pa.table({"row": [0, 1], "col": [2, 3], "value": [1.5, 2.5]}),
                       str(tmp_path / f"{stamp}.parquet"))
    (tmp_path / "notes.txt").write_text("not a grid")
    df = grids.read_step_files(spark, str(tmp_path))
    times = sorted({r["valid_time"].hour for r in df.collect()})
    assert times == [6, 12, 18] and df.count() == 6


def test_running_total_missing_propagates(spark):
    from pluvio.operators.series import running_total
    rows = [(1, T0 + dt.timedelta(hours=h), v) for h, v in ((6, 1.0), (12, float("nan")), (18, 2.0))]
    df = spark.createDataFrame(rows, "cat_id long, valid_time timestamp, mean double")
    got = [r["cum"] for r in running_total(df).orderBy("valid_time").collect()]
    assert got == [1.0, None, None]


def test_stream_records_only_what_it_wrote(spark):
    """A cycle marked clobbered stays so until a file of its own arrives; an
    incomplete one is not recorded; another variable changes nothing."""
    from pluvio.operators.cycles import run_state
    from pluvio.testing import views as V
    from pluvio.testing.suite import _polys
    sf = "/root/testdata/sf0.001"
    landing, out, ck, runs = (work_path(spark, f"s-{n}") for n in ("land", "out", "ck", "runs"))
    keys = ["region", "model", "cycle"]
    sinks.write_table(V.raw_grid_vars(spark, sf), landing)
    weights = materialise_weights(spark, _polys(spark, sf), V.grid_def(spark, sf))
    ingest(spark, landing, out, ck, weights, runs_path=runs)
    state = run_state(spark.read.parquet(runs))
    written = sinks.read_table(spark, out)
    assert sorted(map(tuple, state.select(*keys).collect())) == sorted(map(tuple, written.select(*keys).distinct().collect()))
    assert written.agg(F.max("max")).first()[0] < 99999                     # the second variable everywhere
    state.limit(1).select(*keys, F.lit("clobbered").alias("state"), F.current_timestamp().alias("updated_at")) \
        .write.mode("append").parquet(runs)
    ingest(spark, landing, out, ck, weights, runs_path=runs)                # no new file
    assert run_state(spark.read.parquet(runs)).filter("state = 'clobbered'").count() == 1


def test_chart_keeps_every_step(spark):
    from pluvio.operators.series import chart_json, chart_types
    rows = [("r", "gfs", T0, 1, T0 + dt.timedelta(hours=h), v) for h, v in ((6, 1.0), (12, None), (18, 2.0))]
    res = spark.createDataFrame(rows, "region string, model string, cycle timestamp, cat_id long, valid_time timestamp, mean double")
    thr = spark.createDataFrame([(1, "p", 5.0)], "cat_id long, product string, threshold double")
    got = {r["chart_type"]: [p[1] for p in json.loads(r["json"])["values"]] for r in chart_json(chart_types(res, thr, "p")).collect()}
    assert got == {"intervals": [1.0, None, 2.0], "cumulative": [1.0, None, None]}


def test_nodata_cell_is_not_differenced_across(spark):
    """1, no data, 5, 6: the step after the gap has no difference, through tiles as well."""
    from pluvio.operators.grid import deaccumulate
    rows = [("r", "wrfpr", T0, h, T0 + dt.timedelta(hours=h), 0, 0, v) for h, v in ((1, 1.0), (2, None), (3, 5.0), (4, 6.0))]
    g = spark.createDataFrame(rows, "region string, model string, cycle timestamp, step_h int, valid_time timestamp, "
                                    "row int, col int, value double")
    for grid in (g, grids.explode_tiles(grids.make_tiles(g, size=1))):
        assert [r["value"] for r in deaccumulate(grid).orderBy("step_h").collect()] == [1.0, None, None, 1.0]
        assert [r["value"] for r in deaccumulate(grid, clamp_negative=True).orderBy("step_h").collect()] == [1.0, None, None, 1.0]


def test_nan_reaches_no_class_and_no_threshold(spark):
    from pluvio.functions.classes import class_of, reference_class
    from pluvio.operators.risk import threshold_compare
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 40.0)], "cat_id long, v double")
    got = df.select(class_of("v", 5).alias("a"), reference_class("v", 5).alias("b")).collect()
    assert [tuple(r) for r in got] == [(None, None), (None, None), (6, 6)]
    thr = spark.createDataFrame([(i, "p", 5.0) for i in (1, 2, 3)], "cat_id long, product string, threshold double")
    scales = df.select("cat_id", F.col("v").alias("cum_mean"), F.col("v").alias("mean"), F.col("v").alias("max"))
    got = {r["cat_id"]: (r["cum_exceeds"], r["mean_exceeds"], r["max_exceeds"]) for r in threshold_compare(scales, thr, "p").collect()}
    assert got == {1: (None,) * 3, 2: (None,) * 3, 3: (True,) * 3}


def test_thresholds_csv_keeps_region_and_first_row(spark, tmp_path):
    from pluvio.operators.risk import first_thresholds
    from pluvio.sources.results import read_thresholds, thresholds_long
    p = tmp_path / "t.csv"
    p.write_text("BASIN,region,P1\n7,a,30.5\n7,a,-999\n7,b,12\n")
    long = thresholds_long(read_thresholds(spark, str(p)))
    got = {(r["region"], r["cat_id"]): r["threshold"] for r in first_thresholds(long, "P1").collect()}
    assert got == {("a", 7): 30.5, ("b", 7): 12.0}


def test_times_do_not_follow_the_session_zone(spark):
    from pluvio.functions import timefmt as T
    from pluvio.operators.cycles import latest_cycle
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.range(1).select(F.timestamp_seconds(F.lit(1704067200)).alias("ts"))         # 2024-01-01 00 UTC
        r = df.select(T.to_stamp("ts").alias("s"), T.fmt("ts", T.AXIS_ORIGIN).alias("o"), T.cycle_label(F.lit("GFS"), "ts").alias("l"),
                      F.unix_seconds(T.parse_stamp(F.lit("2024010100"))).alias("p"), T.parse_stamp(F.lit("2024130100")).alias("bad")).first()
        assert (r["s"], r["o"], r["l"], r["p"], r["bad"]) == (
            2024010100, "2024-01-01 00:00:00", "GFS data from Jan 01, 12AM UTC", 1704067200, None)
        got = latest_cycle(df).filter("model = 'gfs'").select(T.to_stamp("cycle").alias("c")).first()
        assert got["c"] == 2023123118
        path = work_path(spark, "zone")
        sinks.write_table(df.select(F.lit("r").alias("region"), F.lit("gfs").alias("model"), F.col("ts").alias("cycle"), F.lit(1).alias("x")), path)
        assert sinks.partition_listing(spark, path).select(F.unix_seconds("cycle")).first()[0] == 1704067200
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_no_shared_folder_is_an_error_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from pluvio.session import shared_dir
    option = SimpleNamespace(isDefined=lambda: False)
    sc = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: option)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=sc))
