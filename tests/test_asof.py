"""Thresholds as of their issue time; a backlog in waves."""
import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvio.operators import risk
from pluvio.plans import run_cycles as R
from pluvio.plans.catalog import MODELS, RegionSpec, region_models_df
from pluvio.session import work_path
from pluvio.sources import sinks
from pluvio.sources.results import thresholds_long
from pluvio.testing import views as V
from pluvio.testing.suite import _polys

SF = "/root/testdata/sf0.001"
DAY = lambda d, h=0: dt.datetime(2024, 1, d, h)


def _keyed(spark, cycles, cats=(1, 2)):
    return spark.createDataFrame([("r", "gfs", c, k) for c in cycles for k in cats], "region string, model string, cycle timestamp, cat_id long")


def test_latest_issue_not_after_the_cycle(spark):
    wide = spark.createDataFrame([(1, 10.0, 20.0, 30.0, 7.0), (2, 11.0, None, 31.0, None)],
                                 "BASIN long, 01FFG2024010512 double, 01FFG2024011000 double, 01FFG2024012006 double, other double")
    cycles = [DAY(5, 11), DAY(5, 12), DAY(9, 23), DAY(10), DAY(20, 5), DAY(20, 6), DAY(31)]
    got = {(r["cycle"], r["cat_id"]): r["threshold"] for r in risk.threshold_as_of(_keyed(spark, cycles), thresholds_long(wide)).collect()}
    assert got == {(DAY(5, 12), 1): 10.0, (DAY(9, 23), 1): 10.0, (DAY(10), 1): 20.0, (DAY(20, 5), 1): 20.0, (DAY(20, 6), 1): 30.0, (DAY(31), 1): 30.0,
                   # the second catchment has no value in the second issue: the first one goes on
                   (DAY(5, 12), 2): 11.0, (DAY(9, 23), 2): 11.0, (DAY(10), 2): 11.0, (DAY(20, 5), 2): 11.0, (DAY(20, 6), 2): 31.0, (DAY(31), 2): 31.0}


def test_families_regions_and_odd_names(spark):
    rows = [("r", 1, 2, "01FFG2024010100", 5.0), ("r", 1, 1, "01FFG2024010100", 4.0), ("q", 1, 1, "01FFG2024010100", 9.0),
            ("r", 1, 1, "03FFG2024010200", 8.0), ("r", 1, 1, "01FFG2024139900", 1.0), ("r", 1, 1, "plain", 2.0)]
    t = spark.createDataFrame(rows, "region string, cat_id long, ordinal long, product string, threshold double")
    got = sorted((r["family"], r["issued"], r["threshold"]) for r in risk.threshold_as_of(_keyed(spark, [DAY(3)]), t).collect())
    assert got == [("01FFG", DAY(1), 4.0), ("03FFG", DAY(2), 8.0)]
    assert risk.threshold_as_of(_keyed(spark, [DAY(3)]), t.limit(0)).count() == 0


def test_comparison_and_time_as_of(spark):
    t = thresholds_long(spark.createDataFrame([(1, 5.0, -999.0)], "BASIN long, 01FFG2024010100 double, 01FFG2024010300 double"))
    scales = _keyed(spark, [DAY(2), DAY(4)], (1,)).selectExpr("*", "6d as cum_mean", "1d as mean", "9d as max")
    got = {r["cycle"]: (r["threshold"], r["cum_exceeds"], r["mean_exceeds"]) for r in risk.threshold_compare(scales, t, as_of=True).collect()}
    assert got == {DAY(2): (5.0, True, False), DAY(4): (None, None, None)}                   # a sentinel is an issue without a threshold
    run = spark.createDataFrame([("r", "gfs", c, 1, c + dt.timedelta(hours=h), float(h)) for c in (DAY(2), DAY(4)) for h in (3, 6)],
                                "region string, model string, cycle timestamp, cat_id long, valid_time timestamp, cum double")
    got = {r["cycle"]: (r["reached_at"], r["lead_h"]) for r in risk.time_to_threshold(run, t, as_of=True).collect()}
    assert got == {DAY(2): (DAY(2, 6), 6), DAY(4): (None, None)}


@pytest.fixture()
def backlog(spark):
    def grid(n):
        return spark.range(n).select(
            F.lit(V.REGION).alias("region"), F.lit("gfs").alias("model"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 21600).alias("cycle"), F.lit(6).alias("step_h"),
            F.timestamp_seconds(F.lit(1704088800) + F.col("id") * 21600).alias("valid_time"),
            F.lit(0).alias("row"), F.lit(1).alias("col"), F.lit(2.5).alias("value"))
    rm = region_models_df(spark, {V.REGION: RegionSpec(V.REGION, "t", 0, 15, -90, 10, ("gfs",))})
    specs = {"gfs": dataclasses.replace(MODELS["gfs"], n_steps=1)}
    return lambda n, out, **kw: R.run_cycles(spark, grid(n), _polys(spark, SF), V.grid_def(spark, SF), out, region_models=rm, model_specs=specs, **kw)


def test_waves_do_what_one_run_does(spark, backlog):
    a, b = work_path(spark, "one-run"), work_path(spark, "waves")
    assert backlog(10, a).count() == backlog(10, b, wave=4).count() == 10
    for sub in ("results", "scales", "current"):
        x, y = (sorted(map(tuple, sinks.read_table(spark, f"{o}/{sub}").collect()), key=str) for o in (a, b))
        assert x == y and x, sub
    times = [r["n"] for r in R.read_runs(spark, f"{b}/runs").groupBy("updated_at").agg(F.count("*").alias("n")).orderBy("updated_at").collect()]
    assert times == [4, 4, 2]                                                   # each wave records its own cycles, oldest first
    assert backlog(10, b, wave=4).count() == 0


def test_a_broken_backlog_goes_on_with_its_wave(spark, backlog, monkeypatch):
    out, own, calls = work_path(spark, "broken"), R.record_runs, []

    def fails(*args, **kw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("the cluster is gone")
        return own(*args, **kw)

    monkeypatch.setattr(R, "record_runs", fails)
    with pytest.raises(RuntimeError):
        backlog(9, out, wave=3)
    assert R.read_runs(spark, f"{out}/runs").count() == 3                       # the first wave stays done
    monkeypatch.setattr(R, "record_runs", own)
    again = backlog(9, out, wave=3)
    assert again.count() == 6 and R.read_runs(spark, f"{out}/runs").select("cycle").distinct().count() == 9
