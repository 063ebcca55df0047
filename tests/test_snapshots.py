"""All tables of a run become visible in one step."""
import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvio.plans import run_cycles as R
from pluvio.plans.catalog import MODELS, RegionSpec, region_models_df
from pluvio.session import work_path
from pluvio.sources import sinks, snapshots as SN

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture()
def world(spark):
    ring = [[0.0, 10.0], [1.0, 10.0], [1.0, 9.0], [0.0, 9.0], [0.0, 10.0]]
    polys = spark.createDataFrame([("r", 7, {"NAME": "a"}, [[ring]])],
                                  "region string, cat_id long, props map<string,string>, coordinates array<array<array<array<double>>>>")
    gd = spark.createDataFrame([("r", "gfs", 0.0, 10.0, 1.0, 1.0, 10, 10, 4)],
                               "region string, model string, x0 double, y_top double, dx double, dy double, n_rows int, n_cols int, factor int")
    thr = spark.createDataFrame([(7, "01FFG2023010100", 3.0)], "cat_id long, product string, threshold double")
    rm = region_models_df(spark, {"r": RegionSpec("r", "r", 0, 15, -90, 10, ("gfs",))})
    out = work_path(spark, "snap")

    def run(value, cycles=(0, 1)):
        rows = [("r", "gfs", T0 + dt.timedelta(days=c), 6, T0 + dt.timedelta(days=c, hours=6), 0, 0, value + c) for c in cycles]
        grid = spark.createDataFrame(rows, "region string, model string, cycle timestamp, step_h int, valid_time timestamp, row int, col int, value double")
        return R.run_cycles(spark, grid, polys, gd, out, model_specs={"gfs": dataclasses.replace(MODELS["gfs"], n_steps=1)}, region_models=rm,
                            thresholds=thr, snapshots=True, reference_csv=True)
    return run, out


def _seen(spark, out):
    at = SN.snapshot(spark, out)
    get = lambda t, *c: {r["cycle"].day: tuple(r[x] for x in c) for r in SN.read_snapshot(spark, out, t, at).collect()}
    return get("results", "max"), get("scales", "max"), get("exceedance", "max", "cum_exceeds")


def _clobber(spark, out, day):
    key = spark.createDataFrame([("r", "gfs", T0 + dt.timedelta(days=day))], "region string, model string, cycle timestamp")
    SN.publish(key, out, "", "clobbered")


def test_a_run_that_breaks_off_leaves_the_old_snapshot(spark, world, monkeypatch):
    run, out = world
    assert run(2.0).count() == 2
    old = _seen(spark, out)
    assert old == ({1: (2.0,), 2: (3.0,)}, {1: (2.0,), 2: (3.0,)}, {1: (2.0, False), 2: (3.0, True)})
    _clobber(spark, out, 0)
    assert _seen(spark, out) == old                                      # still readable until it is redone
    for broken in ("catchment_summary", "threshold_compare", "chart_documents"):
        with monkeypatch.context() as m:
            m.setattr(R, broken, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError):
                run(9.0)
        assert _seen(spark, out) == old, broken                          # new results are written, and seen by no one
    assert SN.superseded_versions(spark, out, "results").count() == 3
    assert run(9.0).count() == 1                                         # the clobbered cycle alone
    assert _seen(spark, out) == ({1: (9.0,), 2: (3.0,)}, {1: (9.0,), 2: (3.0,)}, {1: (9.0, True), 2: (3.0, True)})
    assert run(9.0).count() == 0


def test_the_pointer_is_one_file_a_run(spark, world):
    import glob
    run, out = world
    run(2.0, cycles=range(6))
    assert len(glob.glob(f"{out.removeprefix('file:')}/published/part-*")) == 1
    assert len(SN.snapshot(spark, out).select("version").distinct().collect()) == 1


def test_one_state_of_the_pointer_reads_one_run(spark, world):
    """A reader who took the pointer before a second run sees the first in every table."""
    run, out = world
    run(2.0)
    path = work_path(spark, "at")
    SN.snapshot(spark, out).write.parquet(path)
    at = spark.read.parquet(path)
    _clobber(spark, out, 0)
    run(9.0)
    assert {r["max"] for t in ("results", "scales") for r in SN.read_snapshot(spark, out, t, at).filter(F.dayofmonth("cycle") == 1).collect()} == {2.0}
    now = SN.read_snapshot(spark, out, "results", current=True).collect()
    assert [(r["cycle"].day, r["max"]) for r in now] == [(2, 3.0)]
    plan = SN.read_snapshot(spark, out, "results", at)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_nothing_published_yet(spark):
    out = work_path(spark, "nothing")
    assert SN.snapshot(spark, out).count() == 0 and SN.pointer(spark, out).columns[-1] == "version"
    sinks.write_table(spark.createDataFrame([("r", "m", T0, "v1", 1)], "region string, model string, cycle timestamp, version string, x int"),
                      f"{out}/results", ["version", *sinks.PARTS])
    assert SN.read_snapshot(spark, out, "results").count() == 0
