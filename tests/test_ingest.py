"""The stream: steps in order from state, late steps, cycles that never fill, retries."""
import dataclasses
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from pluvio.operators.cycles import run_state
from pluvio.operators.grid import by_accumulation, deaccumulate, deaccumulate_from, step_manifest
from pluvio.operators.zonal import round_stats, zonal_stats
from pluvio.plans.catalog import MODELS
from pluvio.session import work_path
from pluvio.sources import sinks
from pluvio.streaming import ingest as ST

SPECS = {"gfs": dataclasses.replace(MODELS["gfs"], n_steps=4), "wrfpr": dataclasses.replace(MODELS["wrfpr"], n_steps=4)}
GRID = "region string, model string, cycle timestamp, step_h int, valid_time timestamp, row int, col int, value double"
T0 = dt.datetime(2024, 1, 1, 6)
KEYS = ["region", "model", "cycle", "step_h", "cat_id", "count", "max", "mean"]


def _rows(model, cycle, steps, cells=((0, 0), (0, 1), (1, 0))):
    out = []
    for s in steps:
        for r, c in cells:
            if (s + r + c) % 5 != 4:                                     # cells that miss a step
                v = None if (s * 3 + c) % 7 == 6 else s * (1.25 + r) + c * 0.5 + (s * s % 3) * 0.1
                out.append(("r", model, cycle, s, cycle + dt.timedelta(hours=s), r, c, v))
    return out


@pytest.fixture()
def world(spark):
    weights = spark.createDataFrame([("r", m, cat, r, c, w) for m in SPECS for cat, r, c, w in
                                     ((7, 0, 0, 3), (7, 0, 1, 2), (8, 1, 0, 5))],
                                    "region string, model string, cat_id long, row int, col int, w long")
    path = work_path(spark, "ing-weights")
    weights.write.parquet(path)
    cats = spark.createDataFrame([("r", 7), ("r", 8), ("r", 9)], "region string, cat_id long")

    class World:
        landing, out, ck, runs = (work_path(spark, f"ing-{n}") for n in ("land", "out", "ck", "runs"))

        def land(self, rows):
            sinks.write_table(spark.createDataFrame(rows, GRID).withColumn("var", F.lit("APCP")).withColumn("level", F.lit("surface"))
                              .coalesce(1), self.landing, mode="append", rebalance=False)

        def go(self):
            return ST.ingest(spark, self.landing, self.out, self.ck, spark.read.parquet(path), SPECS, catchments=cats,
                             runs_path=self.runs, max_files_per_trigger=1000)

        def forget_files(self):
            """Take the landed files away, as far as the stream could still read them."""
            for f in glob.glob(f"{self.landing.removeprefix('file:')}/region=*/**/*.parquet", recursive=True):
                os.truncate(f, 0)

        def results(self):
            return sorted(map(tuple, sinks.read_table(spark, self.out).select(*KEYS).collect()), key=str)

        def expected(self, rows):
            grid = spark.createDataFrame(rows, GRID)
            stats = zonal_stats(by_accumulation(grid, SPECS), spark.read.parquet(path), catchments=cats, steps=step_manifest(grid))
            return sorted(map(tuple, round_stats(stats).select(*KEYS).collect()), key=str)
    return World()


def test_a_batch_reads_its_new_steps_only(spark, world):
    """One step per batch; the files of earlier batches are emptied before the
    next one, so a batch that read them would fail."""
    every = []
    for k in range(4):
        rows = _rows("wrfpr", T0, [k + 1]) + _rows("gfs", T0, [6 * (k + 1)])
        every += rows
        world.land(rows)
        q = world.go()
        assert sum(p["numInputRows"] for p in q.recentProgress) == len(rows)      # each new row once
        world.forget_files()
        if k < 3:
            assert not glob.glob(f"{world.out.removeprefix('file:')}/region=*")    # nothing before a cycle is complete
    assert world.results() == world.expected(every)
    assert {r["state"] for r in run_state(spark.read.parquet(world.runs)).collect()} == {"done"}


def test_late_and_repeated_steps(spark, world):
    first, second, third = _rows("wrfpr", T0, [1, 4]), _rows("wrfpr", T0, [3]), _rows("wrfpr", T0, [2])
    other = _rows("wrfpr", T0 + dt.timedelta(days=2), [1, 2])
    world.land(first + other)
    world.go()
    world.land(second + _rows("wrfpr", T0 + dt.timedelta(days=2), [3]))
    world.go()
    world.land(third)
    world.go()
    assert world.results() == world.expected(first + second + third)             # the other cycle never fills
    done = {(r["model"], r["cycle"]) for r in spark.read.parquet(world.runs).collect()}
    assert done == {("wrfpr", T0)}
    # a step that comes in two files, after its cycle was published: the cycle opens again
    extra = _rows("wrfpr", T0, [3], cells=((1, 1), (5, 5)))
    world.land(extra)
    world.go()
    assert world.results() == world.expected(first + second + third + extra)
    # the last step of the other cycle
    rest = _rows("wrfpr", T0 + dt.timedelta(days=2), [4])
    world.land(rest)
    world.go()
    assert world.results() == world.expected(first + second + third + extra + other + _rows("wrfpr", T0 + dt.timedelta(days=2), [3]) + rest)


def test_a_batch_that_runs_again_changes_nothing(spark, world):
    world.land(_rows("wrfpr", T0, [1, 2]))
    world.go()
    world.land(_rows("wrfpr", T0, [3, 4]))
    world.go()
    once = world.results()
    # the last batch's commit is lost: Spark hands the batch out again
    for name in ("1", ".1.crc"):
        f = f"{world.ck.removeprefix('file:')}/commits/{name}"
        if os.path.exists(f):
            os.rename(f, f"{world.ck.removeprefix('file:')}-lost{name}")
    world.go()
    assert world.results() == once == world.expected(_rows("wrfpr", T0, [1, 2, 3, 4]))


def test_steps_one_by_one_equal_the_whole(spark):
    grid = spark.createDataFrame(_rows("wrfpr", T0, range(1, 12)), GRID)
    whole = sorted(map(tuple, deaccumulate(grid).collect()), key=str)
    got, last = [], grid.limit(0).drop("step_h")
    for s in range(1, 12):
        new = grid.filter(F.col("step_h") == s)
        steps, last = deaccumulate_from(new, last)
        path = work_path(spark, "one-by-one")
        last.write.parquet(path)
        got += map(tuple, steps.select(*grid.columns).collect())
        last = spark.read.parquet(path)
    assert sorted(got, key=str) == whole


def test_running_model_step_without_a_covered_cell(spark, world):
    """Every catchment has a row for every step, in running-total models too."""
    from pluvio.operators.cycles import RUN_KEYS
    from pluvio.plans.catalog import RegionSpec, region_models_df
    from pluvio.plans.run_cycles import read_runs, run_cycles
    specs = {m: dataclasses.replace(s, n_steps=2) for m, s in SPECS.items()}
    grid = spark.createDataFrame(_rows("wrfpr", T0, [1, 2], cells=((5, 5),)) + _rows("gfs", T0, [6, 12], cells=((5, 5),)), GRID)
    ring = [[0.0, 10.0], [1.0, 10.0], [1.0, 9.0], [0.0, 9.0], [0.0, 10.0]]
    polys = spark.createDataFrame([("r", 7, {"NAME": "a"}, [[ring]])],
                                  "region string, cat_id long, props map<string,string>, coordinates array<array<array<array<double>>>>")
    gd = spark.createDataFrame([("r", m, 0.0, 10.0, 1.0, 1.0, 10, 10, 4) for m in specs],
                               "region string, model string, x0 double, y_top double, dx double, dy double, n_rows int, n_cols int, factor int")
    rm = region_models_df(spark, {"r": RegionSpec("r", "r", 0, 15, -90, 10, ("gfs", "wrfpr"))})
    out = work_path(spark, "uncovered")
    done = run_cycles(spark, grid, polys, gd, out, model_specs=specs, region_models=rm)
    got = sorted((r["model"], r["step_h"], r["cat_id"], r["count"], r["mean"]) for r in sinks.read_table(spark, f"{out}/results").collect())
    assert got == [("gfs", 6, 7, 0, None), ("gfs", 12, 7, 0, None), ("wrfpr", 1, 7, 0, None), ("wrfpr", 2, 7, 0, None)]
    assert done.count() == 2 and read_runs(spark, f"{out}/runs").count() == 2
    # a region without catchments has no rows, and is not pending for ever
    out2 = work_path(spark, "no-catchments")
    run_cycles(spark, grid, polys.filter("cat_id = 1"), gd, out2, model_specs=specs, region_models=rm)
    assert read_runs(spark, f"{out2}/runs").select(*RUN_KEYS).distinct().count() == 2
    assert run_cycles(spark, grid, polys.filter("cat_id = 1"), gd, out2, model_specs=specs, region_models=rm).count() == 0
