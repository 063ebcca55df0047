"""The tile path equals the long path, and moves tiles only."""
import datetime as dt
import random

from pyspark.sql import functions as F

from pluvio.operators import grid as G, tiles as TL, zonal as Z
from pluvio.sources import grids
from pluvio.testing import views as V
from pluvio.testing.suite import _polys, _weights

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1, 6)
SCHEMA = "region string, model string, cycle timestamp, step_h int, valid_time timestamp, row int, col int, value double"


def _grid(spark, rnd, steps=6, rows=7, cols=9):
    out = []
    for s in range(1, steps + 1):
        for r in range(rows):
            for c in range(cols):
                v = rnd.choice([None, rnd.random() * 10 * s, rnd.random() * 10 * s])
                out.append(("r", "wrfpr", T0, s, T0 + dt.timedelta(hours=s), r, c, v))
    return spark.createDataFrame(out, SCHEMA)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_deaccumulated_tiles_equal_cells(spark):
    grid = _grid(spark, random.Random(1))
    tiles = grids.make_tiles(grid, size=4)
    for clamp in (False, True):
        got = grids.explode_tiles(TL.deaccumulate_tiles(tiles, clamp_negative=clamp)).filter("row < 7 and col < 9")
        assert _sorted(got.select(*grid.columns)) == _sorted(G.deaccumulate(grid, clamp_negative=clamp))


def test_a_step_without_a_tile_is_passed_over(spark):
    grid = _grid(spark, random.Random(2))
    some = grid.filter("not (step_h = 3 and row < 4 and col < 4)")
    got = grids.explode_tiles(TL.deaccumulate_tiles(grids.make_tiles(some, size=4))).filter("row < 7 and col < 9")
    assert _sorted(got.select(*grid.columns)) == _sorted(G.deaccumulate(some))


def test_stats_of_tiles_equal_those_of_cells(spark):
    """On the whole test data, with cells that are absent, missing or in no catchment."""
    raw = V.raw_grid(spark, SF).drop("var", "level")
    dense = grids.explode_tiles(grids.make_tiles(raw, size=4))
    weights, cats = _weights(spark, SF), _polys(spark, SF)
    long = Z.zonal_stats(G.by_accumulation(dense), weights, catchments=cats)
    tiled = TL.zonal_stats_of_tiles(TL.tiles_by_accumulation(grids.make_tiles(raw, size=4)), TL.tile_weights(weights, 4), catchments=cats)
    a, b = _sorted(long), _sorted(tiled.select(*long.columns))
    assert len(a) == len(b) > 1000
    for x, y in zip(a, b):
        assert x[:-1] == y[:-1] and (x[-1] == y[-1] or abs(x[-1] - y[-1]) < 1e-12)


def test_nothing_is_exploded(spark):
    tiles = grids.make_tiles(_grid(spark, random.Random(3)), size=4)
    plan = TL.deaccumulate_tiles(tiles.checkpoint())._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") == 1
    w = spark.createDataFrame([("r", "wrfpr", 7, 0, 0, 3), ("r", "wrfpr", 7, 5, 5, 2)],
                              "region string, model string, cat_id long, row int, col int, w long")
    stats = TL.zonal_stats_of_tiles(tiles.checkpoint(), TL.tile_weights(w, 4))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "partial_sum" in plan


def test_nan_and_empty_tiles(spark):
    nan = float("nan")
    tiles = spark.createDataFrame([("r", "gfs", T0, 6, T0, 0, 0, [[nan, 1.0], [None, nan]])],
                                  "region string, model string, cycle timestamp, step_h int, valid_time timestamp, "
                                  "tile_row0 int, tile_col0 int, values array<array<double>>")
    w = spark.createDataFrame([("r", "gfs", 7, 0, 0, 3), ("r", "gfs", 7, 0, 1, 2), ("r", "gfs", 8, 1, 0, 1)],
                              "region string, model string, cat_id long, row int, col int, w long")
    got = {r["cat_id"]: (r["count"], r["max"], r["mean"]) for r in TL.zonal_stats_of_tiles(tiles, TL.tile_weights(w, 2)).collect()}
    assert got == {7: (2, 1.0, 1.0), 8: (0, None, None)}
    assert TL.zonal_stats_of_tiles(tiles.limit(0), TL.tile_weights(w, 2)).count() == 0
    assert TL.deaccumulate_tiles(tiles.limit(0)).withColumn("x", F.lit(1)).count() == 0
