"""Grids as tiles of arrays: de-accumulation and zonal statistics without a row per cell.

A tile is one row: step keys, ``tile_row0, tile_col0`` and ``values``, a
``T x T`` array of arrays (``sources.grids.make_tiles``).  Every operator here
works on whole arrays, so what is shuffled or sorted is a row per tile, T * T
times fewer than cells.  A cell without data is null (or NaN) in its array; its
step exists, so nothing is differenced across it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.zonal import STEP_KEYS, UNIT, _finished
from pluvio.plans.catalog import MODELS

TILE_KEYS = ["region", "model", "cycle", "var", "level", "tile_row0", "tile_col0"]


def deaccumulate_tiles(tiles: DataFrame, values: str = "values", clamp_negative: bool = False) -> DataFrame:
    """G1 on tiles: each array less that of the tile's previous available step.

    The first step is kept as it is.  A missing cell, or one that was missing at
    the previous step, is missing in the difference.  The window holds one
    tile's steps of one cycle.
    """
    keys = [k for k in TILE_KEYS if k in tiles.columns]
    w = Window.partitionBy(*keys).orderBy("valid_time")
    less = lambda a, b: a - b                                                    # noqa: E731  null if either is
    if clamp_negative:
        less = lambda a, b: F.when((a - b).isNotNull(), F.greatest(a - b, F.lit(0.0)))
    t = tiles.withColumn("_before", F.lag(values).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    diff = F.zip_with(values, "_before", lambda row, before: F.zip_with(row, before, less))
    return t.withColumn(values, F.when(F.col("_first"), F.col(values)).otherwise(diff)).drop("_before", "_first")


def tiles_by_accumulation(tiles: DataFrame, models: dict | None = None, values: str = "values") -> DataFrame:
    """G1/G2 by model on tiles: running-total models are differenced, the rest pass."""
    running = [m.name for m in (models or MODELS).values() if m.accumulation == "running"]
    run = deaccumulate_tiles(tiles.filter(F.col("model").isin(running)), values)
    return run.unionByName(tiles.filter(~F.col("model").isin(running)))


def tile_weights(weights: DataFrame, size: int = 8) -> DataFrame:
    """Cell weights by tile and catchment: ``cells``, an array of ``(r, c, w)``
    with places inside the tile (at most size * size of them)."""
    r0, c0 = F.col("row") - F.pmod("row", F.lit(size)), F.col("col") - F.pmod("col", F.lit(size))
    cell = F.struct((F.col("row") - r0 + 1).cast("int").alias("r"), (F.col("col") - c0 + 1).cast("int").alias("c"), F.col("w").cast("long").alias("w"))
    return weights.groupBy("region", "model", r0.cast("int").alias("tile_row0"), c0.cast("int").alias("tile_col0"), "cat_id").agg(
        F.collect_list(cell).alias("cells"))


def zonal_stats_of_tiles(tiles: DataFrame, weights: DataFrame, values: str = "values",
                         catchments: DataFrame | None = None, steps: DataFrame | None = None) -> DataFrame:
    """Z2 + A1-A3 of tiles with ``tile_weights``: the rows of ``zonal_stats``.

    A tile meets the catchments that touch it, and one pass over a catchment's
    cells in the array gives its count, sums and maximum there: a row per tile
    and catchment.  These are summed, partially before the shuffle.
    """
    j = tiles.join(weights, ["region", "model", "tile_row0", "tile_col0"])
    keys = [k for k in STEP_KEYS if k in tiles.columns] + ["cat_id"]
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("n"), zero.alias("whole"), zero.alias("units"), F.lit(0.0).alias("rest"), F.lit(None).cast("double").alias("top"))

    def add(acc, cell):
        v = F.element_at(F.element_at(F.col(values), cell["r"]), cell["c"])
        w, whole = cell["w"], F.floor(v)
        units = F.rint((v - whole) * UNIT)
        rest = v - (whole + units / F.lit(float(UNIT)))
        more = F.struct((acc["n"] + w).alias("n"), (acc["whole"] + w * whole.cast("long")).alias("whole"),
                        (acc["units"] + w * units.cast("long")).alias("units"), (acc["rest"] + w * rest).alias("rest"),
                        F.greatest(acc["top"], v).alias("top"))
        return F.when(v.isNotNull() & ~F.isnan(v), more).otherwise(acc)

    here = j.select(*keys, F.aggregate("cells", start, add).alias("s"))
    stats = here.groupBy(*keys).agg(F.sum("s.n").alias("count"), F.max("s.top").alias("max"), F.sum("s.whole").alias("_whole"),
                                    F.sum("s.units").alias("_units"), F.sum("s.rest").alias("_rest"))
    return _finished(stats, keys, tiles, catchments, steps)
