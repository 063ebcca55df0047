"""Grid operators.

A forecast grid is a long table, one row per cell and step:

    region, model, cycle timestamp, step_h int, valid_time timestamp,
    [var, level,] row int, col int, value double

stored as Parquet partitioned by region/model/cycle.  Grid geometry is a
one-row-per-(region, model) dimension ``grid_def(region, model, x0, y_top,
dx, dy, n_rows, n_cols, factor)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.plans.catalog import MODELS

CELL_KEYS = ["region", "model", "cycle", "var", "level", "row", "col"]


def _common(a: DataFrame, b: DataFrame, keys=("region", "model")) -> list[str]:
    return [k for k in keys if k in a.columns and k in b.columns]


def cell_geometry(grid: DataFrame, grid_def: DataFrame) -> DataFrame:
    """Cell-centre lon/lat from the affine geometry (no per-row lookups)."""
    g = grid.join(grid_def.select("region", "model", "x0", "y_top", "dx", "dy"),
                  _common(grid, grid_def), "inner")
    return (g.withColumn("lon", F.col("x0") + (F.col("col") + F.lit(0.5)) * F.col("dx"))
            .withColumn("lat", F.col("y_top") - (F.col("row") + F.lit(0.5)) * F.col("dy"))
            .drop("x0", "y_top", "dx", "dy"))


def point_to_cell(points: DataFrame, grid_def: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The cell holding each point (inverse of G3); outside -> null row/col."""
    keys = _common(points, grid_def)
    gd = grid_def.select(*[c for c in ("region", "model") if c in grid_def.columns],
                         "x0", "y_top", "dx", "dy", "n_rows", "n_cols")
    p = points.join(gd, keys, "inner")
    c = F.floor((F.col(lon) - F.col("x0")) / F.col("dx"))
    r = F.floor((F.col("y_top") - F.col(lat)) / F.col("dy"))
    inside = (c >= 0) & (c < F.col("n_cols")) & (r >= 0) & (r < F.col("n_rows"))
    return (p.withColumn("row", F.when(inside, r.cast("int")))
            .withColumn("col", F.when(inside, c.cast("int")))
            .drop("x0", "y_top", "dx", "dy", "n_rows", "n_cols"))


def bbox_subset(df: DataFrame, left: float, right: float, bottom: float, top: float,
                lon: str = "lon", lat: str = "lat") -> DataFrame:
    """F2 (one region): literal range filter, pushed down to the scan."""
    return df.filter(F.col(lon).between(left, right) & F.col(lat).between(bottom, top))


def bbox_subset_by_region(df: DataFrame, boxes: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """F2 (all regions): equi-join on region with the box dimension, then range test.

    One box per region: no range join, no nested loop.
    """
    j = df.join(boxes.select("region", "left", "right", "bottom", "top"), ["region"], "inner")
    keep = (F.col(lon).between(F.col("left"), F.col("right"))
            & F.col(lat).between(F.col("bottom"), F.col("top")))
    return j.filter(keep).drop("left", "right", "bottom", "top")


def box_cell_ranges(geom: dict, left: float, right: float, bottom: float, top: float) -> tuple:
    """Row and column index ranges whose cell centres can lie in the box.

    ``geom`` is one grid_def row (x0, y_top, dx, dy, n_rows, n_cols).  One
    cell of slack each side; the exact lon/lat test decides membership.
    """
    import math
    x0, y_top, dx, dy = geom["x0"], geom["y_top"], geom["dx"], geom["dy"]
    c0 = max(math.ceil((left - x0) / dx - 0.5) - 1, 0)
    c1 = min(math.floor((right - x0) / dx - 0.5) + 1, geom["n_cols"] - 1)
    r0 = max(math.ceil((y_top - top) / dy - 0.5) - 1, 0)
    r1 = min(math.floor((y_top - bottom) / dy - 0.5) + 1, geom["n_rows"] - 1)
    return (r0, r1), (c0, c1)


def bbox_subset_pushdown(grid: DataFrame, geom: dict, left: float, right: float,
                         bottom: float, top: float) -> DataFrame:
    """F2 on a stored grid of one (region, model): the box as index ranges.

    ``row``/``col`` range predicates reach the Parquet scan (row groups
    outside the box are skipped when files are clustered by row); the
    centre-in-box test on lon/lat then keeps exactly the cells F2 keeps.
    """
    (r0, r1), (c0, c1) = box_cell_ranges(geom, left, right, bottom, top)
    g = grid.filter(F.col("row").between(r0, r1) & F.col("col").between(c0, c1))
    lon = F.lit(float(geom["x0"])) + (F.col("col") + F.lit(0.5)) * F.lit(float(geom["dx"]))
    lat = F.lit(float(geom["y_top"])) - (F.col("row") + F.lit(0.5)) * F.lit(float(geom["dy"]))
    return (g.withColumn("lon", lon).withColumn("lat", lat)
            .filter(F.col("lon").between(left, right) & F.col("lat").between(bottom, top)))


def variable_subset(df: DataFrame, var: str = "APCP", level: str = "surface") -> DataFrame:
    """keep one variable at one level (pushed down to the scan)."""
    return df.filter((F.col("var") == var) & (F.col("level") == level))


def normalise(df: DataFrame, time_col: str | None = "valid_time", value: str = "tp") -> DataFrame:
    """decoded-grid coordinates to the map server's form.

    ``latitude``/``longitude`` -> ``lat``/``lon``; decoding leftovers
    (``valid_time, step, latitude, longitude, surface``) dropped; the value
    stored as 4-byte float; a ``time`` column added when the input has none.
    """
    out = df.withColumnsRenamed({c: n for c, n in (("latitude", "lat"), ("longitude", "lon"))
                                 if c in df.columns})
    if "time" not in out.columns and time_col in out.columns:
        out = out.withColumn("time", F.col(time_col))
    drop = [c for c in ("valid_time", "step", "surface") if c in out.columns]
    out = out.drop(*drop)
    return out.withColumn(value, F.col(value).cast("float"))


def deaccumulate(raw: DataFrame, value: str = "value", clamp_negative: bool = False) -> DataFrame:
    """G1: running totals -> per-step amounts.

    ``v(t) - v(previous available step)`` per cell and cycle; the first step
    keeps its value (even a null).  A missing value, or a missing predecessor,
    leaves the difference missing.  The window holds one cell's steps of one
    variable and cycle, bounded by the model's step count.  Differences can be
    negative (as in the reference); ``clamp_negative`` floors them at 0.
    """
    keys = [k for k in CELL_KEYS if k in raw.columns]
    w = Window.partitionBy(*keys).orderBy("valid_time")
    prev = F.lag(value).over(w)
    first = F.row_number().over(w) == 1
    diff = F.col(value) - prev
    if clamp_negative:
        diff = F.when(diff.isNotNull(), F.greatest(diff, F.lit(0.0)))     # greatest() alone skips nulls
    return raw.withColumn(value, F.when(first, F.col(value)).otherwise(diff))


def deaccumulate_from(new: DataFrame, last: DataFrame, value: str = "value",
                      clamp_negative: bool = False) -> tuple[DataFrame, DataFrame]:
    """G1 step by step: the increments of ``new`` (running totals of steps not
    seen before) and the totals to go on from.

    ``last`` holds each cell's latest total before ``new``, with its
    ``valid_time``; the second table that is returned is the same after ``new``.
    The steps of ``new`` must be later than those of ``last``, cell by cell.  So
    a step is differenced from one row per cell, however long the cycle is.
    """
    keys = [k for k in CELL_KEYS if k in new.columns]
    both = (new.withColumn("_new", F.lit(True))
            .unionByName(last.withColumn("_new", F.lit(False)), allowMissingColumns=True))
    steps = deaccumulate(both, value, clamp_negative).filter("_new").drop("_new")
    at = F.struct("valid_time", F.col(value).alias("v"))
    now = (both.groupBy(*keys).agg(F.max_by(at, "valid_time").alias("_at"))
           .select(*keys, F.col("_at.valid_time").alias("valid_time"), F.col("_at.v").alias(value)))
    return steps.select(*new.columns), now


def passthrough(raw: DataFrame) -> DataFrame:
    """Interval models (gfs) are used as read — no accumulation takes place."""
    return raw


def by_accumulation(raw: DataFrame, models: dict | None = None, value: str = "value") -> DataFrame:
    """G1/G2 by model: running-total models are differenced, the rest pass."""
    models = models or MODELS
    running = [m.name for m in models.values() if m.accumulation == "running"]
    run = raw.filter(F.col("model").isin(running))
    rest = raw.filter(~F.col("model").isin(running))
    return deaccumulate(run, value).unionByName(passthrough(rest))


def refine_nearest(cells: DataFrame, grid_def: DataFrame) -> DataFrame:
    """Nearest-neighbour refinement by the integer factor k.

    Fine cell (r, c) takes coarse (r div k, c div k).  Output grows by k^2:
    for zonal statistics this is folded into weights (Z1) instead.
    """
    gd = grid_def.select("region", "model", "factor", "x0", "y_top", "dx", "dy")
    j = cells.join(gd, _common(cells, grid_def), "inner")
    k = F.col("factor")
    j = j.withColumn("fr", F.explode(F.sequence(F.lit(0), k - 1)))
    j = j.withColumn("fc", F.explode(F.sequence(F.lit(0), k - 1)))
    fine_row = F.col("row") * k + F.col("fr")
    fine_col = F.col("col") * k + F.col("fc")
    return (j.withColumn("fine_row", fine_row).withColumn("fine_col", fine_col)
            .withColumn("fine_lon", F.col("x0") + (F.col("fine_col") + F.lit(0.5)) * (F.col("dx") / k))
            .withColumn("fine_lat", F.col("y_top") - (F.col("fine_row") + F.lit(0.5)) * (F.col("dy") / k))
            .drop("fr", "fc", "factor", "x0", "y_top", "dx", "dy"))


def time_axis(grid: DataFrame, models_df: DataFrame) -> DataFrame:
    """The time axis of each cycle: step index and hours since the cycle.

    ``hours = start + (rank - 1) * increment`` over the distinct valid times
    of a cycle.  The ranking runs on the distinct times (one row per step),
    never on the grid itself.
    """
    times = grid.select("region", "model", "cycle", "valid_time").distinct()
    w = Window.partitionBy("region", "model", "cycle").orderBy("valid_time")
    m = models_df.select("model", "step_start", "step_inc")
    t = times.withColumn("step_index", F.dense_rank().over(w)).join(m, ["model"], "inner")
    return t.select("region", "model", "cycle", "valid_time", "step_index",
                    (F.col("step_start") + (F.col("step_index") - 1) * F.col("step_inc")).alias("hours"))


def step_manifest(grid: DataFrame) -> DataFrame:
    """The steps present per (region, model, cycle): what the gate, and the rows
    of catchments without a valid cell, need of a grid.  Written beside a stored
    grid (``sinks.write_grid``), it spares both the scan of every cell."""
    return grid.groupBy("region", "model", "cycle", "step_h", "valid_time").agg(F.count(F.lit(1)).alias("n_cells"))


def complete_cycles(grid: DataFrame, models_df: DataFrame, exact: bool = False) -> DataFrame:
    """F8: cycles whose distinct steps reach the model's count (28 / 48).

    ``grid`` is the grid or its step manifest.  With ``exact`` only steps of
    the model's own sequence count, so a stray step cannot stand in for a
    missing one.
    """
    if exact:
        m = models_df.select("model", "step_start", "step_inc", "n_steps")
        k = F.col("step_h") - F.col("step_start")
        grid = (grid.join(m, ["model"], "inner")
                .filter((k >= 0) & (F.pmod(k, F.col("step_inc")) == 0) & (k < F.col("step_inc") * F.col("n_steps")))
                .select("region", "model", "cycle", "step_h"))
    seen = grid.groupBy("region", "model", "cycle").agg(F.count_distinct("step_h").alias("n_steps_seen"))
    m = models_df.select("model", "n_steps")
    return (seen.join(m, ["model"], "inner")
            .filter(F.col("n_steps_seen") >= F.col("n_steps"))
            .select("region", "model", "cycle", "n_steps_seen"))


def only_complete(grid: DataFrame, models_df: DataFrame, manifest: DataFrame | None = None,
                  exact: bool = False) -> DataFrame:
    """Gate a grid on F8 (semi join on the complete cycles).

    The gate table has one row per forecast run (region, model, cycle).  No
    hint: Spark broadcasts it while its size is below the threshold, and
    prunes the partitions of a stored grid by it.
    """
    done = complete_cycles(grid if manifest is None else manifest, models_df, exact)
    return grid.join(done.select("region", "model", "cycle"), ["region", "model", "cycle"], "left_semi")
