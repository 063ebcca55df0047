"""The whole forecast-to-catchment run (E1, R9) as one Spark plan.

The reference loops over regions and models and runs each stage on files.
Here region and model are ordinary keys: one plan covers every (region,
model, cycle) present — subset to the rain variable and the region's box,
keep complete cycles, de-accumulate where the model delivers running totals,
join the weights, aggregate, round, summarise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.operators.grid import complete_cycles, deaccumulate, only_complete, passthrough, step_manifest, variable_subset
from pluvio.operators.risk import catchment_summary
from pluvio.operators.zonal import covered_cells, every_row, round_stats, zonal_ranges, zonal_stats, zonal_stats_by_ranges, zonal_weights
from pluvio.plans.catalog import MODELS, models_df, region_models_df, regions_df
from pluvio.session import ensure_utc, read_parquet_or_none, work_path
from pluvio.sources.polygons import polygon_edges
from pluvio.sources.sinks import PARTS, in_partitions, read_table, write_table


def subset(raw_grid: DataFrame, grid_def: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """F3 and F2 before any statistic: the rain variable at the surface, and
    the cells whose centres lie in the region's box.

    A grid without ``var`` holds one variable already.  A region without a
    box keeps all its cells.  Geometry and boxes meet first, one row per
    (region, model); the grid then joins them once.
    """
    grid = variable_subset(raw_grid).drop("var", "level") if "var" in raw_grid.columns else raw_grid
    if regions is None:
        return grid
    geometry = grid_def.select("region", "model", "x0", "y_top", "dx", "dy")
    box = geometry.join(regions.select("region", "left", "right", "bottom", "top"), ["region"], "left")
    lon = F.col("x0") + (F.col("col") + F.lit(0.5)) * F.col("dx")
    lat = F.col("y_top") - (F.col("row") + F.lit(0.5)) * F.col("dy")
    inside = lon.between(F.col("left"), F.col("right")) & lat.between(F.col("bottom"), F.col("top"))
    return grid.join(box, ["region", "model"], "left").filter(F.col("left").isNull() | inside).select(*grid.columns)


def zonal_results(raw_grid: DataFrame, weights: DataFrame, models: DataFrame,
                  model_specs: dict | None = None, gate: bool = True, manifest: DataFrame | None = None,
                  catchments: DataFrame | None = None, grid_def: DataFrame | None = None) -> DataFrame:
    """Raw grids -> rounded zonal results.

    The completeness gate runs first, from the step manifest.  Running-total
    models pass the covered-cell filter before their per-cell shuffle, the
    de-accumulation window; interval models go straight to the weights join,
    which makes the same test.  Each stored row is read by one of the two
    branches.  The manifest also says which steps there are, so a step none of
    whose covered cells arrived still has its rows.  Without a manifest the
    steps are counted from ``raw_grid``, which reads its keys once more.

    ``weights`` are cell weights or, with ``grid_def``, range weights (with
    columns ``c0, c1``): the same results; see ``zonal_stats_by_ranges``.
    """
    manifest = step_manifest(raw_grid) if manifest is None else manifest
    grid = only_complete(raw_grid, models, manifest) if gate else raw_grid
    steps = only_complete(manifest, models, manifest) if gate else manifest
    running = [m.name for m in (model_specs or MODELS).values() if m.accumulation == "running"]
    run = grid.filter(F.col("model").isin(running))
    rest = passthrough(grid.filter(~F.col("model").isin(running)))
    if "c0" in weights.columns:
        stats = zonal_stats_by_ranges(deaccumulate(run).unionByName(rest), weights, grid_def, catchments=catchments, steps=steps)
        return round_stats(stats)
    run = deaccumulate(covered_cells(run, weights))
    return round_stats(zonal_stats(run.unionByName(rest), weights, catchments=catchments, steps=steps))


def bucketed_results(cells: DataFrame, weights: DataFrame, models: DataFrame, manifest: DataFrame,
                     catchments: DataFrame, model_specs: dict | None = None) -> DataFrame:
    """``zonal_results`` of a grid and weights that are bucketed by cell
    (``sources.buckets``): neither moves, only statistics are shuffled.

    The two kinds of models are summed apart, as a union of them would no longer
    be known to lie by cell; their rows meet in the frame of steps x catchments.
    """
    running = [m.name for m in (model_specs or MODELS).values() if m.accumulation == "running"]
    grid = only_complete(cells, models, manifest)
    run = deaccumulate(covered_cells(grid.filter(F.col("model").isin(running)), weights))
    rest = passthrough(grid.filter(~F.col("model").isin(running)))
    stats = zonal_stats(run, weights).unionByName(zonal_stats(rest, weights))
    return round_stats(every_row(stats, only_complete(manifest, models, manifest), catchments))


def weights_fingerprint(polygons: DataFrame, grid_def: DataFrame) -> str:
    """Content hash of the inputs of Z1 (polygon edges and grid geometry).

    An order-independent sum of row hashes, computed by Spark; only the
    number reaches the driver.
    """
    e = polygon_edges(polygons)
    eh = e.select(F.xxhash64("region", "cat_id", "part", "ring", "seq", "x1", "y1", "x2", "y2").alias("h"))
    gh = grid_def.select(F.xxhash64("region", "model", F.col("x0").cast("double"), F.col("y_top").cast("double"),
                                    F.col("dx").cast("double"), F.col("dy").cast("double"),
                                    F.col("n_rows").cast("int"), F.col("n_cols").cast("int"),
                                    F.col("factor").cast("int")).alias("h"))
    total = eh.unionByName(gh).agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).first()["s"]
    return format(int(total or 0) % (1 << 64), "016x")


def cached_weights(spark: SparkSession, polygons: DataFrame, grid_def: DataFrame, root: str, ranges: bool = False) -> DataFrame:
    """Z1 reused across runs: weights live under ``root/fp=<fingerprint>``
    and are recomputed only when polygons or grid geometry change.

    The row count is written beside them, last.  Weights whose manifest is
    missing, or whose rows are not as many as it says, are a write that did
    not end: they are written anew.
    """
    base = f"{root}/fp={weights_fingerprint(polygons, grid_def)}" + ("-ranges" if ranges else "")
    said = read_parquet_or_none(spark, f"{base}/manifest", "n long")
    found = read_parquet_or_none(spark, f"{base}/data") if said is not None else None
    if found is not None:
        n = said.first()
        if n is not None and found.count() == n["n"]:
            return found
    weights = materialise_weights(spark, polygons, grid_def, f"{base}/data", ranges)
    weights.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{base}/manifest")
    return weights


def materialise_weights(spark: SparkSession, polygons: DataFrame, grid_def: DataFrame,
                        path: str | None = None, ranges: bool = False) -> DataFrame:
    """Z1 once per (region, model, polygon set), written and read back: the
    table cuts the lineage, survives executor loss, and has a known size that
    joins with it are planned by.  ``ranges``: as runs of cells."""
    path = path or work_path(spark, "weights")
    w = (zonal_ranges if ranges else zonal_weights)(polygon_edges(polygons), grid_def)
    write_table(w, path, partition_by=["region", "model"], replace="static")
    return read_table(spark, path, schema=w.schema)      # no catchment: no file to learn the schema from


def configured(raw_grid: DataFrame, region_models: DataFrame) -> DataFrame:
    """Keep the (region, model) pairs the catalog runs."""
    return raw_grid.join(region_models.select("region", "model"), ["region", "model"], "left_semi")


def prepared(spark: SparkSession, raw_grid: DataFrame, grid_def: DataFrame, region_models: DataFrame | None = None,
             regions: DataFrame | None = None) -> DataFrame:
    """The configured regions and models of a grid (S9), subset to the rain
    variable and the region's box (F3, F2; default: the catalog's boxes)."""
    region_models = region_models_df(spark) if region_models is None else region_models
    regions = regions_df(spark) if regions is None else regions
    return subset(configured(raw_grid, region_models), grid_def, regions)


def written_manifest(spark: SparkSession, grid: DataFrame) -> DataFrame:
    """The steps of a grid as a written table: its keys are read once, for the
    gate and for the steps of the results."""
    path = work_path(spark, "steps")
    step_manifest(grid).write.parquet(path)
    return spark.read.parquet(path)


def run_results(spark: SparkSession, raw_grid: DataFrame, polygons: DataFrame, grid_def: DataFrame,
                model_specs: dict | None = None, region_models: DataFrame | None = None,
                weights_root: str | None = None, regions: DataFrame | None = None,
                manifest: DataFrame | None = None, ranges: bool = False) -> DataFrame:
    """R9 up to the results table: every region, model and cycle of
    ``raw_grid``, one row per catchment and step.

    ``regions``: boxes to subset by (default: the catalog's, for the regions
    it knows).  ``weights_root``: keep the weights there and reuse them while
    the polygons and grid geometry are unchanged.  ``ranges``: weigh by runs of
    cells, for catchments many cells wide.
    """
    ensure_utc(spark)
    specs = model_specs or MODELS
    weights = (cached_weights(spark, polygons, grid_def, weights_root, ranges) if weights_root is not None
               else materialise_weights(spark, polygons, grid_def, ranges=ranges))
    grid = prepared(spark, raw_grid, grid_def, region_models, regions)
    manifest = (written_manifest(spark, grid) if manifest is None
                else configured(manifest, region_models_df(spark) if region_models is None else region_models))
    # a written table of the complete cycles: its size is known, so the gate is
    # broadcast and never moves the grid to one task for each cycle
    models, ready_path = models_df(spark, specs), work_path(spark, "ready")
    complete_cycles(manifest, models).select(*PARTS).write.parquet(ready_path)
    ready = spark.read.parquet(ready_path)
    return zonal_results(in_partitions(grid, ready), weights, models, specs, gate=False, manifest=in_partitions(manifest, ready),
                         catchments=polygons.select("region", "cat_id"), grid_def=grid_def)


def run(spark: SparkSession, raw_grid: DataFrame, polygons: DataFrame, grid_def: DataFrame,
        **options) -> tuple[DataFrame, DataFrame]:
    """Every region and model in one job -> (results, colour scales).

    Results are written once to the shared folder; the colour scales read
    them back.  Options are those of ``run_results``.
    """
    path = work_path(spark, "results")
    write_table(run_results(spark, raw_grid, polygons, grid_def, **options), path)
    results = read_table(spark, path)
    return results, catchment_summary(results)
