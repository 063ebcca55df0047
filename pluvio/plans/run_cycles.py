"""The scheduled run over stored grids, with skip/resume by run state.

    raw grid table ─ pending cycles (J3 vs runs) ─ workflow (F8, G1, Z2, A4, A5)
        └─ results + colour scales (dynamic overwrite) ─ run state appended (K6, last)

A cycle whose last state is ``'done'`` is skipped; ``'clobbered'`` forces a
re-run; a failed run records nothing, so the next run picks the cycle up
again (the reference wrote its state *before* the work on a first run).

Command line::

    python -m pluvio.plans.run_cycles --grid PATH [--manifest PATH] --polygons [REGION=]PATH ... [--collection]
        --grid-def PATH --out PATH [--thresholds CSV --product COLUMN] [--csv]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.operators.cycles import RUN_KEYS, pending_cycles, record_runs
from pluvio.operators.grid import complete_cycles
from pluvio.operators.risk import catchment_summary, threshold_compare, time_to_threshold
from pluvio.operators.series import running_total
from pluvio.plans import workflow
from pluvio.plans.catalog import MODELS, models_df, region_models_df
from pluvio.plans.charts import chart_documents
from pluvio.session import build_session, ensure_utc, read_parquet_or_none, work_path
from pluvio.sources import snapshots as SN
from pluvio.sources.polygons import read_geojson
from pluvio.sources.results import read_thresholds, thresholds_long, to_reference_form
from pluvio.sources.sinks import (apply_retention, in_partitions, partition_listing, read_table, retain_latest,
                                  to_reference_scales, write_table)

RUNS_SCHEMA = "region string, model string, cycle timestamp, state string, updated_at timestamp"
GRID_DEF_SCHEMA = ("region string, model string, x0 double, y_top double, dx double, dy double, "
                   "n_rows int, n_cols int, factor int")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    runs = read_parquet_or_none(spark, path)
    return runs if runs is not None else spark.createDataFrame([], RUNS_SCHEMA)


def run_cycles(spark: SparkSession, raw_grid: DataFrame, polygons: DataFrame, grid_def: DataFrame,
               out: str, model_specs: dict | None = None, region_models: DataFrame | None = None,
               thresholds: DataFrame | None = None, product: str | None = None,
               reference_csv: bool = False, regions: DataFrame | None = None,
               manifest: DataFrame | None = None, wanted: DataFrame | None = None, ranges: bool = False,
               as_of: bool = False, wave: int | None = None, snapshots: bool = False) -> DataFrame:
    """Process every pending cycle of ``raw_grid``; returns the (region, model,
    cycle) rows recorded done.

    The pending cycles are a small written table that the grid is joined with,
    so Spark prunes the stored partitions by it, however many are pending;
    nothing of it passes through the driver.  Results are written once; all
    that follows reads the partitions this run has written.  A cycle that was
    ready is recorded, last of all, also where it has no rows (a region without
    catchments): it was done, and is not pending for ever.

    With ``thresholds`` (long form, S2) the run also writes the threshold
    comparison (R4), the time to threshold (R5) and every chart (K3);
    ``reference_csv`` exports the current cycle's results and colour scales in
    the reference's CSV layout (F6, K2), one row per catchment in the scales.
    ``current/`` holds the results of each region's and model's current cycle
    (K7).  ``ranges``: weigh by runs of cells.  ``manifest``: the grid's step manifest (F8); ``wanted``: its
    partition listing, else the distinct keys are read from the grid.
    ``as_of``: compare with the threshold issue that held at each cycle.

    With ``snapshots`` all tables of a run, and its state, become visible in one
    step (``sources.snapshots``; read them with ``read_snapshot``); there is then
    no ``current/`` folder, which is a way of reading.

    With ``wave`` a backlog is worked off in waves of at most so many cycles of
    each region and model, oldest first.  A wave is a run of its own, its state
    recorded at its end, so a run that breaks off goes on with the wave it was
    in, and a plan or a commit never spans more partitions than a wave has.
    """
    ensure_utc(spark)
    wanted = raw_grid.select(*RUN_KEYS).distinct() if wanted is None else wanted
    todo_path = work_path(spark, "pending")
    runs = SN.pointer(spark, out) if snapshots else read_runs(spark, f"{out}/runs")
    pending_cycles(wanted, runs).write.parquet(todo_path)
    todo = spark.read.parquet(todo_path).select(*RUN_KEYS)
    if todo.isEmpty():
        return spark.createDataFrame([], "region string, model string, cycle timestamp")
    one = lambda keys: _run(spark, raw_grid, polygons, grid_def, out, keys, model_specs or MODELS, region_models, thresholds,
                            product, reference_csv, regions, manifest, ranges, as_of, snapshots)
    if wave is None:
        return one(todo)
    # only the number of waves is read back
    waves_path = work_path(spark, "waves")
    place = F.row_number().over(Window.partitionBy("region", "model").orderBy("cycle")) - 1
    todo.withColumn("wave", F.floor(place / wave).cast("int")).write.parquet(waves_path)
    waves = spark.read.parquet(waves_path)
    done = None
    for k in range(waves.agg(F.max("wave").alias("n")).first()["n"] + 1):
        now = one(waves.filter(F.col("wave") == k).select(*RUN_KEYS))
        done = now if done is None else done.unionByName(now)
    return done


def _run(spark: SparkSession, raw_grid: DataFrame, polygons: DataFrame, grid_def: DataFrame, out: str, todo: DataFrame, specs: dict,
         region_models: DataFrame | None, thresholds: DataFrame | None, product: str | None, reference_csv: bool,
         regions: DataFrame | None, manifest: DataFrame | None, ranges: bool, as_of: bool, snapshots: bool) -> DataFrame:
    """One run over the cycles ``todo``; returns those recorded done."""
    version = SN.new_version() if snapshots else None

    def put(df: DataFrame, table: str) -> None:
        if snapshots:
            SN.write_version(df, out, table, version)
        else:
            write_table(df, f"{out}/{table}")

    def back(table: str) -> DataFrame:
        """This run's rows of a table."""
        return SN.read_version(spark, out, table, version) if snapshots else in_partitions(read_table(spark, f"{out}/{table}"), ready)

    def record() -> DataFrame:
        if snapshots:
            SN.publish(ready, out, version)
        else:
            record_runs(spark, ready, f"{out}/runs")
        return ready

    mdf = models_df(spark, specs)
    grid = workflow.prepared(spark, in_partitions(raw_grid, todo), grid_def, region_models, regions)
    # the cycles that this run can do: pending, configured and complete
    ready_path = work_path(spark, "ready")
    steps = workflow.written_manifest(spark, grid) if manifest is None else workflow.configured(
        in_partitions(manifest, todo), region_models_df(spark) if region_models is None else region_models)
    complete_cycles(steps, mdf).select(*RUN_KEYS).write.parquet(ready_path)
    ready = spark.read.parquet(ready_path)
    if ready.isEmpty():
        return ready
    weights = workflow.cached_weights(spark, polygons, grid_def, f"{out}/weights", ranges)
    results = workflow.zonal_results(in_partitions(grid, ready), weights, mdf, specs, gate=False,
                                     manifest=in_partitions(steps, ready), catchments=polygons.select("region", "cat_id"), grid_def=grid_def)
    put(results, "results")
    if read_parquet_or_none(spark, f"{out}/results") is None:       # no catchment in any region so far
        return record()

    # all that follows reads this run's partitions back, nothing is computed twice
    results_w = back("results")
    put(catchment_summary(results_w), "scales")
    scales_w = back("scales")
    if thresholds is not None:
        put(threshold_compare(scales_w, thresholds, product, as_of), "exceedance")
        put(time_to_threshold(running_total(results_w), thresholds, product, as_of=as_of), "time_to_threshold")
        put(chart_documents(results_w, thresholds, product), "charts")
    if snapshots:
        record()
        if reference_csv:
            _export(SN.read_snapshot(spark, out, "results", current=True), SN.read_snapshot(spark, out, "scales", current=True), out)
        return ready
    listing = partition_listing(spark, f"{out}/results")
    apply_retention(spark, f"{out}/results", f"{out}/current")
    if reference_csv:
        _export(read_table(spark, f"{out}/current"), retain_latest(read_table(spark, f"{out}/scales"), listing), out)
    return record()


def _export(results: DataFrame, scales: DataFrame, out: str) -> None:
    """The current cycle in the reference's CSV layout."""
    write_table(to_reference_form(results), f"{out}/csv/results", ["region", "model"], fmt="csv", replace="static")
    write_table(to_reference_scales(scales).drop("cycle"), f"{out}/csv/colorscales", ["region", "model"], fmt="csv", replace="static")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="zonal rainfall statistics for pending forecast cycles")
    ap.add_argument("--grid", required=True, help="grid table (Parquet, partitioned region/model/cycle)")
    ap.add_argument("--manifest", default=None, help="step manifest of the grid table (write_grid)")
    ap.add_argument("--polygons", required=True, nargs="+", metavar="[REGION=]PATH",
                    help="GeoJSON, one path or one per region")
    ap.add_argument("--collection", action="store_true", help="each GeoJSON file is one FeatureCollection")
    ap.add_argument("--region", default=None, help="region of polygons named without one (else the 'region' property)")
    ap.add_argument("--grid-def", required=True, help="grid geometry table")
    ap.add_argument("--grid-def-format", default="parquet", choices=["parquet", "json", "csv"])
    ap.add_argument("--out", required=True, help="output folder: results/, scales/, runs/")
    ap.add_argument("--thresholds", default=None, help="threshold CSV (BASIN + product columns)")
    ap.add_argument("--product", default=None, help="threshold column to use (default: all)")
    ap.add_argument("--as-of", action="store_true", help="compare with the threshold issue that held at each cycle")
    ap.add_argument("--wave", type=int, default=None, help="cycles of a region and model that one run of a backlog takes")
    ap.add_argument("--snapshots", action="store_true", help="publish all tables of a run in one step")
    ap.add_argument("--ranges", action="store_true", help="weigh by runs of cells (catchments many cells wide)")
    ap.add_argument("--csv", action="store_true", help="also export the reference's CSV layout")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    reader = spark.read.format(a.grid_def_format)
    if a.grid_def_format == "csv":
        reader = reader.option("header", True).schema(GRID_DEF_SCHEMA)
    grid_def = reader.load(a.grid_def)
    raw = read_table(spark, a.grid)
    polys = None
    for p in a.polygons:
        region, _, path = p.rpartition("=") if "=" in p.split("/")[0] else (a.region, "", p)
        one = read_geojson(spark, path, region=region, collection=a.collection)
        polys = one if polys is None else polys.unionByName(one)
    manifest = read_table(spark, a.manifest) if a.manifest else None
    thr = thresholds_long(read_thresholds(spark, a.thresholds)) if a.thresholds else None
    run_cycles(spark, raw, polys, grid_def, a.out, thresholds=thr, product=a.product, reference_csv=a.csv,
               manifest=manifest, wanted=partition_listing(spark, a.grid), ranges=a.ranges, as_of=a.as_of, wave=a.wave,
               snapshots=a.snapshots)


if __name__ == "__main__":
    main()
