"""The scheduled run (E1): pending cycles only, state recorded last; E2/E3 helpers."""
import datetime as dt

from pyspark.sql import functions as F

from pluvio.plans import charts
from pluvio.plans.catalog import RegionSpec, region_models_df
from pluvio.plans.run_cycles import read_runs, run_cycles
from pluvio.session import work_path
from pluvio.sources import sinks
from pluvio.testing import views as V
from pluvio.testing.suite import _polys, _thresholds

SF = "/root/testdata/sf0.001"


def _rm(spark):
    return region_models_df(spark, {V.REGION: RegionSpec(V.REGION, "t", 0, 15, -90, 10, ("gfs", "wrfpr"))})


def test_run_cycles_skips_done_and_reruns_clobbered(spark):
    raw_path, out = work_path(spark, "e1-raw"), work_path(spark, "e1-out")
    sinks.write_table(V.raw_grid(spark, SF).drop("var", "level"), raw_path)
    raw = sinks.read_table(spark, raw_path)
    polys, gd = _polys(spark, SF), V.grid_def(spark, SF)
    first = run_cycles(spark, raw, polys, gd, out, region_models=_rm(spark))
    n_first = first.count()
    assert n_first > 0
    runs = read_runs(spark, f"{out}/runs")
    assert runs.count() == n_first
    # second run: everything done, nothing new recorded
    run_cycles(spark, raw, polys, gd, out, region_models=_rm(spark))
    assert read_runs(spark, f"{out}/runs").count() == n_first
    # mark one cycle clobbered: the next run redoes exactly that one
    one = runs.orderBy("model", "cycle").limit(1).select("region", "model", "cycle")
    one.select("region", "model", "cycle", F.lit("clobbered").alias("state"),
               F.current_timestamp().alias("updated_at")).write.mode("append").parquet(f"{out}/runs")
    again = run_cycles(spark, raw, polys, gd, out, region_models=_rm(spark))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, one.collect()))


def test_chart_documents_and_lookup(spark):
    docs = charts.chart_documents(V.results(spark, SF), _thresholds(spark, SF), V.PRODUCT)
    req = V.requests(spark, SF)
    got = charts.lookup_charts(docs, req, "cumulative")
    assert got.count() > 0
    assert got.filter(~F.col("json").startswith('{"values": [[')).count() == 0


def test_cli_full_run(spark):
    """The command line over files: grid table, GeoJSON lines, grid geometry, threshold CSV.

    The test data is labelled as a catalog region so the default catalog runs it.
    """
    from pluvio.plans.run_cycles import main
    from pluvio.sources.polygons import to_feature_lines
    base = work_path(spark, "cli")
    grid_p, poly_p, gd_p, thr_p, out = (f"{base}/grid", f"{base}/polys", f"{base}/gd", f"{base}/thr", f"{base}/out")
    hisp = F.lit("hispaniola")
    sinks.write_table(V.raw_grid(spark, SF).drop("var", "level").withColumn("region", hisp), grid_p)
    # the test basin moved and shrunk into the region's box
    moved = F.transform(F.col("geometry.coordinates"), lambda part: F.transform(part, lambda ring: F.transform(
        ring, lambda p: F.array(p[0] * 0.4 - 74.9, (p[1] - 10.0) * 0.4 + 20.4))))
    polys = V.polygons(spark, SF).withColumn(
        "geometry", F.struct(F.lit("MultiPolygon").alias("type"), moved.alias("coordinates")))
    to_feature_lines(polys).write.text(poly_p)
    (V.grid_def(spark, SF).withColumn("region", hisp).withColumn("x0", F.lit(-74.9)).withColumn("y_top", F.lit(20.4))
     .withColumn("dx", F.lit(0.4)).withColumn("dy", F.lit(0.4)).write.json(gd_p))
    V.thresholds_wide(spark, SF).write.option("header", True).csv(thr_p)
    args = ["--grid", grid_p, "--polygons", poly_p, "--region", "hispaniola", "--grid-def", gd_p,
            "--grid-def-format", "json", "--out", out, "--thresholds", thr_p, "--product", V.PRODUCT, "--csv"]
    main(args)
    n = read_runs(spark, f"{out}/runs").count()
    assert n > 0
    for sub in ("results", "scales", "exceedance", "time_to_threshold", "charts", "current"):
        assert sinks.read_table(spark, f"{out}/{sub}").count() > 0, sub
    csv = spark.read.option("header", True).csv(f"{out}/csv/colorscales")
    assert set(csv.columns) >= {"cat_id", "cum_mean", "mean", "max"}
    assert csv.filter(~F.col("cat_id").endswith(".0")).count() == 0
    assert csv.groupBy("region", "model", "cat_id").count().filter("count > 1").count() == 0   # current cycle only
    current = sinks.read_table(spark, f"{out}/current")
    assert current.groupBy("region", "model").agg(F.countDistinct("cycle").alias("n")).filter("n > 1").count() == 0
    main(args)                                           # nothing pending: nothing new recorded
    assert read_runs(spark, f"{out}/runs").count() == n


def test_weights_reused_until_inputs_change(spark):
    from pluvio.plans.workflow import cached_weights, weights_fingerprint
    root = work_path(spark, "wcache")
    polys, gd = _polys(spark, SF), V.grid_def(spark, SF)
    n = cached_weights(spark, polys, gd, root).count()
    assert n > 0 and cached_weights(spark, polys, gd, root).count() == n
    assert weights_fingerprint(polys, gd) == weights_fingerprint(polys, gd)
    moved = gd.withColumn("x0", F.lit(-0.5))
    assert weights_fingerprint(polys, moved) != weights_fingerprint(polys, gd)
    from pluvio.session import read_parquet_or_none
    assert read_parquet_or_none(spark, f"{root}/fp={weights_fingerprint(polys, gd)}/data") is not None
    assert read_parquet_or_none(spark, f"{root}/nothing-here") is None


def test_half_written_weights_are_rebuilt(spark):
    """Weights without their manifest, or with fewer rows than it says, are not trusted."""
    from pluvio.plans.workflow import cached_weights, materialise_weights, weights_fingerprint
    root = work_path(spark, "whalf")
    polys, gd = _polys(spark, SF), V.grid_def(spark, SF)
    base = f"{root}/fp={weights_fingerprint(polys, gd)}"
    whole = materialise_weights(spark, polys, gd)
    n = whole.count()
    part = whole.filter("model = 'gfs'")
    sinks.write_table(part, f"{base}/data", partition_by=["region", "model"])            # no manifest
    assert part.count() < n and cached_weights(spark, polys, gd, root).count() == n
    sinks.write_table(part, f"{base}/data", partition_by=["region", "model"], replace="static")   # fewer rows than it says
    assert cached_weights(spark, polys, gd, root).count() == n


def test_late_region_is_picked_up(spark):
    """A cycle complete in one region and late in another is done in the first only."""
    raw = V.both_regions(V.raw_grid(spark, SF).drop("var", "level"))
    rm = region_models_df(spark, {r: RegionSpec(r, r, 0, 15, -90, 10, ("gfs", "wrfpr")) for r in (V.REGION, V.REGION2)})
    polys, gd = V.both_regions(_polys(spark, SF)), V.both_regions(V.grid_def(spark, SF))
    out = work_path(spark, "late")
    late = (F.col("region") == V.REGION2) & (F.col("step_h") > 20)
    run_cycles(spark, raw.filter(~late), polys, gd, out, region_models=rm)
    assert {r["region"] for r in read_runs(spark, f"{out}/runs").collect()} == {V.REGION}
    again = run_cycles(spark, raw, polys, gd, out, region_models=rm)
    assert {r["region"] for r in again.collect()} == {V.REGION2}
    assert {r["region"] for r in sinks.read_table(spark, f"{out}/results").select("region").distinct().collect()} == \
        {V.REGION, V.REGION2}


def test_large_backlog_plans_and_runs(spark):
    """A long list of pending cycles is a table joined with the grid, no predicate of their keys."""
    out = work_path(spark, "backlog")
    rows = spark.range(800).select(
        F.lit(V.REGION).alias("region"), F.lit("gfs").alias("model"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 21600).alias("cycle"), F.lit(6).alias("step_h"))
    grid = rows.select("*", (F.unix_seconds("cycle") + 21600).alias("s")).select(
        "region", "model", "cycle", "step_h", F.timestamp_seconds("s").alias("valid_time"),
        F.lit(0).alias("row"), F.lit(1).alias("col"), F.lit(2.5).alias("value"))
    from pluvio.plans.catalog import MODELS
    import dataclasses
    specs = {"gfs": dataclasses.replace(MODELS["gfs"], n_steps=1)}
    done = run_cycles(spark, grid, _polys(spark, SF), V.grid_def(spark, SF), out, model_specs=specs, region_models=_rm(spark))
    assert done.count() == 800
