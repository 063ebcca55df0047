"""The physical plans the scale design relies on."""
from pluvio.operators.risk import catchment_summary
from pluvio.operators.zonal import zonal_stats
from pluvio.plans import workflow as WF
from pluvio.plans.catalog import models_df
from pluvio.session import work_path
from pluvio.sources import sinks
from pluvio.testing import views as V
from pluvio.testing.suite import _polys

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _weights(spark):
    return WF.materialise_weights(spark, _polys(spark, SF), V.grid_def(spark, SF))


def test_small_weights_are_broadcast_by_size(spark):
    p = _plan(zonal_stats(V.grid(spark, SF), _weights(spark)))
    assert "BroadcastHashJoin" in p


def test_large_weights_shuffle_instead(spark):
    w = _weights(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(zonal_stats(V.grid(spark, SF), w))
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", aqe)


def test_aggregations_are_partial_before_shuffle(spark):
    p = _plan(catchment_summary(V.results(spark, SF)))
    assert "partial_sum" in p and "partial_max" in p
    p = _plan(zonal_stats(V.grid(spark, SF), _weights(spark)))
    assert "partial_sum" in p and "partial_max" in p


def test_stored_grid_prunes_and_filters_before_window(spark):
    path = work_path(spark, "shape-raw")
    sinks.write_table(V.raw_grid(spark, SF).drop("var", "level"), path)
    raw = sinks.read_table(spark, path)
    df = WF.zonal_results(raw, _weights(spark), models_df(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "dynamicpruning" in formatted                 # only complete cycles' files are read
    assert "BroadcastHashJoin LeftSemi" in formatted or "LeftSemi" in plan
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def _formatted(spark, df):
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_pending_cycles_prune_the_stored_grid(spark):
    """The pending table reaches the scan as a partition filter, whatever its size."""
    path, todo_path = work_path(spark, "shape-pending"), work_path(spark, "shape-todo")
    sinks.write_grid(V.raw_grid(spark, SF).drop("var", "level"), path)
    raw = sinks.read_table(spark, path)
    keys = ["region", "model", "cycle"]
    raw.select(*keys).distinct().orderBy("cycle").limit(1).write.parquet(todo_path)
    todo = spark.read.parquet(todo_path)
    line = [x for x in _formatted(spark, sinks.in_partitions(raw, todo)).splitlines() if "PartitionFilters" in x][0]
    assert "dynamicpruning" in line


def test_run_reads_each_grid_row_once(spark):
    """With a step manifest the grid is scanned by two branches, running-total
    models in one and the others in the other: their partitions do not meet."""
    from pluvio.operators.grid import complete_cycles
    path, manifest = work_path(spark, "shape-once"), work_path(spark, "shape-steps")
    sinks.write_grid(V.raw_grid(spark, SF).drop("var", "level"), path, manifest=manifest)
    ready_path = work_path(spark, "shape-ready")
    keys = ["region", "model", "cycle"]
    steps = sinks.read_table(spark, manifest)
    complete_cycles(steps, models_df(spark)).select(*keys).write.parquet(ready_path)
    ready = spark.read.parquet(ready_path)
    df = WF.zonal_results(sinks.in_partitions(sinks.read_table(spark, path), ready), _weights(spark), models_df(spark), gate=False,
                          manifest=sinks.in_partitions(steps, ready), catchments=_polys(spark, SF))
    text = _formatted(spark, df).split("===== Subqueries =====")[0]      # those only reuse broadcasts
    scans = [part for part in text.split("\n\n") if "shape-once" in part and "Scan parquet" in part]
    assert len(scans) == 2
    filters = sorted(next(x for x in part.splitlines() if "PartitionFilters" in x) for part in scans)
    assert sum("NOT (model" in f for f in filters) == 1 and all("wrfpr" in f and "dynamicpruning" in f for f in filters)


def test_retention_learns_cycles_from_the_listing(spark):
    src, dst = work_path(spark, "ret-src"), work_path(spark, "ret-dst")
    sinks.write_table(V.results(spark, SF), src)
    listing = sinks.partition_listing(spark, src)
    assert "ReadSchema: struct<path:string>" in _formatted(spark, listing)      # names only, no contents
    sinks.apply_retention(spark, src, dst)
    kept = sinks.read_table(spark, dst).select("region", "model", "cycle").distinct().collect()
    want = sinks.latest_cycles(listing).select("region", "model", "cycle").collect()
    assert sorted(map(tuple, kept)) == sorted(map(tuple, want))


def test_no_exchange_by_cycle_alone(spark):
    """The gate does not move a whole cycle to one task, however the planner
    estimates the grid's steps; nor do an ingest's last totals and statistics."""
    from pluvio.operators.grid import step_manifest
    from pluvio.streaming import ingest as ST
    grid = V.raw_grid(spark, SF).drop("var", "level")
    from pluvio.plans.catalog import RegionSpec, region_models_df
    rm = region_models_df(spark, {V.REGION: RegionSpec(V.REGION, "1", 0.0, 15.0, -1e6, 20.0, ("gfs", "wrfpr"))})
    path = work_path(spark, "shape-gate")
    sinks.write_table(grid, path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        results = WF.run_results(spark, sinks.read_table(spark, path), _polys(spark, SF), V.grid_def(spark, SF), region_models=rm,
                                 regions=V.boxes(spark))
        gates = [x for x in _plan(results).splitlines() if "LeftSemi" in x and "cycle" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert gates and all("BroadcastHashJoin" in x for x in gates)
    state = ST._State(spark, work_path(spark, "shape-state"), 1)
    cycles = grid.select("region", "model", "cycle").distinct()
    path = work_path(spark, "shape-cycles")
    cycles.write.parquet(path)
    cycles = spark.read.parquet(path)
    state.batch = 0
    state.write("steps", step_manifest(grid))
    state.write("totals", grid.select("row", "col", "valid_time", "value", "region", "model", "cycle"))
    state.batch = 1
    p = _plan(state.last_totals(cycles))
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p


def test_retention_opens_only_current_partitions(spark):
    """The current cycles reach the scan as a partition filter, also where the listing looks large to the planner."""
    src, dst = work_path(spark, "prune-src"), work_path(spark, "prune-dst")
    sinks.write_table(V.results(spark, SF), src)
    seen = []
    write, sinks.write_table = sinks.write_table, lambda df, *a, **k: (seen.append(_formatted(spark, df)), write(df, *a, **k))[1]
    try:
        sinks.apply_retention(spark, src, dst)
    finally:
        sinks.write_table = write
    assert "dynamicpruning" in next(x for x in seen[-1].splitlines() if "PartitionFilters" in x)


def test_input_of_two_regions_and_variables_is_made_once(spark):
    """Each events scan of the delivered grid stands once in the plan, whatever number of variables and regions it is given."""
    raw = V.raw_grid(spark, SF)
    both = V.both_regions(V.raw_grid_vars(spark, SF))
    scans = lambda df: _formatted(spark, df).split("\n\n")[0].count("Scan parquet")
    assert scans(both) == scans(raw) and both.columns == raw.columns
    assert both.count() == 4 * raw.count()


def test_stored_grid_is_ordered_by_variable(spark):
    """A scan for one variable skips the pages of others."""
    path = work_path(spark, "var-order")
    sinks.write_grid(V.raw_grid_vars(spark, SF), path)
    plan = spark.read.parquet(path)
    from pyspark.sql import functions as F
    first = plan.select("var", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")) \
                .groupBy("f").agg(F.max(F.when(F.col("var") == "APCP", F.col("i"))).alias("a"), F.min(F.when(F.col("var") == "TMP", F.col("i"))).alias("t"))
    assert first.filter("a is not null and t is not null").count() > 0
    assert first.filter("a > t").count() == 0
