"""A grid and weights bucketed by cell: nothing but statistics is shuffled."""
import re
import uuid

import pytest

from pluvio.operators.zonal import every_row, zonal_stats
from pluvio.plans import workflow as WF
from pluvio.plans.catalog import models_df
from pluvio.session import work_path
from pluvio.sources import buckets as B
from pluvio.testing import views as V
from pluvio.testing.suite import _polys

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    tag = uuid.uuid4().hex[:8]
    polys, gd = _polys(spark, SF), V.grid_def(spark, SF)
    raw = V.raw_grid(spark, SF).drop("var", "level")
    cells = B.write_cells(raw, f"cells_{tag}", work_path(spark, "b-cells"), 4)
    weights = B.write_cell_weights(WF.materialise_weights(spark, polys, gd), f"weights_{tag}", work_path(spark, "b-weights"), 4)
    yield raw, cells, weights, polys, tag
    for t in ("cells", "weights"):
        spark.sql(f"DROP TABLE {t}_{tag}")


def _no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    return lambda: [spark.conf.set(k, v) for k, v in zip(keys, old)]


def test_results_equal_the_plain_run(spark, stored):
    raw, cells, weights, polys, _ = stored
    got = WF.bucketed_results(cells, weights, models_df(spark), WF.written_manifest(spark, cells), polys)
    want = WF.zonal_results(raw, weights, models_df(spark), catchments=polys)
    a, b = (sorted(map(tuple, d.select("model", "cycle", "step_h", "cat_id", "count", "max", "mean").collect()), key=str) for d in (got, want))
    assert a == b and len(a) > 500


def test_no_exchange_above_the_grid_scan(spark, stored):
    """With weights beyond every broadcast threshold: the window, the covered-cell
    test and the weights join read the buckets as they lie."""
    _, cells, weights, _, _ = stored
    back = _no_broadcast(spark)
    try:
        run = WF.deaccumulate(WF.covered_cells(cells.filter("model = 'wrfpr'"), weights))
        plan = run._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "SortMergeJoin" in plan and "Exchange" not in plan
        plan = zonal_stats(run, weights)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2
        exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
        assert len(exchanges) == 1 and "cat_id" in exchanges[0] and "row" not in exchanges[0]
        assert "SelectedBucketsCount" in spark._jvm.PythonSQLUtils.explainString(run._jdf.queryExecution(), "formatted") or "Bucketed: true" in plan
    finally:
        back()


def test_a_stored_table_is_registered_again(spark, stored):
    raw, cells, _, _, tag = stored
    path = spark.sql(f"DESCRIBE FORMATTED cells_{tag}").filter("col_name = 'Location'").first()["data_type"]
    schema = ", ".join(f"`{f.name}` {'string' if f.name == 'cycle' else f.dataType.simpleString()}" for f in spark.table(f"cells_{tag}").schema)
    B.register(spark, f"again_{tag}", path, schema, 4)
    try:
        assert B.read_cells(spark, f"again_{tag}").count() == raw.count()
        back = _no_broadcast(spark)
        plan = WF.deaccumulate(B.read_cells(spark, f"again_{tag}"))._jdf.queryExecution().executedPlan().toString()
        back()
        assert "Exchange" not in plan
    finally:
        spark.sql(f"DROP TABLE again_{tag}")


def test_rows_for_catchments_without_statistics(spark):
    stats = spark.createDataFrame([("r", "m", 1, 7, 3, 2.0, 1.0)], "region string, model string, step_h int, cat_id long, count long, max double, mean double")
    steps = spark.createDataFrame([("r", "m", 1), ("r", "m", 2)], "region string, model string, step_h int")
    cats = spark.createDataFrame([("r", 7), ("r", 8), ("q", 9)], "region string, cat_id int")
    got = sorted((r["step_h"], r["cat_id"], r["count"], r["mean"]) for r in every_row(stats, steps, cats).collect())
    assert got == [(1, 7, 3, 1.0), (1, 8, 0, None), (2, 7, 0, None), (2, 8, 0, None)]
