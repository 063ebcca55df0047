"""Grid and cycle operators: properties and the reference's clock rules."""
import datetime as dt

from pyspark.sql import functions as F

from pluvio.operators import cycles, grid
from pluvio.plans.catalog import models_df


def test_deaccumulate_sums_back_to_total(spark):
    rows = []
    for cell in range(3):
        tot = 0.0
        for step in range(1, 49):
            tot += (cell * 7 + step) % 5 * 0.25
            rows.append(("r", "wrfpr", dt.datetime(2024, 1, 1, 6), step,
                         dt.datetime(2024, 1, 1, 6) + dt.timedelta(hours=step), 0, cell, tot))
    raw = spark.createDataFrame(rows, "region string, model string, cycle timestamp, step_h int, "
                                      "valid_time timestamp, row int, col int, value double")
    d = grid.deaccumulate(raw)
    sums = {r["col"]: r["s"] for r in d.groupBy("col").agg(F.sum("value").alias("s")).collect()}
    last = {r["col"]: r["value"] for r in raw.filter("step_h = 48").collect()}
    for c in sums:
        assert abs(sums[c] - last[c]) < 1e-9


def test_latest_cycle_clock_rules(spark):
    # (clock, gfs cycle, wrfpr cycle) — the reference's hour thresholds
    cases = [
        (dt.datetime(2024, 3, 5, 22, 10), dt.datetime(2024, 3, 5, 18), dt.datetime(2024, 3, 5, 18)),
        (dt.datetime(2024, 3, 5, 21, 59), dt.datetime(2024, 3, 5, 12), dt.datetime(2024, 3, 5, 6)),
        (dt.datetime(2024, 3, 5, 16, 0), dt.datetime(2024, 3, 5, 12), dt.datetime(2024, 3, 5, 6)),
        (dt.datetime(2024, 3, 5, 10, 0), dt.datetime(2024, 3, 5, 6), dt.datetime(2024, 3, 5, 6)),
        (dt.datetime(2024, 3, 5, 9, 30), dt.datetime(2024, 3, 5, 0), dt.datetime(2024, 3, 4, 18)),
        (dt.datetime(2024, 3, 5, 4, 0), dt.datetime(2024, 3, 5, 0), dt.datetime(2024, 3, 4, 18)),
        (dt.datetime(2024, 3, 5, 3, 59), dt.datetime(2024, 3, 4, 18), dt.datetime(2024, 3, 4, 18)),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, ts timestamp")
    got = {(r["i"], r["model"]): r["cycle"].replace(tzinfo=None) for r in cycles.latest_cycle(df).collect()}
    for i, (_, g, w) in enumerate(cases):
        assert got[(i, "gfs")] == g
        assert got[(i, "wrfpr")] == w


def test_pending_cycles_states(spark):
    wanted = spark.createDataFrame([(r, "gfs", dt.datetime(2024, 1, d)) for r in ("a", "b") for d in (1, 2, 3)],
                                   "region string, model string, cycle timestamp")
    runs = spark.createDataFrame([
        ("a", "gfs", dt.datetime(2024, 1, 1), "done", dt.datetime(2024, 1, 2)),
        ("a", "gfs", dt.datetime(2024, 1, 2), "done", dt.datetime(2024, 1, 3)),
        ("a", "gfs", dt.datetime(2024, 1, 2), "clobbered", dt.datetime(2024, 1, 4)),
        ("b", "gfs", dt.datetime(2024, 1, 3), "done", dt.datetime(2024, 1, 4)),
    ], "region string, model string, cycle timestamp, state string, updated_at timestamp")
    got = {(r["region"], r["cycle"].day): r["reason"] for r in cycles.pending_cycles(wanted, runs).collect()}
    assert got == {("a", 2): "clobbered", ("a", 3): "new", ("b", 1): "new", ("b", 2): "new"}


def test_complete_cycles_needs_all_steps(spark):
    rows = [("r", "gfs", dt.datetime(2024, 1, 1), s) for s in range(6, 169, 6)]
    rows += [("r", "gfs", dt.datetime(2024, 1, 8), s) for s in range(6, 163, 6)]
    g = spark.createDataFrame(rows, "region string, model string, cycle timestamp, step_h int")
    out = grid.complete_cycles(g, models_df(spark)).collect()
    assert [r["cycle"].day for r in out] == [1]


def test_deaccumulate_clamp(spark):
    rows = [("r", "wrfpr", dt.datetime(2024, 1, 1, 6), s, dt.datetime(2024, 1, 1, 6 + s), 0, 0, v)
            for s, v in ((1, 2.0), (2, 1.5), (3, 4.0))]
    raw = spark.createDataFrame(rows, "region string, model string, cycle timestamp, step_h int, "
                                      "valid_time timestamp, row int, col int, value double")
    keep = [r["value"] for r in grid.deaccumulate(raw).orderBy("step_h").collect()]
    clamp = [r["value"] for r in grid.deaccumulate(raw, clamp_negative=True).orderBy("step_h").collect()]
    assert keep == [2.0, -0.5, 2.5] and clamp == [2.0, 0.0, 2.5]


def test_point_filter_is_typed(spark):
    from pluvio.operators.series import point_filter
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "cat_id long, mean double")
    assert point_filter(df, 2).count() == 1
    assert point_filter(df, "2").count() == 0


def test_require_thresholds(spark):
    import pytest
    from pluvio.operators.risk import require_thresholds
    keyed = spark.createDataFrame([(1,), (2,), (3,)], "cat_id long")
    thr = spark.createDataFrame([(1, "p", 5.0), (3, "p", -999.0)], "cat_id long, product string, threshold double")
    with pytest.raises(ValueError, match=r"1 catchment\(s\) without a threshold, e.g. \[2\]"):
        require_thresholds(keyed, thr)


def test_bbox_pushdown_equals_join_form(spark):
    from pluvio.session import work_path
    from pluvio.sources import sinks
    from pluvio.testing import views as V
    sf = "/root/testdata/sf0.01"
    path = work_path(spark, "bbox-grid")
    sinks.write_table(V.grid(spark, sf).filter(F.col("model") == "gfs"), path)
    g = sinks.read_table(spark, path)
    gd = V.grid_def(spark, sf).filter(F.col("model") == "gfs")
    geom = gd.first().asDict()
    box = (2.0, 12.0, 1.0, 8.5)
    a = grid.bbox_subset_by_region(grid.cell_geometry(g, gd), V.bbox(spark))
    b = grid.bbox_subset_pushdown(g, geom, *box)
    cols = ["cycle", "valid_time", "row", "col", "value", "lon", "lat"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))
    plan = b._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters" in plan and "GreaterThanOrEqual(row" in plan


def test_decode_requests_ids(spark):
    from pluvio.operators.series import decode_requests
    bodies = ['{"region": "a", "model": "gfs", "watershedID": 11111}',
              '{"region": "a", "model": "gfs", "watershedID": 11111.0}',
              '{"region": "a", "model": "gfs", "watershedID": "x"}']
    df = spark.createDataFrame(list(enumerate(bodies)), "request_id long, body string")
    got = [r["cat_id"] for r in decode_requests(df).orderBy("request_id").collect()]
    assert got == [11111, 11111, None]
