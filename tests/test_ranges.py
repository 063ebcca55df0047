"""Range weights, running sums and range maxima against cell weights and brute force."""
import random

import pytest
from pyspark.sql import functions as F

from pluvio.operators import zonal as Z
from pluvio.plans import workflow as WF
from pluvio.plans.catalog import models_df
from pluvio.sources.polygons import polygon_edges
from pluvio.testing import views as V

from test_zonal import GD, GD_SCHEMA, _brute, _polys

SF = "/root/testdata/sf0.001"


def _edges(spark, polys):
    return polygon_edges(spark.createDataFrame([("r", c, p) for c, p in polys],
                                               "region string, cat_id long, coordinates array<array<array<array<double>>>>"))


def _square(x0, x1, y0, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranges_hold_the_cells_of_the_weights(spark, seed):
    polys = _polys(random.Random(seed))
    got = {}
    for r in Z.zonal_ranges(_edges(spark, polys), spark.createDataFrame([GD], GD_SCHEMA)).collect():
        for c in range(r["c0"], r["c1"] + 1):
            assert (r["cat_id"], r["row"], c) not in got
            got[(r["cat_id"], r["row"], c)] = r["w"]
    assert got == _brute(polys, GD)


def test_spans_that_end_on_cell_borders(spark):
    """Whole cells, a part of one cell, a span within a cell, parts side by side."""
    polys = [(1, [[_square(1.0, 5.0, 1.0, 4.0)]]), (2, [[_square(2.2, 2.6, 2.0, 3.0)]]), (3, [[_square(0.0, 8.0, 0.0, 6.0)]]),
             (4, [[_square(1.0, 2.3, 1.0, 2.0)], [_square(2.3, 4.0, 1.0, 2.0)]]), (5, [[_square(1.5, 3.5, 1.5, 2.5)]])]
    rows = Z.zonal_ranges(_edges(spark, polys), spark.createDataFrame([GD], GD_SCHEMA)).collect()
    got = {(r["cat_id"], r["row"], c): r["w"] for r in rows for c in range(r["c0"], r["c1"] + 1)}
    assert got == _brute(polys, GD)
    assert sum(r["cat_id"] == 1 for r in rows) == 3 and sum(r["cat_id"] == 3 for r in rows) == 6       # one run a row


def test_rows_grow_with_the_edge_not_the_area(spark):
    n = []
    for size in (20, 80):
        gd = spark.createDataFrame([("r", "m", 0.0, float(size), 1.0, 1.0, size, size, 4)], GD_SCHEMA)
        m = size / 2
        diamond = [[0.3, m], [m, size - 0.3], [size - 0.3, m], [m, 0.3], [0.3, m]]
        edges = _edges(spark, [(1, [[diamond]])])
        n.append((Z.zonal_ranges(edges, gd).count(), Z.zonal_weights(edges, gd).count()))
    (r0, w0), (r1, w1) = n
    assert r1 < 4.6 * r0 and w1 > 12 * w0                      # four times the edge, sixteen times the area


def _grid(spark, rnd, rows, cols, steps=(1, 2)):
    values = lambda: rnd.choice([None, float("nan"), rnd.random() * 50, -rnd.random(), float(rnd.randint(0, 500)) / 10])
    cells = [("r", "m", s, a, b, values()) for s in steps for a in range(rows) for b in range(cols) if rnd.random() < 0.8]
    return spark.createDataFrame(cells, "region string, model string, step_h int, row int, col int, value double")


def _close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert tuple(x)[:-1] == tuple(y)[:-1]
        assert x["mean"] == y["mean"] or abs(x["mean"] - y["mean"]) <= 1e-12 * max(1, abs(x["mean"]))


@pytest.mark.parametrize("seed", [4, 5])
def test_stats_equal_those_of_the_weights(spark, seed):
    """Cells that are missing, null, NaN or negative; two steps."""
    rnd = random.Random(seed)
    polys = _polys(rnd) + [(3, [[_square(0.0, 8.0, 0.0, 6.0)]]), (4, [[_square(3.1, 3.2, 3.1, 3.2)]])]
    gd, edges = spark.createDataFrame([GD], GD_SCHEMA), _edges(spark, polys)
    grid = _grid(spark, rnd, 6, 8)
    cats = spark.createDataFrame([("r", c) for c in (1, 2, 3, 4)], "region string, cat_id long")
    a = Z.zonal_stats(grid, Z.zonal_weights(edges, gd), catchments=cats).orderBy("step_h", "cat_id").collect()
    b = Z.zonal_stats_by_ranges(grid, Z.zonal_ranges(edges, gd), gd, catchments=cats).orderBy("step_h", "cat_id").collect()
    _close(a, b)
    assert len(a) == 8


def test_range_maxima_of_every_length(spark):
    rnd = random.Random(6)
    n = 37
    gd = spark.createDataFrame([("r", "m", 0.0, 1.0, 1.0, 1.0, 1, n, 1)], GD_SCHEMA)
    cells = {c: rnd.choice([None, rnd.randint(0, 10**6) / 8]) if rnd.random() < 0.9 else "absent" for c in range(n)}
    grid = spark.createDataFrame([("r", "m", 0, c, v) for c, v in cells.items() if v != "absent"],
                                 "region string, model string, row int, col int, value double")
    spans = [(a, z) for a in range(n) for z in range(a, n)]
    ranges = spark.createDataFrame([("r", "m", i, 0, a, z, 3) for i, (a, z) in enumerate(spans)],
                                   "region string, model string, cat_id long, row int, c0 int, c1 int, w long")
    got = {r["cat_id"]: r for r in Z.zonal_stats_by_ranges(grid, ranges, gd).collect()}
    for i, (a, z) in enumerate(spans):
        vs = [v for c, v in cells.items() if a <= c <= z and isinstance(v, float)]
        r = got[i]
        assert (r["count"], r["max"]) == (3 * len(vs), max(vs, default=None))
        assert r["mean"] == (None if not vs else sum(vs) / len(vs))       # eighths: exact


def test_workflow_takes_ranges(spark):
    """The whole run gives the same results from range weights."""
    basins, gd = V.basins(spark, SF), V.grid_def(spark, SF)
    raw = V.raw_grid(spark, SF).drop("var", "level")
    cells = WF.zonal_results(raw, WF.materialise_weights(spark, basins, gd), models_df(spark), catchments=basins)
    ranges = WF.zonal_results(raw, WF.materialise_weights(spark, basins, gd, ranges=True), models_df(spark), catchments=basins, grid_def=gd)
    assert sorted(map(tuple, cells.collect()), key=str) == sorted(map(tuple, ranges.select(*cells.columns).collect()), key=str)


def test_no_row_for_an_interior_cell(spark):
    """The look-ups of a range do not grow with its length."""
    ranges = spark.createDataFrame([("r", "m", i, 0, 0, 4 ** i, 1) for i in range(6)],
                                   "region string, model string, cat_id long, row int, c0 int, c1 int, w long")
    assert Z.range_probes(ranges).groupBy("cat_id").count().agg(F.max("count")).first()[0] <= 4


def test_catchments_over_several_bands(spark, monkeypatch):
    """A band's cells are one row a step, absent cells are none; a catchment that
    lies in three bands, looked up a step at a time, has the statistics of its cells."""
    monkeypatch.setattr(Z, "BAND_CELLS", 1)
    rnd = random.Random(7)
    rows, cols = 2 * Z.BAND_ROWS + 9, 6
    gd = spark.createDataFrame([("r", "m", 0.0, float(rows), 1.0, 1.0, rows, cols, 2)], GD_SCHEMA)
    edges = _edges(spark, [(1, [[_square(0.3, 5.2, 1.1, rows - 2.2)]]), (2, [[_square(2.0, 3.0, 4.0, 7.0)]])])
    values = lambda: rnd.choice([None, float("nan"), float(rnd.randint(-50, 500)) / 8])
    grid = spark.createDataFrame([("r", "m", s, a, b, values()) for s in (1, 2, 3) for a in range(rows) for b in range(cols)
                                  if rnd.random() < 0.3], "region string, model string, step_h int, row int, col int, value double")
    assert Z.row_profiles(grid).count() == 9
    a = Z.zonal_stats(grid, Z.zonal_weights(edges, gd)).orderBy("step_h", "cat_id").collect()
    b = Z.zonal_stats_by_ranges(grid, Z.zonal_ranges(edges, gd), gd).orderBy("step_h", "cat_id").collect()
    _close([r for r in a if r["count"]], [r for r in b if r["count"]])
    assert sum(r["count"] > 0 for r in a) >= 3
