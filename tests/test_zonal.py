"""Scan-line weights (Z1) against a brute-force even-odd test; Z2 = refined-grid stats."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators.grid import refine_nearest
from pluvio.operators import zonal as Z
from pluvio.operators.zonal import round_stats, zonal_stats, zonal_weights
from pluvio.sources.polygons import polygon_edges
from pluvio.testing import suite

GD = ("r", "m", 0.0, 6.0, 1.0, 1.0, 6, 8, 7)   # x0, y_top, dx, dy, n_rows, n_cols, factor
GD_SCHEMA = ("region string, model string, x0 double, y_top double, dx double, dy double, "
             "n_rows int, n_cols int, factor int")


def _star(cx, cy, r0, r1, n, rnd):
    pts = []
    for i in range(n):
        a = 2 * math.pi * i / n
        r = rnd.uniform(r0, r1)
        pts.append([cx + r * math.cos(a), cy + r * math.sin(a)])
    return pts + [pts[0]]


def _brute(polys, gd):
    _, _, x0, y_top, dx, dy, nr, nc, k = gd
    out = {}
    for cat, parts in polys:
        for part in parts:
            for i in range(nr * k):
                yc = y_top - (i + 0.5) * (dy / k)
                for j in range(nc * k):
                    xc = x0 + (j + 0.5) * (dx / k)
                    inside = False
                    for ring in part:
                        for (x1, y1), (x2, y2) in zip(ring[:-1], ring[1:]):
                            if (y1 > yc) != (y2 > yc) and xc < x1 + (yc - y1) * (x2 - x1) / (y2 - y1):
                                inside = not inside
                    if inside:
                        key = (cat, i // k, j // k)
                        out[key] = out.get(key, 0) + 1
    return out


def _polys(rnd):
    a = [_star(2.5, 3.0, 0.8, 1.9, 9, rnd)]
    hole = [_star(2.5, 3.0, 0.2, 0.5, 6, rnd)[::-1]]
    b = [_star(6.0, 2.0, 0.5, 1.5, 12, rnd)]
    c = [_star(5.0, 4.5, 0.3, 2.5, 7, rnd)]        # partly outside the grid
    return [(1, [a + hole, b]), (2, [c])]


def _weights(spark, polys):
    rows = [("r", cat, parts) for cat, parts in polys]
    df = spark.createDataFrame(rows, "region string, cat_id long, coordinates array<array<array<array<double>>>>")
    gd = spark.createDataFrame([GD], GD_SCHEMA)
    return zonal_weights(polygon_edges(df), gd), gd


def test_weights_match_brute_force(spark):
    for seed in (1, 2, 3):
        polys = _polys(random.Random(seed))
        w, _ = _weights(spark, polys)
        got = {(r["cat_id"], r["row"], r["col"]): r["w"] for r in w.collect()}
        assert got == _brute(polys, GD)


def test_weights_invariant_under_split(spark):
    sq = [[1.1, 1.2], [4.3, 1.2], [4.3, 4.7], [1.1, 4.7], [1.1, 1.2]]
    left = [[1.1, 1.2], [2.6, 1.2], [2.6, 4.7], [1.1, 4.7], [1.1, 1.2]]
    right = [[2.6, 1.2], [4.3, 1.2], [4.3, 4.7], [2.6, 4.7], [2.6, 1.2]]
    w1, _ = _weights(spark, [(1, [[sq]])])
    w2, _ = _weights(spark, [(1, [[left], [right]])])
    a = {(r["row"], r["col"]): r["w"] for r in w1.collect()}
    b = {(r["row"], r["col"]): r["w"] for r in w2.collect()}
    assert a == b


def test_stats_equal_refined_grid(spark):
    rnd = random.Random(5)
    polys = _polys(rnd)
    w, gd = _weights(spark, polys)
    cells = [("r", "m", r, c, float(rnd.randint(0, 500)) / 10 if (r + c) % 7 else float("nan"))
             for r in range(GD[6]) for c in range(GD[7])]
    grid = spark.createDataFrame(cells, "region string, model string, row int, col int, value double")
    stats = {r["cat_id"]: r for r in round_stats(zonal_stats(grid, w)).collect()}
    # the reference's way: refine the grid k x k, test every fine centre
    fine = refine_nearest(grid, gd).collect()
    vals = {(f["fine_row"], f["fine_col"]): f["value"] for f in fine}
    brute = _brute(polys, GD)
    for cat in (1, 2):
        k = GD[8]
        # fine cells inside: expand each coarse weight into that many copies of the coarse value
        vs = []
        for (c, r, col), n in brute.items():
            if c == cat:
                v = vals[(r * k, col * k)]
                if not math.isnan(v):
                    vs.extend([v] * n)
        s = stats[cat]
        assert s["count"] == len(vs)
        assert s["max"] == np.round(max(vs), 1)
        assert abs(s["mean"] - round(sum(vs) / len(vs), 1)) < 1e-9


def test_no_valid_cell_gives_zero_count(spark):
    grid = spark.createDataFrame([("r", "m", 0, 0, float("nan")), ("r", "m", 0, 1, None)],
                                 "region string, model string, row int, col int, value double")
    w = spark.createDataFrame([("r", "m", 7, 0, 0, 3), ("r", "m", 7, 0, 1, 2)],
                              "region string, model string, cat_id long, row int, col int, w long")
    r = round_stats(zonal_stats(grid, w)).collect()[0]
    assert (r["count"], r["max"], r["mean"]) == (0, None, None)


def test_overlapping_parts_count_once(spark):
    sq = [[1.0, 1.0], [3.0, 1.0], [3.0, 3.0], [1.0, 3.0], [1.0, 1.0]]
    far = [[2.0, 2.0], [4.0, 2.0], [4.0, 4.0], [2.0, 4.0], [2.0, 2.0]]
    once, _ = _weights(spark, [(1, [[sq]])])
    twice, _ = _weights(spark, [(1, [[sq], [sq]])])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    both, _ = _weights(spark, [(1, [[sq], [far]])])
    k = GD[8]
    assert sum(r["w"] for r in both.collect()) == (4 + 4 - 1) * k * k


def test_mean_is_not_cut(spark):
    """Values of more than three decimals, and tiny ones, reach the mean whole."""
    grid = spark.createDataFrame([("r", "m", 0, 0, 0.1496), ("r", "m", 0, 1, 1e-12)],
                                 "region string, model string, row int, col int, value double")
    w = spark.createDataFrame([("r", "m", 7, 0, 0, 3), ("r", "m", 8, 0, 1, 2)],
                              "region string, model string, cat_id long, row int, col int, w long")
    got = {r["cat_id"]: r["mean"] for r in zonal_stats(grid, w).collect()}
    assert abs(got[7] - 0.1496) < 1e-15 and abs(got[8] - 1e-12) < 1e-20
    assert round_stats(zonal_stats(grid, w)).filter("cat_id = 7").first()["mean"] == 0.1


def test_every_catchment_has_a_row_for_every_step(spark):
    grid = spark.createDataFrame([("r", "m", s, 0, 0, 1.0) for s in (1, 2)],
                                 "region string, model string, step_h int, row int, col int, value double")
    w = spark.createDataFrame([("r", "m", 7, 0, 0, 3)], "region string, model string, cat_id long, row int, col int, w long")
    cats = spark.createDataFrame([("r", 7), ("r", 9), ("other", 1)], "region string, cat_id long")
    got = sorted((r["step_h"], r["cat_id"], r["count"], r["mean"]) for r in zonal_stats(grid, w, catchments=cats).collect())
    assert [g[:3] for g in got] == [(1, 7, 3), (1, 9, 0), (2, 7, 3), (2, 9, 0)]


def test_the_frame_of_steps_is_made_behind_the_join(spark):
    """Rows of catchments and steps without a cell: no task sorts or shuffles the
    frame, which became rows before its join and then in one task; steps that are
    not listed, and catchments that are not, have no rows."""
    grid = spark.createDataFrame([("r", "m", s, s * 10, 0, 0, float(s)) for s in (1, 2, 3)],
                                 "region string, model string, cycle int, step_h int, row int, col int, value double")
    weights = spark.createDataFrame([("r", "m", 1, 0, 0, 4), ("r", "m", 9, 0, 0, 4)],
                                    "region string, model string, cat_id long, row int, col int, w long")
    cats = spark.createDataFrame([("r", 1), ("r", 2), ("r", 2), ("q", 3)], "region string, cat_id long")
    steps = spark.createDataFrame([("r", "m", c, c * 10 + d) for c in (1, 2) for d in (0, 0, 5)] + [("r", "m", 4, None), (None, "m", 1, 10)],
                                  "region string, model string, cycle int, step_h int")
    df = Z.zonal_stats(grid, weights, catchments=cats, steps=steps)
    got = sorted((r["cycle"], r["step_h"] or 0, r["cat_id"], r["count"], r["max"], r["mean"]) for r in df.collect())
    assert got == [(1, 10, 1, 4, 1.0, 1.0), (1, 10, 2, 0, None, None), (1, 15, 1, 0, None, None), (1, 15, 2, 0, None, None),
                   (2, 20, 1, 4, 2.0, 2.0), (2, 20, 2, 0, None, None), (2, 25, 1, 0, None, None), (2, 25, 2, 0, None, None),
                   (4, 0, 1, 0, None, None), (4, 0, 2, 0, None, None)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("Generate explode") < plan.find("Join LeftOuter")


def _odd_grid(spark, rnd):
    """Two regions and models, cycles weeks apart and without a time, cells that are absent, invalid, repeated or nowhere."""
    rows = []
    for region, model in (("r", "m"), ("r", "n"), ("q", "m"), (None, "m"), ("r", None)):
        for cycle in (0, 3, 40, 41, None):
            for step in (6, 12, 18, None):
                for row in (*range(45), None):
                    for col in (*range(0, 40, 3), 17, 17, None):
                        if rnd.random() < 0.3:
                            v = rnd.choice([None, float("nan"), 1e-12, -3.25, rnd.uniform(0, 500), rnd.uniform(0, 5)])
                            c = None if cycle is None else cycle * 86400
                            rows.append((region, model, c, step, None if None in (c, step) else c + step * 3600, row, col, v))
    g = spark.createDataFrame(rows, "region string, model string, c long, step_h int, v long, row int, col int, value double")
    return g.withColumn("cycle", F.timestamp_seconds("c")).withColumn("valid_time", F.timestamp_seconds("v")).drop("c", "v")


def test_cells_that_go_home_give_the_same_rows(spark):
    """``at_home`` against the join by cell: catchments over several tiles, of one
    cell, without a cell, not asked for, twice or without an id; steps that are not
    listed, listed twice or without a time."""
    rnd = random.Random(11)
    grid = _odd_grid(spark, rnd)
    weights = {("r", m, cat, cat * 2 % 41 + i, cat * 3 % 37 + j): rnd.randint(1, 49)
               for m in ("m", "n") for cat in range(1, 25) for i in range(1 + cat % 20) for j in range(1 + cat % 18) if rnd.random() < 0.6}
    weights |= {("q", "m", 2, 40, 39): 5, ("q", "m", None, 3, 3): 1, ("r", "m", 99, 0, 0): 7}
    w = spark.createDataFrame([(*k, n) for k, n in weights.items()], "region string, model string, cat_id long, row int, col int, w long")
    cats = spark.createDataFrame([("r", c) for c in (*range(1, 30), 3, None)] + [("q", 2), ("q", 3), ("z", 1), (None, 4)], "region string, cat_id long")
    listed = grid.filter("step_h is null or step_h < 18").select("region", "model", "cycle", "step_h", "valid_time")
    key = lambda r: tuple((x is not None, x) for x in r[:6])
    for steps in (listed, None):
        a = sorted(map(tuple, Z.zonal_stats(grid, w, catchments=cats, steps=steps).collect()), key=key)
        df = Z.zonal_stats(grid, w, catchments=cats, steps=steps, at_home=True)
        b = sorted(map(tuple, df.collect()), key=key)
        assert len(a) == len(b) > 1000 and [x[:8] for x in a] == [x[:8] for x in b]
        assert all((x[8] is None) == (y[8] is None) and (x[8] is None or math.isclose(x[8], y[8], rel_tol=1e-12)) for x, y in zip(a, b))
        assert df.dtypes == Z.zonal_stats(grid, w, catchments=cats, steps=steps).dtypes


def test_portions_of_catchments_at_home(spark, monkeypatch):
    """A home in many portions, and cycles that are no timestamps."""
    rnd = random.Random(5)
    grid = _odd_grid(spark, rnd).filter("region = 'r' and model = 'm'").withColumn("cycle", F.unix_seconds("cycle").cast("int")).drop("valid_time")
    w = spark.createDataFrame([("r", "m", c, c % 7 + i, c % 11 + j, 1 + i) for c in range(40) for i in range(3) for j in range(4)],
                              "region string, model string, cat_id long, row int, col int, w long")
    cats = spark.createDataFrame([("r", c) for c in range(41)], "region string, cat_id long")
    key = lambda r: tuple((x is not None, x) for x in r[:5])
    a = sorted(map(tuple, Z.zonal_stats(grid, w, catchments=cats).collect()), key=key)
    monkeypatch.setattr(Z, "MEET_CELLS", 3)
    b = sorted(map(tuple, Z.zonal_stats(grid, w, catchments=cats, at_home=True).collect()), key=key)
    assert [x[:7] for x in a] == [x[:7] for x in b]


def test_totals_that_fit_no_long_are_refused_at_home(spark):
    grid = spark.createDataFrame([("r", "m", 1, 0, 0, 1e18)], "region string, model string, step_h int, row int, col int, value double")
    weigh = lambda n: spark.createDataFrame([("r", "m", 7, 0, 0, n), ("r", "m", 7, 0, 1, 100)], "region string, model string, cat_id long, row int, col int, w long")
    cats = spark.createDataFrame([("r", 7)], "region string, cat_id long")
    assert Z.zonal_stats(grid, weigh(9), catchments=cats, at_home=True).first()["mean"] == 1e18
    w = weigh(100)
    with pytest.raises(Exception, match="does not fit a long"):
        Z.zonal_stats(grid, w, catchments=cats, at_home=True).collect()


def test_no_statistic_of_the_customers_is_shuffled(spark):
    """A row for each customer, step and task, and one for each customer and step
    again, were what filled the disk: behind the meeting of cells and catchments
    there is no exchange, before it none is as large."""
    plan = suite.z2_customer_stats(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1
    assert "Exchange" not in plan[:plan.index("FlatMapCoGroupsInArrow")] and "partial_sum(CASE" not in plan


def test_crossings_leave_as_columns(spark):
    """What the windows' shuffle moves: the crossing's column, no geometry of the grid."""
    rows = [("r", 1, [[[[1.0, 1.0], [4.0, 1.0], [4.0, 4.0], [1.0, 1.0]]]])]
    df = spark.createDataFrame(rows, "region string, cat_id long, coordinates array<array<array<array<double>>>>")
    node = Z.fine_spans(polygon_edges(df), spark.createDataFrame([GD], GD_SCHEMA))._jdf.queryExecution().optimizedPlan()
    while not node.nodeName().startswith("RepartitionByExpression"):
        node = node.children().apply(0)
    assert [node.output().apply(i).name() for i in range(node.output().size())] == ["region", "model", "cat_id", "part", "i", "factor", "u"]
