"""Zonal statistics through reusable cell weights.

The reference refines every step's raster k x k times and counts fine cells
whose centre lies inside each catchment.  The refined raster repeats each
coarse value k^2 times, so with

    w(cat, row, col) = number of fine-cell centres of coarse cell (row, col)
                       inside the catchment

the statistics are exactly ``count = sum w``, ``mean = sum(w v) / sum w`` and
``max = max v`` over cells with w > 0 — with k^2 fewer rows, and ``w`` is
computed once for all steps and cycles.

Z1 builds the weights with a scan-line fill written in Spark SQL: each polygon
edge is exploded to the fine rows whose centre it crosses (half-open rule),
crossings are paired along each row by a ``lead`` window (even-odd rule, so
holes subtract), spans of overlapping parts are merged, and each span is cut
into coarse columns.  Work grows with
edge length x k, not with area x k^2.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pluvio.functions.rounding import numpy_round1

WEIGHT_KEYS = ["region", "model", "cat_id", "row", "col"]
#: Where a crossing that is not a number stands: behind all columns.
NO_COLUMN = 2 ** 62


def fine_spans(edges: DataFrame, grid_def: DataFrame) -> DataFrame:
    """The fine cells inside each catchment as spans of fine rows:
    ``(region, model, cat_id, i, factor, ja, jb)``, ends included, no two of a
    catchment overlapping.

    ``edges``: ``region, cat_id, part, ring, x1, y1, x2, y2`` (S5).
    ``grid_def``: one row per (region, model); each region's edges meet its
    models' geometries.
    """
    gd = grid_def.select("region", "model", "x0", "y_top", "dx", "dy", "n_rows", "n_cols", "factor")
    e = edges.join(gd, ["region"], "inner")
    k = F.col("factor")
    fdy = F.col("dy") / k
    fdx = F.col("dx") / k
    ymin = F.least("y1", "y2")
    ymax = F.greatest("y1", "y2")
    # fine rows whose centre y = y_top - (i + 0.5) * fdy lies in [ymin, ymax);
    # one row of slack each side, then the exact test below decides
    lo = F.greatest(F.ceil((F.col("y_top") - ymax) / fdy - F.lit(0.5)) - 1, F.lit(0))
    hi = F.least(F.floor((F.col("y_top") - ymin) / fdy - F.lit(0.5)) + 1, F.col("n_rows") * k - 1)
    e = e.filter(F.col("y1") != F.col("y2"))          # horizontal edges never cross
    e = e.withColumn("i", F.explode(F.when(lo <= hi, F.sequence(lo.cast("int"), hi.cast("int")))))
    yc = F.col("y_top") - (F.col("i") + F.lit(0.5)) * fdy
    e = e.withColumn("yc", yc).filter((F.col("y1") > F.col("yc")) != (F.col("y2") > F.col("yc")))
    x = F.col("x1") + (F.col("yc") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    # a crossing leaves as the first fine column behind it, 0 to their number: the
    # order of the crossings is the order of these, and two that are equal hold nothing
    cols = F.col("n_cols") * k
    u = F.greatest(F.least(F.ceil((F.col("x") - F.col("x0")) / fdx - F.lit(0.5)), cols), F.lit(0)).cast("long")
    u = F.when(F.isnan("x"), F.lit(NO_COLUMN)).when(F.col("x").isNotNull(), u)
    c = e.withColumn("x", x).select("region", "model", "cat_id", "part", "i", "factor", u.alias("u"))

    # one shuffle for both windows below: hashing by (catchment, fine row) also
    # keeps the crossings of one part together
    keys = ["region", "model", "cat_id", "i"]
    c = c.repartition(*keys)
    # even-odd pairing of the crossings along each fine row of each part
    w = Window.partitionBy(*keys, "part").orderBy("u")
    c = c.withColumn("rn", F.row_number().over(w)).withColumn("nu", F.lead("u").over(w))
    spans = c.filter((F.col("rn") % 2 == 1) & F.col("nu").isNotNull() & (F.col("nu") != NO_COLUMN))

    ja = F.greatest(F.col("u"), F.lit(0))
    spans = (spans.select(*keys, "factor", ja.cast("long").alias("ja"), (F.col("nu") - 1).alias("jb"))
             .filter(F.col("ja") <= F.col("jb")))
    # parts may overlap: a fine cell counts once, so a span starts after all
    # that earlier spans of its row have covered
    before = Window.partitionBy(*keys).orderBy("ja", "jb").rowsBetween(Window.unboundedPreceding, -1)
    return (spans.withColumn("ja", F.greatest("ja", F.coalesce(F.max("jb").over(before) + 1, F.lit(0))))
            .filter(F.col("ja") <= F.col("jb")))


def zonal_weights(edges: DataFrame, grid_def: DataFrame) -> DataFrame:
    """``(region, model, cat_id, row, col, w)`` from polygon edges: a row for
    each coarse cell that a catchment touches."""
    spans = fine_spans(edges, grid_def)
    f = F.col("factor")
    cc = F.explode(F.sequence((F.col("ja") / f).cast("long"), (F.col("jb") / f).cast("long")))
    cells = spans.withColumn("c", cc)
    wlen = (F.least(F.col("jb"), F.col("c") * f + f - 1) - F.greatest(F.col("ja"), F.col("c") * f) + 1)
    cells = cells.select("region", "model", "cat_id",
                         (F.col("i") / f).cast("int").alias("row"), F.col("c").cast("int").alias("col"),
                         wlen.alias("w"))
    # Each fine row's span becomes one row per coarse cell it touches (about k
    # rows per output cell).  They stream straight into the partial aggregation
    # of the same stage, so only about one row per (catchment, coarse cell) and
    # task reaches the shuffle.  For catchments far wider than a coarse cell see
    # ``zonal_ranges``, whose rows follow the edges and not the area.
    return cells.groupBy(*WEIGHT_KEYS).agg(F.sum("w").alias("w"))


def zonal_ranges(edges: DataFrame, grid_def: DataFrame) -> DataFrame:
    """Z1 by runs: ``(region, model, cat_id, row, c0, c1, w)``, where each of the
    coarse cells c0 .. c1 of a row has weight ``w``.

    A span of fine cells leaves a marker where its whole coarse cells begin, one
    behind their end, and what it holds of the two cells at its ends.  Markers
    are summed per (catchment, coarse row, column); a running sum along the row
    says how many of the k fine rows hold a cell whole.  Cells between two
    markers are never rows, so rows grow with the length of the edges.
    """
    k = F.col("factor").cast("long")
    a, b = F.floor(F.col("ja") / k), F.floor(F.col("jb") / k)
    fa = F.when(F.col("ja") % k == 0, a).otherwise(a + 1)                 # first and last cell that is held whole
    fb = F.when(F.col("jb") % k == k - 1, b).otherwise(b - 1)
    none = F.lit(0).cast("long")
    mark = lambda c, d, p: F.struct(c.cast("int").alias("col"), d.alias("d"), p.cast("long").alias("p"))
    marks = F.array(
        F.when(fa <= fb, mark(fa, F.lit(1), none)), F.when(fa <= fb, mark(fb + 1, F.lit(-1), none)),
        F.when(fa > a, mark(a, F.lit(0), F.least(F.col("jb"), (a + 1) * k - 1) - F.col("ja") + 1)),
        F.when((fb < b) & ((b > a) | (fa == a)), mark(b, F.lit(0), F.col("jb") - F.greatest(F.col("ja"), b * k) + 1)))
    keys = ["region", "model", "cat_id", "row"]
    m = (fine_spans(edges, grid_def)
         .select("region", "model", "cat_id", F.floor(F.col("i") / k).cast("int").alias("row"), "factor", F.explode(marks).alias("m"))
         .filter("m is not null")
         .groupBy(*keys, "factor", "m.col").agg(F.sum("m.d").alias("d"), F.sum("m.p").alias("p")))
    row = Window.partitionBy(*keys).orderBy("col")
    m = m.withColumn("whole", F.sum("d").over(row) * F.col("factor")).withColumn("upto", F.lead("col").over(row) - 1)
    own = F.col("p") > 0
    begin = F.col("col") + own.cast("int")
    run = lambda c0, c1, w: F.struct(c0.alias("c0"), c1.alias("c1"), w.cast("long").alias("w"))
    runs = F.array(F.when(own, run(F.col("col"), F.col("col"), F.col("whole") + F.col("p"))),
                   F.when((F.col("whole") > 0) & (begin <= F.col("upto")), run(begin, F.col("upto"), F.col("whole"))))
    return m.select(*keys, F.explode(runs).alias("r")).filter("r is not null").select(*keys, "r.c0", "r.c1", "r.w")


def join_weights(grid: DataFrame, weights: DataFrame) -> DataFrame:
    """Z2 join: grid cells with the catchments that cover them.

    No hint: Spark's size estimate, and AQE's measured bytes, decide whether
    the weights are broadcast (the grid is then never shuffled) or both sides
    are shuffled on the cell key.
    """
    keys = ["region", "model", "row", "col"]
    return grid.join(weights.select(*keys, "cat_id", "w"), keys, "inner")


def covered_cells(grid: DataFrame, weights: DataFrame) -> DataFrame:
    """Keep only grid cells some catchment covers (semi join on the cell key).

    Applied before the per-cell shuffle of the de-accumulation, so that it
    carries only cells that can reach a statistic.
    """
    keys = ["region", "model", "row", "col"]
    return grid.join(weights.select(*keys).distinct(), keys, "left_semi")


STEP_KEYS = ["region", "model", "cycle", "step_h", "valid_time"]
GROUP = ["region", "model", "cycle"]
SUMMED = ("_n", "_whole", "_units", "_rest")
UNIT = 1_000_000_000          # sums run in whole and billionth units, the rest in doubles


def _parts(value: str):
    """A value's whole part, billionths and remainder, and whether it is valid."""
    v = F.col(value)
    whole = F.floor(v)
    units = F.rint((v - whole) * UNIT)
    return v, v.isNotNull() & ~F.isnan(v), whole, units, v - (whole + units / F.lit(float(UNIT)))


def _finished(stats: DataFrame, keys: list[str], grid: DataFrame, catchments: DataFrame | None, steps: DataFrame | None) -> DataFrame:
    """Sums to count, max and mean; a row for every catchment and step."""
    if catchments is not None:
        stats = _framed(stats, grid if steps is None else steps, catchments, keys)
    n = F.coalesce(F.col("count"), F.lit(0)).cast("bigint")
    # the total in units, exact; in longs wherever they hold it, which is nearly always
    small = F.col("_whole").between(-9_000_000_000, 9_000_000_000) & F.col("_units").between(-200_000_000_000_000_000, 200_000_000_000_000_000)
    total = (F.when(small, (F.col("_whole") * F.lit(UNIT).cast("long") + F.col("_units")).cast("double"))
             .otherwise((F.col("_whole").cast("decimal(38,0)") * F.lit(UNIT) + F.col("_units")).cast("double")))
    mean = F.when(n > 0, total / (n.cast("double") * F.lit(float(UNIT))) + F.col("_rest") / n)
    return stats.select(*keys, n.alias("count"), "max", mean.alias("mean"))


def _framed(stats: DataFrame, steps: DataFrame, catchments: DataFrame, keys: list[str]) -> DataFrame:
    """``stats`` with a row for every catchment of a region and each of its steps.

    What is shuffled is a row for each catchment and cycle and the statistics
    there are, packed by them; a cycle's steps, dozens, become rows behind the
    join.  So the frame, which is as large as the result, is neither shuffled nor
    sorted, and is made by all tasks that hold statistics.
    """
    group = [k for k in GROUP if k in keys]
    step = [k for k in keys if k not in (*group, "cat_id")]
    values = [c for c in stats.columns if c not in keys]
    cats = catchments.select("region", F.col("cat_id").cast("bigint").alias("cat_id")).distinct()
    plan = steps.select(*group, F.struct(*step).alias("s")).groupBy(*group).agg(F.array_sort(F.collect_set("s")).alias("steps"))
    there = (stats.dropna(subset=step or None).groupBy(*group, "cat_id")
             .agg(F.collect_list(F.struct(F.struct(*step).alias("s"), *values)).alias("there")))
    rows = (plan.join(cats, ["region"]).join(there, [*group, "cat_id"], "left")
            .select(*group, "cat_id", "there", F.col("there.s").alias("places"), F.explode("steps").alias("s")))
    one = F.struct(*[F.col(f"s.{k}").cast(stats.schema[k].dataType).alias(k) for k in step])
    own = F.get("there", (F.array_position("places", one) - 1).cast("int"))
    return rows.select(*group, *[F.col(f"s.{k}").alias(k) for k in step], "cat_id", own.alias("own")) \
               .select(*keys, *[F.col(f"own.{c}").alias(c) for c in values])


def every_row(stats: DataFrame, steps: DataFrame, catchments: DataFrame) -> DataFrame:
    """Finished statistics with a row for every catchment of a region and each of
    its steps; one that has none yet gets count 0."""
    keys = [k for k in STEP_KEYS if k in stats.columns] + ["cat_id"]
    return _framed(stats, steps, catchments, keys).withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))


def zonal_stats(grid: DataFrame, weights: DataFrame, value: str = "value",
                catchments: DataFrame | None = None, steps: DataFrame | None = None, at_home: bool = False) -> DataFrame:
    """Z2 + A1-A3: per (region, model, cycle, valid_time, cat_id): count, max, mean.

    * count = sum of weights over valid (non-null, non-NaN) cells (A1);
    * max   = largest valid value over covered cells (A2);
    * mean  = sum(w * v) / sum(w) (A3).  Each value is split into a whole
      part, billionths and a remainder.  The first two are summed as longs,
      which is exact in any order; the remainder, beyond the ninth decimal, is
      summed as doubles.  Nothing is cut off.

    With ``catchments`` (``region, cat_id``) every catchment of a region has a
    row for each of its steps: one that no valid cell covers has count 0, no
    mean and no max.  The result is as large as steps x catchments by nature.
    ``steps`` lists the steps (the step keys of ``grid``; a step manifest does),
    also those none of whose cells are in ``grid``; without it they are learned
    from the cells of ``grid``, which reads them a second time.

    All aggregates are algebraic: partial aggregation runs before the
    shuffle, so a catchment holding a third of all cells costs one row per task.

    Where small ``catchments`` outnumber the cells, that leaves more rows than
    all else: a row for each catchment, step and task.  ``at_home`` turns it round:
    cells go to the catchments, and no statistic is shuffled (``_stats_at_home``).
    """
    keys = [k for k in STEP_KEYS if k in grid.columns] + ["cat_id"]
    if at_home:
        if catchments is None or not set(keys) - {"region", "model", "cat_id"}:
            raise ValueError("at_home needs the catchments and a grid with steps")
        return _finished(_stats_at_home(grid, weights, value, catchments, steps), keys, grid, None, None)
    j = join_weights(grid, weights)
    v, valid, whole, units, rest = _parts(value)
    w = F.col("w")
    stats = j.groupBy(*keys).agg(
        F.sum(F.when(valid, w)).alias("count"),
        F.max(F.when(valid, v)).alias("max"),
        F.sum(F.when(valid, w * whole.cast("long"))).alias("_whole"),
        F.sum(F.when(valid, w * units.cast("long"))).alias("_units"),
        F.sum(F.when(valid, w * rest)).alias("_rest"))
    return _finished(stats, keys, grid, catchments, steps)


#: Grid rows and columns of a home, and the days of cycles that are met there at once.
HOME_CELLS, HOME_DAYS = 16, 16
#: Cells of catchments, or their steps, that a task holds at once.
MEET_CELLS = 200_000
#: A column that holds no cell: where the steps are listed.
NOWHERE = -2 ** 31


def _span(grid: DataFrame) -> F.Column:
    """The cycles that are met together: those of ``HOME_DAYS`` days, or of one value where cycles are no timestamps."""
    if "cycle" not in grid.columns:
        return F.lit(0).cast("long")
    if grid.schema["cycle"].dataType.typeName() != "timestamp":
        return F.xxhash64("cycle")
    return F.coalesce(F.floor(F.unix_micros("cycle") / F.lit(HOME_DAYS * 86_400_000_000)), F.lit(NOWHERE)).cast("long")


def _stats_at_home(grid: DataFrame, weights: DataFrame, value: str, catchments: DataFrame, steps: DataFrame | None) -> DataFrame:
    """A catchment's home is the tile of its first row and column; its cells, as
    one row, and the grid's cells that any catchment of a home covers meet there
    and give all steps of the catchment.  What is shuffled is the grid, a cell once
    for each home that needs it, and the catchments, once for each span of cycles.

    A home's list of steps comes like a cell of the grid, from a place that all
    homes need, so the frame of steps becomes rows behind the last shuffle.
    Catchments without a weight get theirs without leaving for a home.
    Memory follows a home's cells in one span: it is meant for catchments of few
    cells, ``zonal_stats_by_ranges`` for large ones.
    """
    keys = [k for k in STEP_KEYS if k in grid.columns]
    step = [k for k in keys if k not in ("region", "model")]
    times = [k for k in step if grid.schema[k].dataType.typeName() == "timestamp"]
    flat = {k: F.unix_micros(k) for k in times}
    place = ["region", "model", "_top", "_left"]
    given = grid if steps is None else steps
    frame = given.select(*[F.col(k).cast(grid.schema[k].dataType).alias(k) for k in keys]).filter("region is not null").distinct()
    tile = lambda c: F.floor(F.col(c) / HOME_CELLS).cast("int")

    at = lambda row, col, t, w: F.struct(row.cast("int").alias("row"), col.cast("int").alias("col"), t.cast("int").alias("t"), w.cast("long").alias("w"))
    own = (weights.dropna(subset=WEIGHT_KEYS).groupBy("region", "model", F.col("cat_id").cast("bigint").alias("cat_id"))
           .agg(F.floor(F.min("row") / HOME_CELLS).cast("int").alias("_top"), F.floor(F.min("col") / HOME_CELLS).cast("int").alias("_left"),
                F.collect_list(at(F.col("row"), F.col("col"), tile("col"), F.coalesce("w", F.lit(0)))).alias("c"))
           .dropna())                 # asks for every column, so all three uses below read one exchange
    steps_at = at(F.lit(0), F.lit(0), F.lit(NOWHERE), F.lit(0))
    needs = (own.select(*place, F.explode(F.concat("c", F.array(steps_at))).alias("c"))
             .groupBy(*place, F.col("c.row").alias("row"), F.col("c.t").alias("t")).agg(F.min("c.col").alias("c0"), F.max("c.col").alias("c1")))

    v = F.coalesce(F.col(value).cast("double"), F.lit(float("nan")))
    cells = grid.select(*keys, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), tile("col").alias("t"), v.alias("v"))
    listed = frame.select(*keys, F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(NOWHERE).alias("t"), F.lit(None).cast("double").alias("v"))
    here = (cells.unionByName(listed).withColumn("_span", _span(grid)).withColumns(flat).join(needs, ["region", "model", "row", "t"])
            .filter("col between c0 and c1").select(*[F.col(k).alias(k) for k in place], "_span", *step, "row", "col", "v"))

    spans = frame.select("region", "model", _span(grid).alias("s")).groupBy("region", "model").agg(F.collect_set("s").alias("spans"))
    cats = catchments.select("region", F.col("cat_id").cast("bigint").alias("cat_id")).distinct().join(spans, ["region"])
    mine = (cats.join(own, ["region", "model", "cat_id"])
            .select(*[F.col(k).alias(k) for k in place], "cat_id", F.explode("spans").alias("_span"), *[F.col(f"c.{n}").alias(f"c_{n}") for n in ("row", "col", "w")]))

    lists = [T.StructField(n, T.ArrayType(t)) for n, t in [
        *((f.name, f.dataType) for f in here.select(*step).schema), *((n, T.DoubleType() if n == "_rest" else T.LongType()) for n in SUMMED), ("max", T.DoubleType())]]
    found = T.StructType([*grid.select("region", "model").schema, T.StructField("cat_id", T.LongType()), *lists])
    group = [*place, "_span"]
    packed = here.groupBy(*group).cogroup(mine.groupBy(*group)).applyInArrow(_meet(step, to_arrow_schema(found)), found)
    first, *others = [f.name for f in lists]
    rows = packed.select("region", "model", "cat_id", F.posexplode(first).alias("_i", first), *others) \
                 .select("region", "model", "cat_id", first, *[F.get(n, F.col("_i")).alias(n) for n in others])
    rows = rows.withColumns({k: F.timestamp_micros(k) for k in times}).withColumnRenamed("_n", "count")

    plan = frame.groupBy("region", F.col("model").alias("_model"), *[k for k in GROUP if k in step]) \
                .agg(F.collect_list(F.struct(*step)).alias("s"))
    no = cats.join(own, ["region", "model", "cat_id"], "left_anti").select("region", "model", "cat_id")
    no = (no.join(plan.select(F.col("region").alias("_region"), "_model", "s"), (F.col("region") == F.col("_region")) & F.col("model").eqNullSafe(F.col("_model")))
          .select("region", "model", "cat_id", F.explode("s").alias("s")).select("region", "model", "cat_id", "s.*"))
    empty = {n: F.lit(None).cast(rows.schema[n].dataType) for n in ("max", "_whole", "_units", "_rest")}
    rows = rows.unionByName(no.withColumns({"count": F.lit(0).cast("bigint"), **empty}))
    return rows.select(*[F.col(k).cast(given.schema[k].dataType).alias(k) for k in keys], "cat_id", "count",
                       F.col("max").cast(grid.schema[value].dataType).alias("max"), "_whole", "_units", "_rest")


def _meet(steps: list[str], schema: pa.Schema):
    """The function that meets the cells at a home with its catchments: a row for
    each catchment, of lists over all steps that are listed there.  It goes through
    the catchments in portions of ``MEET_CELLS`` cells, or one catchment if that has more."""
    def valid(table):
        return np.logical_and.reduce([pc.is_valid(table.column(k)).to_numpy() for k in steps])

    def places(frame, cells):
        """Each cell's place in the list of steps, -1 where its step is not listed."""
        known = np.flatnonzero(valid(frame))
        at, own = np.zeros(len(known), np.int64), np.zeros(cells.num_rows, np.int64)
        if not len(known):
            return own - 1
        for k in steps:
            listed, mine = frame.column(k).take(pa.array(known)).to_numpy(), cells.column(k).to_numpy()
            values = np.unique(listed)
            i = np.minimum(np.searchsorted(values, mine), len(values) - 1)
            own = np.where((own >= 0) & (values[i] == mine), own * len(values) + i, -1)
            at = at * len(values) + np.searchsorted(values, listed)
        order = np.argsort(at)
        i = np.minimum(np.searchsorted(at[order], own), len(at) - 1)
        return np.where(at[order][i] == own, known[order][i], -1)

    def stats(cells, cats):
        if not cells.num_rows or not cats.num_rows:
            return schema.empty_table()
        listed = pc.is_null(cells.column("v"))
        frame, cells = cells.filter(listed), cells.filter(pc.invert(listed))
        cells = cells.filter(pa.array(valid(cells) & ~np.isnan(cells.column("v").to_numpy())))
        size = frame.num_rows
        step, v = places(frame, cells), cells.column("v").to_numpy()
        cell = cells.column("row").to_numpy().astype(np.int64) * 2 ** 32 + cells.column("col").to_numpy()
        order = np.argsort(cell, kind="stable")
        order = order[step[order] >= 0]
        cell, step, v = cell[order], step[order], v[order]
        lens = pc.list_value_length(cats.column("c_row")).to_numpy()
        row, col, w = (cats.column(n).combine_chunks().flatten().to_numpy() for n in ("c_row", "c_col", "c_w"))
        probe = row.astype(np.int64) * 2 ** 32 + col
        first = np.searchsorted(cell, probe)
        many = np.searchsorted(cell, probe, "right") - first
        ends, total = np.r_[0, np.cumsum(lens)], np.r_[0, np.cumsum(many)]
        large = len(v) > 0 and np.abs(v).max() >= UNIT
        whole = np.floor(v)
        units = np.rint((v - whole) * UNIT)
        rest = v - (whole + units / float(UNIT))
        whole, units = whole.astype(np.int64), units.astype(np.int64)
        portion = np.cumsum(np.maximum(total[ends[1:]] - total[ends[:-1]], size)) // MEET_CELLS
        cuts = np.r_[0, np.flatnonzero(np.diff(portion)) + 1, len(lens)]
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            part = slice(ends[a], ends[b])
            n = many[part]
            at = np.repeat(first[part] - (total[part] - total[ends[a]]), n) + np.arange(n.sum())
            key = np.repeat(np.repeat(np.arange(b - a) * size, lens[a:b]), n) + step[at]
            by = np.repeat(w[part], n)
            if large and np.bincount(key, np.abs(by * v[at])).max(initial=0) >= 2.0 ** 63:
                raise OverflowError("a catchment's total does not fit a long")
            sums = []
            for x in (by, by * whole[at], by * units[at], by * rest[at]):
                sums.append(np.zeros((b - a) * size, x.dtype))
                np.add.at(sums[-1], key, x)
            top = np.full((b - a) * size, np.nan)
            np.fmax.at(top, key, v[at])
            offsets = pa.array(np.arange(b - a + 1, dtype=np.int32) * size)
            every = pa.array(np.tile(np.arange(size), b - a))
            flat = {k: frame.column(k).combine_chunks().take(every) for k in steps}
            flat |= {n: pa.array(x) for n, x in zip(SUMMED, sums)} | {"max": pa.array(top, from_pandas=True)}
            rows = {n: cats.column(n).slice(a, b - a) for n in ("region", "model", "cat_id")}
            rows |= {n: pa.ListArray.from_arrays(offsets, x) for n, x in flat.items()}
            out.append(pa.table([rows[n] for n in schema.names], names=schema.names).cast(schema))
        return pa.concat_tables(out)
    return stats


#: Grid rows that are looked up together: a catchment's statistics leave once
#: for each band that it lies in.
BAND_ROWS = 64
#: Dense cells, and look-ups, that a task holds at once.
BAND_CELLS = 1_000_000


def row_profiles(grid: DataFrame, value: str = "value") -> DataFrame:
    """Each step's cells by bands of ``BAND_ROWS`` grid rows, one row per step and
    band: arrays of the cells' place (``_row`` in the band, ``_col``) and of what
    is summed (``_n, _whole, _units, _rest``) or maximised (``_top``, NaN for none).

    The grid is shuffled once, by (region, model, cycle) and band, as it is: cells
    that are absent are nowhere rows.  Running sums along a row and its range
    maxima are made of these arrays where they are looked up (``_look_up``).
    """
    steps = [k for k in STEP_KEYS if k in grid.columns]
    group = [k for k in GROUP if k in grid.columns]
    v, valid, whole, units, rest = _parts(value)
    zero = F.lit(0).cast("long")
    band = F.floor(F.col("row") / BAND_ROWS).cast("int")
    cell = F.struct((F.col("row") - band * BAND_ROWS).cast("int").alias("_row"), F.col("col").cast("int").alias("_col"),
                    valid.cast("long").alias("_n"), F.when(valid, whole.cast("long")).otherwise(zero).alias("_whole"),
                    F.when(valid, units.cast("long")).otherwise(zero).alias("_units"), F.when(valid, rest).otherwise(0.0).alias("_rest"),
                    F.when(valid, v.cast("double")).otherwise(float("nan")).alias("_top"))
    cells = (grid.filter("row is not null and col is not null").select(*steps, band.alias("band"), cell.alias("c"))
             .repartition(*group, "band").groupBy(*steps, "band").agg(F.collect_list("c").alias("c")))
    return cells.select(*steps, "band", *[F.col(f"c.{n}").alias(n) for n in ("_row", "_col", *SUMMED, "_top")])


def range_probes(ranges: DataFrame) -> DataFrame:
    """The cells at which a range is looked up: ``(region, model, row, col,
    cat_id, sign, level)``.  Sums are the profile at c1 less the profile before
    c0, ``sign`` holds the weight with its sign; the maximum is that of two
    overlapping blocks of 2 ** level cells."""
    level = F.floor(F.log2((F.col("c1") - F.col("c0") + 1).cast("double"))).cast("int")
    at = lambda c, sign, lev: F.struct(c.cast("int").alias("col"), sign.cast("long").alias("sign"), lev.alias("level"))
    none, w = F.lit(None).cast("int"), F.col("w")
    second = F.col("c1") - F.pow(F.lit(2.0), level.cast("double")).cast("int") + 1
    probes = F.array(at(F.col("c1"), w, none), F.when(F.col("c0") > 0, at(F.col("c0") - 1, -w, none)),
                     at(F.col("c0"), F.lit(0), level), F.when(second > F.col("c0"), at(second, F.lit(0), level)))
    return (ranges.select("region", "model", "row", "cat_id", F.explode(probes).alias("p")).filter("p is not null")
            .groupBy("region", "model", "row", "p.col", "cat_id", "p.level").agg(F.sum("p.sign").alias("sign")))


def _look_up(steps: list[str], schema: pa.Schema):
    """The function that meets a band's cells with its probes, one (region, model,
    cycle) at a time: a row for each step and catchment that has a cell in one of
    the catchment's grid rows there.  It goes through the steps in portions, so
    memory follows ``BAND_CELLS``, or one step of the band if that is more."""
    def values(table, name):
        return table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)

    def first_of(cat):
        """Where each catchment's probes begin, and its number."""
        at = np.flatnonzero(np.r_[True, cat[1:] != cat[:-1]]) if len(cat) else np.zeros(0, int)
        return at, cat[at]

    def stats(cells, probes):
        if not cells.num_rows or not probes.num_rows:
            return schema.empty_table()
        row, col, level, sign = (values(probes, n) for n in ("p_row", "p_col", "p_level", "p_sign"))
        cat = np.repeat(np.arange(probes.num_rows), pc.list_value_length(probes.column("p_row")).to_numpy())
        summed = level < 0
        begin, _ = first_of(cat[summed])
        wide, high = int(col.max()) + 1, int(row.max()) + 1
        lens = pc.list_value_length(cells.column("_row")).to_numpy()
        step = np.repeat(np.arange(cells.num_rows), lens)
        own = {n: values(cells, n) for n in ("_row", "_col", *SUMMED, "_top")}
        few = max(1, BAND_CELLS // max(high * wide, len(row)))
        ends = np.r_[0, np.cumsum(lens)]
        out = []
        for a in range(0, cells.num_rows, few):
            b = min(a + few, cells.num_rows)
            part = slice(ends[a], ends[b])
            s, r, c = step[part] - a, own["_row"][part], own["_col"][part]
            there = np.zeros((b - a, BAND_ROWS), bool)
            there[s, r] = True
            present = np.logical_or.reduceat(there[:, row[summed]], begin, axis=1)
            inside = (r < high) & (c >= 0) & (c < wide)
            at = (s[inside], r[inside], c[inside])
            sums = []
            for n in SUMMED:
                dense = np.zeros((b - a, high, wide), own[n].dtype)
                np.add.at(dense, at, own[n][part][inside])
                dense = np.cumsum(dense, axis=2)
                sums.append(np.add.reduceat(dense[:, row[summed], col[summed]] * sign[summed], begin, axis=1))
            top = np.full((b - a, high, wide), np.nan)
            np.fmax.at(top, at, own["_top"][part][inside])
            best = np.full(present.shape, np.nan)
            for j in range(int(level.max()) + 1):
                if j and 1 << (j - 1) < wide:          # element c: the largest of the 2 ** j cells from c on
                    half = 1 << (j - 1)
                    top = np.concatenate([np.fmax(top[:, :, :-half], top[:, :, half:]), top[:, :, -half:]], axis=2)
                here = level == j
                if here.any():
                    starts, cats = first_of(cat[here])
                    best[:, cats] = np.fmax(best[:, cats], np.fmax.reduceat(top[:, row[here], col[here]], starts, axis=1))
            i, k = np.nonzero(present)
            rows = {n: cells.column(n).slice(a, b - a).take(pa.array(i)) for n in steps}
            rows["cat_id"] = probes.column("cat_id").take(pa.array(k))
            rows |= {n: pa.array(x[i, k]) for n, x in zip(SUMMED, sums)}
            rows["_top"] = pa.array(best[i, k], from_pandas=True)
            out.append(pa.table([rows[n] for n in schema.names], schema=schema))
        return pa.concat_tables(out)
    return stats


def zonal_stats_by_ranges(grid: DataFrame, ranges: DataFrame, grid_def: DataFrame, value: str = "value",
                          catchments: DataFrame | None = None, steps: DataFrame | None = None) -> DataFrame:
    """Z2 + A1-A3 from ``zonal_ranges``: the rows of ``zonal_stats``.

    Interior cells are never joined: a range costs two look-ups for its sums and
    two for its maximum, whatever its length.  Sums run in whole numbers, so a
    difference of running sums is exact.  Cells and probes are shuffled once, to
    the band of grid rows they lie in, cycle by cycle; a catchment and step leave a
    band as one row, whatever number of probes they had there.  A catchment's
    probes come once to each cycle, which has dozens of steps: fewer bytes than
    the statistics that leave.  Where the weights are few enough to be broadcast
    and catchments are small, ``zonal_stats`` is the cheaper form.
    """
    keys = [k for k in STEP_KEYS if k in grid.columns]
    group = [k for k in GROUP if k in grid.columns]
    times = [k for k in keys if grid.schema[k].dataType.typeName() == "timestamp"]
    profiles = row_profiles(grid, value).withColumns({k: F.unix_micros(k) for k in times})
    band = F.floor(F.col("row") / BAND_ROWS).cast("int")
    probe = F.struct((F.col("row") - band * BAND_ROWS).cast("int").alias("row"), "col", F.coalesce("level", F.lit(-1)).alias("level"), "sign")
    cycles = (steps if catchments is not None and steps is not None else grid).select(*group).distinct()
    probes = (range_probes(ranges).select("region", "model", band.alias("band"), "cat_id", probe.alias("p"))
              .groupBy("region", "model", "band", "cat_id").agg(F.collect_list("p").alias("p"))
              .select("region", "model", "band", "cat_id", *[F.col(f"p.{n}").alias(f"p_{n}") for n in ("row", "col", "level", "sign")])
              .join(cycles.withColumns({k: F.unix_micros(k) for k in group if k in times}), ["region", "model"]))
    found = T.StructType([*[profiles.schema[k] for k in keys], ranges.schema["cat_id"],
                          *[T.StructField(n, T.DoubleType() if n == "_rest" else T.LongType()) for n in SUMMED],
                          T.StructField("_top", T.DoubleType())])
    found = T.StructType([T.StructField(f.name, f.dataType) for f in found])
    by_band = (profiles.groupBy(*group, "band").cogroup(probes.groupBy(*group, "band"))
               .applyInArrow(_look_up(keys, to_arrow_schema(found)), found)
               .withColumns({k: F.timestamp_micros(k) for k in times}))
    stats = by_band.groupBy(*keys, "cat_id").agg(
        F.sum("_n").alias("count"), F.max("_top").alias("max"), *[F.sum(c).alias(c) for c in ("_whole", "_units", "_rest")])
    return _finished(stats, [*keys, "cat_id"], grid, catchments, steps)


def round_stats(stats: DataFrame) -> DataFrame:
    """A4: ``max`` and ``mean`` to one decimal as a numpy frame rounds: ``rint(x * 10) / 10``."""
    return stats.withColumn("max", numpy_round1("max")).withColumn("mean", numpy_round1("mean"))
