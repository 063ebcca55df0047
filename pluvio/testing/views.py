"""Views over the driver's tables, in Spark.

The same views are written in DuckDB SQL in ``pluvio.testing.oracle``; both
derive everything from the given tables, so the work grows with them:

* ``events`` -> forecast cells: ``cat_id = user_id``; one bucket per forecast
  step (6 h for gfs, 1 h for wrfpr); the bucket's end is the valid time;
  rain = sum of ``value`` in exact cents.
  gfs cycles are 7 days (28 steps) from Monday 00 UTC; wrfpr cycles are 2 days
  (48 steps) from 06 UTC.
* ``results`` -> zonal-results table; ``grid``/``raw_grid`` -> forecast grids
  (cell = ``(user_id div 15, user_id % 15)``); ``customer`` -> thresholds;
  ``supplier`` -> the catchments of the zonal queries and ``customer`` -> a
  larger set for the weights (both grow with the data and spread over the
  whole grid); ``orders`` -> chart requests.

The data holds what real runs hold: means that are missing, cells without
data, values of many decimals, a second variable on the grid, cells outside
the region's box, catchments smaller than a fine cell, and parts that overlap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.functions.rounding import half_even_div
from pluvio.session import literal_table

REGION = "testbasin"
REGION2 = "testbasin2"             # the same data on a grid shifted half a cell west
PRODUCT = "01FFG2018021312"
N_COLS = 15
FACTOR = 10                         # refinement of the test grid
X0, Y_TOP, DX, DY = 0.0, 10.0, 1.0, 1.0

# model -> (bucket seconds, cycle seconds, cycle origin offset seconds)
BUCKETS = {
    "gfs": (21600, 604800, 345600),     # weekly cycles from Monday 00 UTC
    "wrfpr": (3600, 172800, 21600),     # 2-day cycles from 06 UTC
}


def region_of(key) -> "F.Column":
    """Every test catchment, cell and point lies in one region.

    Tied to a key column (not a bare literal) so the optimizer keeps
    ``region`` as a join key, as it is with real multi-region data.
    """
    k = F.col(key) if isinstance(key, str) else key
    return F.when(k.isNotNull(), F.lit(REGION))


def micros(ts: str):
    """Microseconds since 1970 of a zone-less time column, read as UTC."""
    since = f"cast(cast({ts} - timestamp_ntz'1970-01-01 00:00:00' as interval second) as decimal(20, 6))"
    return F.expr(f"cast({since} * 1000000 as bigint)")


def fdiv(x, n: int):
    """Exact floor division of a long column by a positive constant."""
    return ((x - F.pmod(x, F.lit(n))) / F.lit(n)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cells(spark: SparkSession, sf_dir: str, model: str) -> DataFrame:
    """One row per (catchment, step): cents, max cents, event count."""
    bucket, cyc, off = BUCKETS[model]
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "value")
    us = micros("ts")
    cents = F.round(F.col("value") * 100).cast("long")
    cells = (ev.select(F.col("user_id").alias("cat_id"),
                       ((fdiv(us, bucket * 1_000_000) + 1) * bucket).alias("vt_s"),
                       cents.alias("cents"))
             .groupBy("cat_id", "vt_s")
             .agg(F.sum("cents").alias("cents"), F.max("cents").alias("mx_cents"),
                  F.count(F.lit(1)).alias("n")))
    first = F.col("vt_s") - F.lit(bucket)
    cycle_s = fdiv(first - F.lit(off), cyc) * F.lit(cyc) + F.lit(off)
    return (cells.withColumn("cycle_s", cycle_s.cast("long"))
            .withColumn("step_h", fdiv(F.col("vt_s") - F.col("cycle_s"), 3600).cast("int"))
            .withColumn("model", F.lit(model)))


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The steps that any event falls into, as a step manifest has them."""
    us = micros("ts")
    out = None
    for model, (bucket, cyc, off) in BUCKETS.items():
        vt = (fdiv(us, bucket * 1_000_000) + 1) * bucket
        s = table(spark, sf_dir, "events").select(vt.alias("vt_s")).distinct()
        c = fdiv(F.col("vt_s") - F.lit(bucket + off), cyc) * F.lit(cyc) + F.lit(off)
        s = s.select(region_of("vt_s").alias("region"), F.lit(model).alias("model"), F.timestamp_seconds(c).alias("cycle"),
                     fdiv(F.col("vt_s") - c, 3600).cast("int").alias("step_h"), F.timestamp_seconds("vt_s").alias("valid_time"))
        out = s if out is None else out.unionByName(s)
    return out


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir, "gfs").unionByName(_cells(spark, sf_dir, "wrfpr"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zonal-results table in canonical form (one row per catchment and step)."""
    c = cells(spark, sf_dir)
    return c.select(
        region_of("cat_id").alias("region"), "model", "cat_id",
        (half_even_div(F.col("mx_cents"), F.lit(10)) / F.lit(10.0)).alias("max"),
        F.when(F.pmod(F.col("cat_id") * 7 + fdiv(F.col("vt_s"), 3600), F.lit(41)) != 0,
               half_even_div(F.col("cents"), F.col("n") * 10) / F.lit(10.0)).alias("mean"),
        F.col("n").alias("count"),
        F.timestamp_seconds("cycle_s").alias("cycle"),
        F.timestamp_seconds("vt_s").alias("valid_time"),
        "step_h")


def thresholds_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold table in the reference's wide form (negative = sentinel)."""
    cu = table(spark, sf_dir, "customer")
    return cu.select(F.col("c_custkey").alias("BASIN"),
                     (F.col("c_acctbal") / F.lit(20.0)).alias(PRODUCT))


def _value(cents) -> "F.Column":
    """Rain of a cell: many decimals, also after differencing, and no data in one cell-step of 101."""
    v = cents / F.lit(100.0) + (F.pmod(F.col("cat_id") * 31, F.lit(997)) + 1).cast("double") / F.lit(1000003.0) * F.col("step_h")
    return F.when(F.pmod(F.col("cat_id") * 13 + fdiv(F.col("vt_s"), 3600), F.lit(101)) != 0, v)


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast grid, interval values (what G1 recovers from ``raw_grid``)."""
    c = cells(spark, sf_dir)
    return c.select(
        region_of("cat_id").alias("region"), "model",
        F.timestamp_seconds("cycle_s").alias("cycle"), "step_h",
        F.timestamp_seconds("vt_s").alias("valid_time"),
        F.lit("APCP").alias("var"), F.lit("surface").alias("level"),
        fdiv(F.col("cat_id"), N_COLS).cast("int").alias("row"),
        F.pmod(F.col("cat_id"), F.lit(N_COLS)).cast("int").alias("col"),
        _value(F.col("cents")).alias("value"))


def raw_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid as the models deliver it: gfs per interval, wrfpr as running totals."""
    c = cells(spark, sf_dir)
    w = (Window.partitionBy("model", "cycle_s", "cat_id").orderBy("vt_s")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cents = F.when(F.col("model") == "wrfpr", F.sum("cents").over(w)).otherwise(F.col("cents"))
    return c.select(
        region_of("cat_id").alias("region"), "model",
        F.timestamp_seconds("cycle_s").alias("cycle"), "step_h",
        F.timestamp_seconds("vt_s").alias("valid_time"),
        F.lit("APCP").alias("var"), F.lit("surface").alias("level"),
        fdiv(F.col("cat_id"), N_COLS).cast("int").alias("row"),
        F.pmod(F.col("cat_id"), F.lit(N_COLS)).cast("int").alias("col"),
        _value(cents).alias("value"))


def raw_grid_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered grid with a second variable in every cell and step."""
    raw = raw_grid(spark, sf_dir)
    one = lambda var, level, value: F.struct(var.alias("var"), level.alias("level"), value.alias("value"))
    both = F.array(one(F.col("var"), F.col("level"), F.col("value")), one(F.lit("TMP"), F.lit("heightAboveGround"), F.lit(99999.0)))
    names = ("var", "level", "value")
    return (raw.select(*[c for c in raw.columns if c not in names], F.explode(both).alias("v"))
            .select(*[F.col(f"v.{c}").alias(c) if c in names else F.col(c) for c in raw.columns]))


def grid_vars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A multi-variable decoded grid: one variable per event type (for F3)."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "value", "event_type")
    us = micros("ts")
    vt = (fdiv(us, 21600 * 1_000_000) + 1) * 21600
    g = (ev.select(vt.alias("vt_s"), F.upper("event_type").alias("var"),
                   F.when(F.col("event_type").isin("click", "view"), F.lit("surface"))
                   .otherwise(F.lit("heightAboveGround")).alias("level"),
                   fdiv(F.col("user_id"), N_COLS).cast("int").alias("row"),
                   F.pmod(F.col("user_id"), F.lit(N_COLS)).cast("int").alias("col"),
                   F.round(F.col("value") * 100).cast("long").alias("cents"))
         .groupBy("vt_s", "var", "level", "row", "col").agg(F.sum("cents").alias("cents")))
    return g.select(region_of("row").alias("region"), F.lit("gfs").alias("model"),
                    F.timestamp_seconds("vt_s").alias("valid_time"), "var", "level", "row", "col",
                    (F.col("cents") / F.lit(100.0)).alias("value"))


def grid_def(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid geometry per (region, model); the row count follows the data."""
    ev = table(spark, sf_dir, "events")
    n_rows = ev.agg(fdiv(F.max("user_id"), N_COLS).cast("int").alias("m")).select((F.col("m") + 1).alias("n_rows"))
    return n_rows.select(
        region_of("n_rows").alias("region"),
        F.explode(F.array(F.lit("gfs"), F.lit("wrfpr"))).alias("model"),
        F.lit(X0).alias("x0"), F.lit(Y_TOP).alias("y_top"), F.lit(DX).alias("dx"), F.lit(DY).alias("dy"),
        F.col("n_rows").cast("int").alias("n_rows"), F.lit(N_COLS).alias("n_cols"),
        F.lit(FACTOR).alias("factor"))


def _diamond(cx, cy, hw, hh):
    return F.array(F.array(cx - hw, cy), F.array(cx, cy + hh), F.array(cx + hw, cy),
                   F.array(cx, cy - hh), F.array(cx - hw, cy))


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catchment polygons of the zonal queries: one diamond per supplier, ten
    to a grid row, over all rows of the grid.  One in seven is smaller than
    the distance of two fine-cell centres and holds none."""
    su = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    tiny = F.pmod(k, F.lit(7)) == 3
    cx = F.pmod(k, F.lit(10)).cast("double") * 1.5 + 0.7671
    cy = F.lit(9.5) - fdiv(k.cast("long"), 10).cast("double") + 0.0213
    hw = F.when(tiny, 0.01).otherwise(F.lit(0.9) + F.pmod(k, F.lit(5)).cast("double") * F.lit(0.13))
    hh = F.when(tiny, 0.01).otherwise(F.lit(0.7) + F.pmod(k, F.lit(3)).cast("double") * F.lit(0.17))
    geometry = F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(_diamond(cx, cy, hw, hh))).alias("coordinates"))
    return su.select(region_of(k).alias("region"), k.cast("bigint").alias("cat_id"),
                     F.create_map(F.lit("NAME"), F.col("s_name")).alias("props"), geometry.alias("geometry"))


def basins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide catchments: one diamond per supplier, several coarse cells across,
    whose inner cells by far outnumber those on its edge."""
    su = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    cx = F.pmod(k, F.lit(7)).cast("double") * 0.8713 + 4.7671
    cy = F.lit(7.1) - fdiv(k.cast("long"), 10).cast("double") + 0.0213
    hw = F.lit(4.3107) + F.pmod(k, F.lit(5)).cast("double") * F.lit(0.6171)
    hh = F.lit(3.1093) + F.pmod(k, F.lit(3)).cast("double") * F.lit(0.4719)
    return su.select(region_of(k).alias("region"), k.cast("bigint").alias("cat_id"),
                     F.create_map(F.lit("NAME"), F.col("s_name")).alias("props"),
                     F.array(F.array(_diamond(cx, cy, hw, hh))).alias("coordinates"))


def tied_raw_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivered grid in quarters: differences and sums are exact in doubles,
    and many zonal means lie on a tie of the rounding to one decimal."""
    g = raw_grid(spark, sf_dir).drop("var", "level")
    return g.withColumn("value", F.floor(F.col("value") * 4) / F.lit(4.0))


def catchments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger catchment set: two overlapping diamonds per customer.

    Centres run down the whole grid with irregular offsets and sizes (no
    crossing falls on a fine-cell centre); many catchments overlap too.
    """
    cu = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    q = fdiv(k, 15)
    cx = F.pmod(k, F.lit(15)).cast("double") + F.lit(0.5) + F.pmod(q, F.lit(7)).cast("double") * F.lit(0.0371)
    cy = (F.lit(9.5) - q.cast("double") * F.lit(0.1)
          - F.pmod(k, F.lit(11)).cast("double") * F.lit(0.0293))
    hw = F.lit(0.45) + F.pmod(k, F.lit(5)).cast("double") * F.lit(0.173)
    hh = F.lit(0.35) + F.pmod(k, F.lit(3)).cast("double") * F.lit(0.141)
    second = _diamond(cx + F.lit(0.2137), cy + F.lit(0.1319), hw, hh)
    return cu.select(region_of(k).alias("region"), k.cast("bigint").alias("cat_id"),
                     F.create_map(F.lit("NAME"), F.col("c_name")).alias("props"),
                     F.array(F.array(_diamond(cx, cy, hw, hh)), F.array(second)).alias("coordinates"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart requests as the web page sends them (JSON text bodies)."""
    o = table(spark, sf_dir, "orders")
    model = F.when(F.col("o_orderstatus") == "F", F.lit("wrfpr")).otherwise(F.lit("gfs"))
    body = F.to_json(F.struct(region_of("o_custkey").alias("region"), model.alias("model"),
                              F.col("o_custkey").alias("watershedID")))
    return o.select(F.col("o_orderkey").alias("request_id"), body.alias("body"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycle-state log of two regions: in the first every cycle but the newest
    is done and the second newest was later marked 'clobbered' (forced
    re-run); the second region, late, has done only up to the third newest."""
    cyc = cells(spark, sf_dir).select("model", "cycle_s").distinct()
    rk = F.dense_rank().over(Window.partitionBy("model").orderBy(F.col("cycle_s").desc()))
    ranked = (cyc.withColumn("rk", rk).withColumn("r", F.explode(F.array(F.lit(1), F.lit(2))))
              .filter(F.col("rk") > F.col("r"))
              .withColumn("region", F.when(F.col("r") == 1, F.lit(REGION)).otherwise(F.lit(REGION2))))
    done = ranked.select("region", "model", F.timestamp_seconds("cycle_s").alias("cycle"),
                         F.lit("done").alias("state"),
                         F.timestamp_seconds(F.col("cycle_s") + 86400).alias("updated_at"))
    clob = ranked.filter((F.col("rk") == 2) & (F.col("r") == 1)).select(
        "region", "model", F.timestamp_seconds("cycle_s").alias("cycle"), F.lit("clobbered").alias("state"),
        F.timestamp_seconds(F.col("cycle_s") + 90000).alias("updated_at"))
    return done.unionByName(clob)


def both_regions(df: DataFrame) -> DataFrame:
    """``df`` for the test region and again for a second one."""
    two = F.array(F.col("region"), F.when(F.col("region").isNotNull(), F.lit(REGION2)))
    return (df.select(*[c for c in df.columns if c != "region"], F.explode(two).alias("region")).select(*df.columns))


def boxes(spark: SparkSession) -> DataFrame:
    """Subset boxes of both regions: the outer columns of the grid lie outside."""
    return literal_table(spark, [(REGION, 1.2, 13.4, -1e6, 20.0), (REGION2, 0.4, 12.0, -1e6, 20.0)],
                                 "region string, left double, right double, bottom double, top double")


def region_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide thresholds of two regions that share ids: the second has twice
    the first's values, every third id has a later row as well."""
    w = thresholds_wide(spark, sf_dir)
    v = F.col(PRODUCT)
    rows = (w.select("BASIN", v, F.explode(F.array(F.lit(1), F.lit(2))).alias("r"))
            .withColumn("ordinal", F.explode(F.when(F.pmod("BASIN", F.lit(3)) == 0, F.array(F.lit(1), F.lit(2)))
                                             .otherwise(F.array(F.lit(1))))))
    return rows.select(F.when(F.col("r") == 1, F.lit(REGION)).otherwise(F.lit(REGION2)).alias("region"), "BASIN",
                       F.col("ordinal").cast("bigint").alias("ordinal"),
                       F.when(F.col("ordinal") == 2, F.lit(-999.0)).otherwise(v * F.col("r")).alias(PRODUCT))


def threshold_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide thresholds of two families: three issues of the one, in the second of
    which some catchments have no value, and one of the other."""
    w = thresholds_wide(spark, sf_dir)
    v, k = F.col(PRODUCT), F.col("BASIN")
    return w.select("BASIN", v.alias("01FFG2023123118"), F.when(F.pmod(k, F.lit(5)) != 0, v * 1.5).alias("01FFG2024011012"),
                    (v * 0.5).alias("01FFG2024012000"), (v * 2.0).alias("03FFG2024010806"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauge points (lon, lat), one per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", region_of("event_id").alias("region"),
                     (F.col("value") % F.lit(16.0) - F.lit(0.5)).alias("lon"),
                     (F.lit(10.5) - F.pmod(F.col("event_id"), F.lit(120)).cast("double") / F.lit(10.0)).alias("lat"))


def bbox(spark: SparkSession) -> DataFrame:
    """Subset box of the test region."""
    return literal_table(spark, [(REGION, 2.0, 12.0, 1.0, 8.5)],
                                 "region string, left double, right double, bottom double, top double")
