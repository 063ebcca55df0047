"""The registered queries: one per operator ID of SURVEY §2.

Each entry pairs a Spark callable ``(spark, sf_dir) -> DataFrame`` built from
the library's operators with the DuckDB SQL that computes the same table from
the raw tables.  Times leave every query as epoch milliseconds (``*_ms``) or
``yyyyMMddHH`` integers, so both engines hash identical values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions import classes as CL
from pluvio.functions.rounding import py_round1 as _pyr
from pluvio.functions.timefmt import AXIS_ORIGIN, DAY, HOUR, STAMP, epoch_ms, fmt, parse_stamp
from pluvio.operators import cycles as CY
from pluvio.operators import grid as G
from pluvio.operators import risk
from pluvio.operators import series as SE
from pluvio.operators import tiles as TL
from pluvio.operators import zonal as Z
from pluvio.plans import run_cycles as RC
from pluvio.plans import workflow as WF
from pluvio.plans.catalog import RegionSpec, models_df, region_models_df
from pluvio.session import work_path
from pluvio.sources import buckets as BK
from pluvio.sources import grids as GS
from pluvio.sources import polygons as PG
from pluvio.sources import results as src
from pluvio.sources import sinks as SK
from pluvio.sources import snapshots as SN
from pluvio.streaming import ingest as ST
from pluvio.testing import views as V
from pluvio.testing.oracle import nround1, pyround1, q, stamp

QUERIES: dict = {}
SQL: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = q(sql)
        return fn
    return deco


def ms(df: DataFrame) -> DataFrame:
    """Timestamps -> epoch ms: cycle -> cycle_ms, valid_time -> ts_ms, others <name>_ms."""
    names = {"cycle": "cycle_ms", "valid_time": "ts_ms"}
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            out.append(F.unix_millis(F.col(f.name)).alias(names.get(f.name, f.name + "_ms")))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


# --------------------------------------------------------------------------
# minimum slice: results -> A5 -> J1 -> R4
# --------------------------------------------------------------------------


def _thresholds(spark, sf_dir):
    return src.thresholds_long(V.thresholds_wide(spark, sf_dir))


@query("a5_catchment_summary", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, cum_mean, mean, max FROM scales
""")
def a5_catchment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ms(risk.catchment_summary(V.results(spark, sf_dir)))


@query("j1_threshold_lookup", f"""
SELECT r.region, k.model, k.cycle_s * 1000 AS cycle_ms, k.cat_id, {pyround1('t.threshold * r.f')} AS threshold
FROM (SELECT DISTINCT model, cycle_s, cat_id FROM results) k
JOIN thresholds t ON k.cat_id = t.cat_id, (VALUES ('{V.REGION}', 1), ('{V.REGION2}', 2)) r(region, f)
""")
def j1_threshold_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two regions share their ids, not their thresholds; of several rows the first counts."""
    keyed = V.both_regions(V.results(spark, sf_dir).select("region", "model", "cycle", "cat_id").distinct())
    return ms(risk.threshold_lookup(keyed, src.thresholds_long(V.region_thresholds(spark, sf_dir)), V.PRODUCT))


AS_OF_SQL = """
, issues AS (
  SELECT c_custkey AS cat_id, '01FFG' AS family, 1704045600::BIGINT AS issued_s, c_acctbal / 20.0::DOUBLE AS thr FROM customer UNION ALL
  SELECT c_custkey, '01FFG', 1704888000, c_acctbal / 20.0::DOUBLE * 1.5::DOUBLE FROM customer WHERE c_custkey % 5 <> 0 UNION ALL
  SELECT c_custkey, '01FFG', 1705708800, c_acctbal / 20.0::DOUBLE * 0.5::DOUBLE FROM customer UNION ALL
  SELECT c_custkey, '03FFG', 1704693600, c_acctbal / 20.0::DOUBLE * 2.0::DOUBLE FROM customer)
"""


@query("j1_threshold_as_of", AS_OF_SQL + f"""
SELECT region, model, cycle_ms, cat_id, family, max(issued_s) * 1000 AS issued_ms, {pyround1('arg_max(thr, issued_s)')} AS threshold
FROM (SELECT DISTINCT region, model, cycle_s * 1000 AS cycle_ms, cycle_s, cat_id FROM results) k JOIN issues i USING (cat_id)
WHERE i.issued_s <= k.cycle_s GROUP BY ALL
""")
def j1_threshold_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three issues of one product and one of another: each cycle takes the
    latest issue not after it."""
    keyed = V.results(spark, sf_dir).select("region", "model", "cycle", "cat_id").distinct()
    return ms(risk.threshold_as_of(keyed, src.thresholds_long(V.threshold_issues(spark, sf_dir))))


@query("r4_threshold_as_of", AS_OF_SQL + """
SELECT s.region, s.model, s.cycle_s * 1000 AS cycle_ms, s.cat_id, s.cum_mean, s.mean, s.max, t.family, t.issued_s * 1000 AS issued_ms,
       t.thr AS threshold, s.cum_mean >= t.thr AS cum_exceeds, s.mean >= t.thr AS mean_exceeds, s.max >= t.thr AS max_exceeds
FROM scales s JOIN (
  SELECT cycle_s, cat_id, family, max(issued_s) AS issued_s,
         CASE WHEN arg_max(thr, issued_s) >= 0 THEN arg_max(thr, issued_s) END AS thr
  FROM (SELECT DISTINCT cycle_s FROM results) k JOIN issues i ON i.issued_s <= k.cycle_s GROUP BY ALL) t
  ON s.cat_id = t.cat_id AND s.cycle_s = t.cycle_s
""")
def r4_threshold_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ms(risk.threshold_compare(_scales(spark, sf_dir), src.thresholds_long(V.threshold_issues(spark, sf_dir)), as_of=True))


@query("r4_threshold_compare", """
SELECT s.region, s.model, s.cycle_s * 1000 AS cycle_ms, s.cat_id, s.cum_mean, s.mean, s.max,
       t.thr AS threshold, s.cum_mean >= t.thr AS cum_exceeds, s.mean >= t.thr AS mean_exceeds,
       s.max >= t.thr AS max_exceeds
FROM clean_scales s
JOIN (SELECT cat_id, CASE WHEN threshold >= 0 THEN threshold END AS thr FROM thresholds) t
  ON s.cat_id = t.cat_id
""")
def r4_threshold_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = risk.threshold_compare(_gap_scales(spark, sf_dir), _thresholds(spark, sf_dir), V.PRODUCT)
    return ms(_no_nan(out, "cum_mean", "mean"))


# --------------------------------------------------------------------------
# shared pieces
# --------------------------------------------------------------------------


def _scales(spark, sf_dir):
    return risk.catchment_summary(V.results(spark, sf_dir))


def _gap_scales(spark, sf_dir):
    """Summaries with missing values in both forms, NaN and null."""
    def gaps(c, nan, null):
        k = F.col("cat_id")
        return F.when(F.pmod(k, F.lit(7)) == nan, F.lit(float("nan"))).when(F.pmod(k, F.lit(11)) != null, F.col(c))
    return _scales(spark, sf_dir).withColumn("cum_mean", gaps("cum_mean", 2, 5)).withColumn("mean", gaps("mean", 3, 6))


def _no_nan(df, *cols):
    """NaN to null in a query's output, where the engines print it differently."""
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in cols})


def _zonal(spark, sf_dir):
    return Z.zonal_stats(V.grid(spark, sf_dir), _weights(spark, sf_dir), catchments=_polys(spark, sf_dir), steps=V.steps(spark, sf_dir))


def _polys(spark, sf_dir):
    p = V.polygons(spark, sf_dir)
    return p.select("region", "cat_id", "props", F.col("geometry.coordinates").alias("coordinates"))


def _weights(spark, sf_dir):
    return Z.zonal_weights(PG.polygon_edges(_polys(spark, sf_dir)), V.grid_def(spark, sf_dir))


def _grid_cells(spark, sf_dir):
    return V.grid(spark, sf_dir).select("region", "model", "row", "col").distinct()


def _cls_sql(v: str, k: int) -> str:
    parts = " ".join(f"WHEN {v} >= {k} * {i} THEN {i}" for i in range(6, -1, -1))
    return f"(CASE {parts} END)"


def _colour_sql(c: str) -> str:
    arr = ", ".join(f"'{x}'" for x in CL.COLOURS)
    return f"list_extract([{arr}], {c} + 1)"


RES_COLS = "region, model, cat_id, max, mean, count, cycle_s * 1000 AS cycle_ms, vt_s * 1000 AS ts_ms, step_h"
GRID_COLS = ("region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, var, level, "
             '"row", col, value')
THR_VALID = "(SELECT cat_id, CASE WHEN threshold >= 0 THEN threshold END AS thr FROM thresholds)"


# --------------------------------------------------------------------------
# S: sources
# --------------------------------------------------------------------------
@query("s1_results_scan", f"""
SELECT region, model, cat_id, mean, max, {stamp('vt_s')} AS "Timestep" FROM results
""")
def s1_results_scan(spark, sf_dir):
    path = work_path(spark, "s1-results-csv")
    SK.write_table(src.to_reference_form(V.results(spark, sf_dir)), path,
                   partition_by=["region", "model"], fmt="csv")
    df = src.read_results(spark, path, "csv", columns=["region", "model", "cat_id", "mean", "max", "Timestep"])
    return src.type_reference_columns(df)


@query("s2_threshold_unpivot", "SELECT cat_id, product, threshold FROM thresholds")
def s2_threshold_unpivot(spark, sf_dir):
    return _thresholds(spark, sf_dir)


@query("s3_scale_scan", "SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, cum_mean, mean, max FROM scales")
def s3_scale_scan(spark, sf_dir):
    path = work_path(spark, "s3-scales-csv")
    ref = _scales(spark, sf_dir).withColumn("cat_id", F.col("cat_id").cast("double"))   # prints 11111.0
    SK.write_table(ref, path, fmt="csv")
    return ms(src.read_scales(spark, path, "csv"))


@query("s4_tile_explode", """
SELECT t.region, t.model, t.cycle_s * 1000 AS cycle_ms, t.step_h, t.vt_s * 1000 AS ts_ms, t.var, t.level, t."row", t.col, g.value
FROM (SELECT DISTINCT region, model, cycle_s, step_h, vt_s, var, level,
             CAST("row" - "row" % 8 + a.range AS INTEGER) AS "row", CAST(col - col % 8 + b.range AS INTEGER) AS col
      FROM grid, range(0, 8) a, range(0, 8) b) t
LEFT JOIN grid g USING (region, model, cycle_s, step_h, vt_s, var, level, "row", col)
""")
def s4_tile_explode(spark, sf_dir):
    tiles = GS.make_tiles(V.grid(spark, sf_dir), size=8)
    return ms(GS.explode_tiles(tiles))


@query("s5_geojson_edges", "SELECT region, cat_id, part, ring, seq, x1, y1, x2, y2 FROM cedges")
def s5_geojson_edges(spark, sf_dir):
    path = work_path(spark, "s5-geojson")
    c = V.catchments(spark, sf_dir)
    feats = c.withColumn("geometry", F.struct(F.lit("MultiPolygon").alias("type"),
                                              F.col("coordinates").alias("coordinates")))
    PG.to_feature_lines(feats).write.text(path)
    polys = PG.read_geojson(spark, path, region=V.REGION)
    return PG.polygon_edges(polys)


@query("s6_file_listing", "SELECT DISTINCT region, model, cycle_s * 1000 AS cycle_ms FROM grid")
def s6_file_listing(spark, sf_dir):
    path = work_path(spark, "s6-grid")
    SK.write_table(V.grid(spark, sf_dir), path)
    files = GS.list_files(spark, path, "*.parquet")
    parts = files.select(GS.partition_value(F.col("path"), "region").alias("region"),
                         GS.partition_value(F.col("path"), "model").alias("model"),
                         parse_stamp(GS.partition_value(F.col("path"), "cycle")).alias("cycle"))
    return ms(parts.distinct())


# --------------------------------------------------------------------------
# K: sinks
# --------------------------------------------------------------------------
@query("k1_results_sink", f"SELECT {RES_COLS} FROM results")
def k1_results_sink(spark, sf_dir):
    path = work_path(spark, "k1-results")
    SK.write_table(V.results(spark, sf_dir), path)
    return ms(SK.read_table(spark, path))


@query("k2_scale_sink", "SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, cum_mean, mean, max FROM scales")
def k2_scale_sink(spark, sf_dir):
    path = work_path(spark, "k2-scales")
    SK.write_table(_scales(spark, sf_dir), path)
    return ms(SK.read_table(spark, path))


CHARTS_SQL = f"""
s1 AS (
  SELECT r.region, r.model, r.cycle_s, r.cat_id, r.vt_s, {pyround1('r.mean')} AS value,
         {pyround1('t.threshold')} AS threshold
  FROM results r JOIN thresholds t ON r.cat_id = t.cat_id),
r1 AS (
  SELECT *, greatest(arg_max_null(value, vt_s) OVER (PARTITION BY region, model, cycle_s, cat_id), threshold)
            AS chart_max
  FROM s1),
s2 AS (
  SELECT r.region, r.model, r.cycle_s, r.cat_id, r.vt_s, r.cum AS value, {pyround1('t.threshold')} AS threshold
  FROM running r JOIN thresholds t ON r.cat_id = t.cat_id),
r2 AS (
  SELECT *, greatest(arg_max_null(value, vt_s) OVER (PARTITION BY region, model, cycle_s, cat_id), threshold)
            AS chart_max
  FROM s2),
charts AS (
  SELECT *, 'intervals' AS chart_type FROM r1 UNION ALL SELECT *, 'cumulative' AS chart_type FROM r2)
"""


@query("k3_chart_json", f"""
, {CHARTS_SQL.strip()}
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, chart_type,
       '{{"values": [' || string_agg('[' || CAST(vt_s * 1000 AS VARCHAR) || ', ' || coalesce(CAST(value AS VARCHAR), 'null') || ']',
                                    ', ' ORDER BY vt_s)
       || '], "threshold": ' || coalesce(CAST(max(threshold) AS VARCHAR), 'null')
       || ', "max": ' || coalesce(CAST(max(chart_max) AS VARCHAR), 'null') || '}}' AS json
FROM charts GROUP BY region, model, cycle_s, cat_id, chart_type
""")
def k3_chart_json(spark, sf_dir):
    series = SE.chart_types(V.results(spark, sf_dir), _thresholds(spark, sf_dir), V.PRODUCT)
    return ms(SE.chart_json(series))


@query("k4_scale_json", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, CAST(cat_id AS VARCHAR) || '.0' AS key,
       '{"cum_mean": ' || coalesce(CAST(cum_mean AS VARCHAR), 'null') || ', "mean": '
       || coalesce(CAST(mean AS VARCHAR), 'null') || ', "max": ' || coalesce(CAST(max AS VARCHAR), 'null') || '}' AS json
FROM scales
""")
def k4_scale_json(spark, sf_dir):
    return ms(SE.scale_json(_scales(spark, sf_dir)))


@query("k5_grid_sink", f"SELECT {GRID_COLS} FROM grid")
def k5_grid_sink(spark, sf_dir):
    path = work_path(spark, "k5-grid")
    SK.write_grid(V.grid(spark, sf_dir), path)
    return ms(SK.read_table(spark, path))


@query("k7_retention", f"""
SELECT {RES_COLS} FROM results r
WHERE cycle_s = (SELECT max(cycle_s) FROM results x WHERE x.region = r.region AND x.model = r.model)
""")
def k7_retention(spark, sf_dir):
    src_path, dst = work_path(spark, "k7-all"), work_path(spark, "k7-kept")
    SK.write_table(V.results(spark, sf_dir), src_path)
    SK.apply_retention(spark, src_path, dst)
    return ms(SK.read_table(spark, dst))


# --------------------------------------------------------------------------
# F: projections, filters
# --------------------------------------------------------------------------
@query("f1_point_filter", f"""
SELECT {RES_COLS} FROM results r
WHERE EXISTS (SELECT 1 FROM requests q WHERE q.req_model = r.model AND q.req_cat = r.cat_id)
""")
def f1_point_filter(spark, sf_dir):
    req = SE.decode_requests(V.requests(spark, sf_dir))
    return ms(SE.point_filter(V.results(spark, sf_dir), requests=req))


@query("c10_request_decode", f"""
SELECT request_id, '{V.REGION}' AS region, req_model AS model, req_cat AS cat_id FROM requests
""")
def c10_request_decode(spark, sf_dir):
    return SE.decode_requests(V.requests(spark, sf_dir))


@query("f2_bbox_subset", f"""
SELECT * FROM (
  SELECT {GRID_COLS}, 0.0::DOUBLE + (col + 0.5::DOUBLE) * 1.0::DOUBLE AS lon,
         10.0::DOUBLE - ("row" + 0.5::DOUBLE) * 1.0::DOUBLE AS lat FROM grid)
WHERE lon BETWEEN 2.0 AND 12.0 AND lat BETWEEN 1.0 AND 8.5
""")
def f2_bbox_subset(spark, sf_dir):
    g = G.cell_geometry(V.grid(spark, sf_dir), V.grid_def(spark, sf_dir))
    return ms(G.bbox_subset_by_region(g, V.bbox(spark)))


@query("f3_variable_subset", f"""
SELECT '{V.REGION}' AS region, 'gfs' AS model, vt_s * 1000 AS ts_ms, var, level, "row", col,
       CAST(sum(cents) AS DOUBLE) / 100.0::DOUBLE AS value
FROM (SELECT (us // 21600000000 + 1) * 21600 AS vt_s, upper(event_type) AS var,
             CASE WHEN event_type IN ('click', 'view') THEN 'surface' ELSE 'heightAboveGround' END AS level,
             CAST(user_id // 15 AS INTEGER) AS "row", CAST(user_id % 15 AS INTEGER) AS col, cents FROM ev)
WHERE var = 'CLICK' AND level = 'surface'
GROUP BY ALL
""")
def f3_variable_subset(spark, sf_dir):
    return ms(G.variable_subset(V.grid_vars(spark, sf_dir), "CLICK", "surface"))


@query("f4_normalise", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, "row", col,
       10.0::DOUBLE - ("row" + 0.5::DOUBLE) * 1.0::DOUBLE AS lat,
       0.0::DOUBLE + (col + 0.5::DOUBLE) * 1.0::DOUBLE AS lon,
       vt_s * 1000 AS time_ms, CAST(value AS FLOAT) AS tp
FROM grid
""")
def f4_normalise(spark, sf_dir):
    g = G.cell_geometry(V.grid(spark, sf_dir), V.grid_def(spark, sf_dir))
    decoded = g.select("region", "model", "cycle", "row", "col", "valid_time",
                       F.col("step_h").alias("step"), F.lit(0).alias("surface"),
                       F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
                       F.col("value").alias("tp"))
    return ms(G.normalise(decoded))


@query("f5_result_type", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, 'cum_mean' AS result_type, cum_mean AS value FROM scales
UNION ALL
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, 'mean' AS result_type, mean AS value FROM scales
""")
def f5_result_type(spark, sf_dir):
    return ms(risk.result_type_long(_scales(spark, sf_dir)))


@query("f6_metadata", f"""
SELECT region, model, cat_id, max, mean, count, {stamp('cycle_s')} AS "Forecast Timestamp",
       {stamp('vt_s')} AS "Timestep" FROM results
""")
def f6_metadata(spark, sf_dir):
    return src.to_reference_form(V.results(spark, sf_dir))


A4_SQL = f"""
SELECT region, model, cycle_s, step_h, vt_s, cat_id, count, {nround1('max')} AS max, {nround1('mean')} AS mean
FROM zstats
"""


@query("f7_properties", f"""
SELECT s.region, s.model, p.name AS "NAME", s.cat_id, s.max, s.mean, s.count,
       {stamp('s.cycle_s')} AS "Forecast Timestamp", {stamp('s.vt_s')} AS "Timestep"
FROM ({A4_SQL}) s JOIN polygons p ON p.cat_id = s.cat_id
""")
def f7_properties(spark, sf_dir):
    stats = Z.round_stats(_zonal(spark, sf_dir))
    props = PG.properties(_polys(spark, sf_dir), ["NAME"])
    return src.to_reference_form(stats.join(props, ["region", "cat_id"], "inner"), props=["NAME"])


@query("f8_complete_cycles", "SELECT region, model, cycle_s * 1000 AS cycle_ms, n_steps_seen FROM complete")
def f8_complete_cycles(spark, sf_dir):
    return ms(G.complete_cycles(V.grid(spark, sf_dir), models_df(spark)))


@query("f8_manifest_gate", f"SELECT {GRID_COLS} FROM grid SEMI JOIN complete USING (region, model, cycle_s)")
def f8_manifest_gate(spark, sf_dir):
    """A stored grid gated by its step manifest, exact steps only."""
    path, manifest = work_path(spark, "f8-grid"), work_path(spark, "f8-steps")
    SK.write_grid(V.grid(spark, sf_dir), path, manifest=manifest)
    return ms(G.only_complete(SK.read_table(spark, path), models_df(spark), SK.read_table(spark, manifest), exact=True))


# --------------------------------------------------------------------------
# G: grids
# --------------------------------------------------------------------------
@query("g1_deaccumulate", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, 'APCP' AS var, 'surface' AS level,
       "row", col, value
FROM deacc WHERE model = 'wrfpr'
UNION ALL
SELECT region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, 'TMP' AS var, 'heightAboveGround' AS level,
       "row", col, CASE WHEN row_number() OVER (PARTITION BY cycle_s, "row", col ORDER BY vt_s) = 1
                        THEN 99999.0::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM raw_grid WHERE model = 'wrfpr'
""")
def g1_deaccumulate(spark, sf_dir):
    """Two variables in each cell; cells without data at some steps."""
    return ms(G.deaccumulate(V.raw_grid_vars(spark, sf_dir).filter(F.col("model") == "wrfpr")))


@query("g2_passthrough", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, "row", col, value FROM deacc
""")
def g2_passthrough(spark, sf_dir):
    return ms(G.by_accumulation(G.variable_subset(V.raw_grid_vars(spark, sf_dir)).drop("var", "level")))


@query("g3_cell_geometry", """
SELECT DISTINCT region, model, "row", col, 0.0::DOUBLE + (col + 0.5::DOUBLE) * 1.0::DOUBLE AS lon,
       10.0::DOUBLE - ("row" + 0.5::DOUBLE) * 1.0::DOUBLE AS lat FROM grid
""")
def g3_cell_geometry(spark, sf_dir):
    return G.cell_geometry(_grid_cells(spark, sf_dir), V.grid_def(spark, sf_dir))


@query("g4_point_to_cell", """
SELECT p.event_id, p.region, g.model, p.lon, p.lat,
       CASE WHEN floor((p.lon - g.x0) / g.dx) BETWEEN 0 AND g.n_cols - 1
             AND floor((g.y_top - p.lat) / g.dy) BETWEEN 0 AND g.n_rows - 1
            THEN CAST(floor((g.y_top - p.lat) / g.dy) AS INTEGER) END AS "row",
       CASE WHEN floor((p.lon - g.x0) / g.dx) BETWEEN 0 AND g.n_cols - 1
             AND floor((g.y_top - p.lat) / g.dy) BETWEEN 0 AND g.n_rows - 1
            THEN CAST(floor((p.lon - g.x0) / g.dx) AS INTEGER) END AS col
FROM points p JOIN grid_def g ON p.region = g.region
""")
def g4_point_to_cell(spark, sf_dir):
    return G.point_to_cell(V.points(spark, sf_dir), V.grid_def(spark, sf_dir))


@query("g5_refine_nearest", """
SELECT c.region, c.model, c."row", c.col, c."row" * 10 + a.fr AS fine_row, c.col * 10 + b.fc AS fine_col,
       0.0::DOUBLE + ((c.col * 10 + b.fc) + 0.5::DOUBLE) * (1.0::DOUBLE / 10) AS fine_lon,
       10.0::DOUBLE - ((c."row" * 10 + a.fr) + 0.5::DOUBLE) * (1.0::DOUBLE / 10) AS fine_lat
FROM (SELECT DISTINCT region, model, "row", col FROM grid) c,
     (SELECT CAST(range AS INTEGER) AS fr FROM range(0, 10)) a,
     (SELECT CAST(range AS INTEGER) AS fc FROM range(0, 10)) b
""")
def g5_refine_nearest(spark, sf_dir):
    return G.refine_nearest(_grid_cells(spark, sf_dir), V.grid_def(spark, sf_dir))


@query("g6_time_axis", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, vt_s * 1000 AS ts_ms,
       CAST(step_index AS INTEGER) AS step_index,
       CAST(CASE model WHEN 'gfs' THEN 6 + (step_index - 1) * 6 ELSE 1 + (step_index - 1) * 1 END AS INTEGER) AS hours
FROM (SELECT *, dense_rank() OVER (PARTITION BY region, model, cycle_s ORDER BY vt_s) AS step_index
      FROM (SELECT DISTINCT region, model, cycle_s, vt_s FROM grid))
""")
def g6_time_axis(spark, sf_dir):
    return ms(G.time_axis(V.grid(spark, sf_dir), models_df(spark)))


# --------------------------------------------------------------------------
# Z, A: zonal statistics and aggregations
# --------------------------------------------------------------------------
@query("z1_zonal_weights", "SELECT region, model, cat_id, \"row\", col, w FROM cweights")
def z1_zonal_weights(spark, sf_dir):
    """Weights of one catchment per customer (the set grows with the data)."""
    return Z.zonal_weights(PG.polygon_edges(V.catchments(spark, sf_dir)), V.grid_def(spark, sf_dir))


@query("z2_zonal_stats", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, cat_id, count, max,
       CAST(round(mean * 1e9::DOUBLE) AS BIGINT) AS mean_e9
FROM zstats
""")
def z2_zonal_stats(spark, sf_dir):
    """The mean leaves in billionths: the oracle averages plain doubles."""
    s = _zonal(spark, sf_dir)
    return ms(s.withColumn("mean_e9", F.round(F.col("mean") * 1e9).cast("bigint")).drop("mean"))


@query("a4_round_stats", f"""
SELECT region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, cat_id, count, max, mean
FROM ({A4_SQL})
""")
def a4_round_stats(spark, sf_dir):
    return ms(Z.round_stats(_zonal(spark, sf_dir)))


STATS_E7 = """
SELECT region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, cat_id, count, max,
       CAST(round(mean * 1e7::DOUBLE) AS BIGINT) AS mean_e7
"""


def _e7(stats):
    """The mean in ten-millionths (values such as 500 / 1000003 lie next to a tie in billionths)."""
    return ms(stats.withColumn("mean_e7", F.round(F.col("mean") * 1e7).cast("bigint")).drop("mean"))


@query("z1_zonal_ranges", "SELECT region, model, cat_id, \"row\", col, w FROM wweights")
def z1_zonal_ranges(spark, sf_dir):
    """Wide catchments as runs of cells of one weight, taken apart into cells."""
    r = Z.zonal_ranges(PG.polygon_edges(V.basins(spark, sf_dir)), V.grid_def(spark, sf_dir))
    return (r.select("region", "model", "cat_id", "row", F.explode(F.sequence("c0", "c1")).alias("col"), "w")
            .groupBy("region", "model", "cat_id", "row", "col").agg(F.sum("w").alias("w")))


@query("z2_range_stats", STATS_E7 + "FROM bstats")
def z2_range_stats(spark, sf_dir):
    """Counts, maxima and means of wide catchments from running sums and range maxima."""
    basins, gd = V.basins(spark, sf_dir), V.grid_def(spark, sf_dir)
    return _e7(Z.zonal_stats_by_ranges(V.grid(spark, sf_dir), Z.zonal_ranges(PG.polygon_edges(basins), gd), gd,
                                       catchments=basins, steps=V.steps(spark, sf_dir)))


@query("z2_customer_stats", STATS_E7 + "FROM cstats")
def z2_customer_stats(spark, sf_dir):
    """The larger catchment set: one per customer, with overlapping parts."""
    cats = V.catchments(spark, sf_dir)
    weights = Z.zonal_weights(PG.polygon_edges(cats), V.grid_def(spark, sf_dir))
    return _e7(Z.zonal_stats(V.grid(spark, sf_dir), weights, catchments=cats, steps=V.steps(spark, sf_dir), at_home=True))


@query("a4_tied_means", f"""
SELECT region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, cat_id, count,
       {nround1('max')} AS max, {nround1('mean')} AS mean
FROM tied_stats
""")
def a4_tied_means(spark, sf_dir):
    """Rounded statistics of a de-accumulated grid whose means often lie on a
    rounding tie; the oracle averages decimals."""
    grid = G.by_accumulation(V.tied_raw_grid(spark, sf_dir))
    return ms(Z.round_stats(Z.zonal_stats(grid, _weights(spark, sf_dir), catchments=_polys(spark, sf_dir), steps=V.steps(spark, sf_dir))))


@query("s4_tile_stats", STATS_E7 + """
FROM (
  SELECT f.region, f.model, f.cycle_s, f.step_h, f.vt_s, f.cat_id, CAST(coalesce(z.n, 0) AS BIGINT) AS count, z.max, z.mean
  FROM zframe f LEFT JOIN (
    SELECT g.region, g.model, g.cycle_s, g.step_h, g.vt_s, w.cat_id, sum(w.w) AS n, max(g.value) AS max,
           fsum(w.w * g.value) / sum(w.w) AS mean
    FROM tile_deacc g JOIN bweights w ON g.region = w.region AND g.model = w.model AND g."row" = w."row" AND g.col = w.col
    WHERE g.value IS NOT NULL GROUP BY ALL) z USING (region, model, cycle_s, step_h, vt_s, cat_id))
""")
def s4_tile_stats(spark, sf_dir):
    """Delivered grids as 4 x 4 tiles, de-accumulated and weighed as arrays."""
    tiles = TL.tiles_by_accumulation(GS.make_tiles(V.raw_grid(spark, sf_dir).drop("var", "level"), size=4))
    return _e7(TL.zonal_stats_of_tiles(tiles, TL.tile_weights(_weights(spark, sf_dir), 4), catchments=_polys(spark, sf_dir),
                                       steps=V.steps(spark, sf_dir)))


@query("a6_distinct_catchments", "SELECT DISTINCT region, model, cat_id FROM results")
def a6_distinct_catchments(spark, sf_dir):
    return risk.distinct_catchments(V.results(spark, sf_dir))


@query("a7_chart_max", f"""
, {CHARTS_SQL.strip()}
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, greatest(arg_max_null(value, vt_s), max(threshold)) AS chart_max
FROM s1 GROUP BY ALL
""")
def a7_chart_max(spark, sf_dir):
    r = V.results(spark, sf_dir)
    s = risk.threshold_lookup(r.select("region", "model", "cycle", "cat_id", "valid_time",
                                       _pyr("mean").alias("value")), _thresholds(spark, sf_dir), V.PRODUCT)
    return ms(SE.chart_max_agg(s))


# --------------------------------------------------------------------------
# J: joins
# --------------------------------------------------------------------------
@query("j2_colour_lookup", f"""
SELECT p.region, p.cat_id, s.model, s.cycle_s * 1000 AS cycle_ms, s.cum_mean AS value,
       {_cls_sql(_cls_sql('s.cum_mean', 5) + ' * 5', 5)} AS class,
       {_colour_sql(_cls_sql(_cls_sql('s.cum_mean', 5) + ' * 5', 5))} AS colour
FROM polygons p LEFT JOIN clean_scales s ON p.region = s.region AND p.cat_id = s.cat_id
""")
def j2_colour_lookup(spark, sf_dir):
    out = risk.colour_lookup(V.polygons(spark, sf_dir), _gap_scales(spark, sf_dir), "cum_mean", 5)
    return ms(_no_nan(out, "value"))


@query("j3_pending_cycles", """
SELECT w.region, w.model, w.cycle_s * 1000 AS cycle_ms, coalesce(st.state, 'new') AS reason
FROM (SELECT DISTINCT r.region, model, cycle_s FROM grid, (SELECT DISTINCT region FROM runs) r) w
LEFT JOIN (SELECT region, model, cycle_s, arg_max(state, updated_s) AS state FROM runs GROUP BY ALL) st
  ON w.region = st.region AND w.model = st.model AND w.cycle_s = st.cycle_s
WHERE st.state IS NULL OR st.state <> 'done'
""")
def j3_pending_cycles(spark, sf_dir):
    wanted = V.both_regions(V.grid(spark, sf_dir).select("region", "model", "cycle").distinct())
    return ms(CY.pending_cycles(wanted, V.runs(spark, sf_dir)))


#: Second-region cycles from here on lack their later steps in the first run of k6.
LATE_FROM = "2024011500"


@query("k6_run_state", f"""
SELECT region, model, cycle_s * 1000 AS cycle_ms, 'done' AS state,
       CAST(CASE WHEN region = '{V.REGION}' AND cycle_s = min(cycle_s) OVER (PARTITION BY region, model) THEN 2 ELSE 1 END
            AS BIGINT) AS n_done,
       region = '{V.REGION}' OR strftime(make_timestamp(cycle_s * 1000000), '%Y%m%d%H') < '{LATE_FROM}' AS in_first
FROM complete_mr
""")
def k6_run_state(spark, sf_dir):
    """Two scheduled runs over stored grids: at the first the second region's
    newer cycles are late; before the second the oldest cycle of each model is
    marked clobbered in the first region.  Every complete cycle ends up done,
    recorded by the run that wrote it and by no other."""
    grid_path, out = work_path(spark, "k6-grid"), work_path(spark, "k6-out")
    SK.write_grid(V.both_regions(V.raw_grid_vars(spark, sf_dir)), grid_path)
    raw = SK.read_table(spark, grid_path)
    late = (F.col("region") == V.REGION2) & (F.col("cycle") >= parse_stamp(F.lit(LATE_FROM))) & (F.col("step_h") > 20)
    polys, gd, options = _two_regions(spark, sf_dir)
    RC.run_cycles(spark, raw.filter(~late), polys, gd, out, **options)
    first = CY.run_state(RC.read_runs(spark, f"{out}/runs")).select("region", "model", "cycle")
    first_path = work_path(spark, "k6-first")
    first.write.parquet(first_path)
    first = spark.read.parquet(first_path)
    oldest = (first.filter(F.col("region") == V.REGION).groupBy("region", "model").agg(F.min("cycle").alias("cycle")))
    CY.record_runs(spark, oldest, f"{out}/runs", "clobbered")
    RC.run_cycles(spark, raw, polys, gd, out, **options)
    runs = RC.read_runs(spark, f"{out}/runs")
    n = runs.filter("state = 'done'").groupBy("region", "model", "cycle").agg(F.count(F.lit(1)).alias("n_done"))
    keys = ["region", "model", "cycle"]
    return ms(CY.run_state(runs).join(n, keys).join(first.withColumn("seen", F.lit(True)), keys, "left")
              .select(*keys, "state", "n_done", F.coalesce("seen", F.lit(False)).alias("in_first")))


@query("s9_region_models", f"""
SELECT region, model, cycle_s * 1000 AS cycle_ms, count(*) AS n_cells
FROM (SELECT region, model, cycle_s FROM grid UNION ALL
      SELECT '{V.REGION2}' AS region, model, cycle_s FROM grid WHERE model = 'gfs') GROUP BY ALL
""")
def s9_region_models(spark, sf_dir):
    """The catalog runs one of the models in the first region only."""
    regions = {V.REGION: RegionSpec(V.REGION, "1", 0.0, 15.0, -1e6, 20.0, ("gfs", "wrfpr")),
               V.REGION2: RegionSpec(V.REGION2, "2", 0.0, 15.0, -1e6, 20.0, ("gfs",))}
    grid = WF.configured(V.both_regions(V.grid(spark, sf_dir)), region_models_df(spark, regions))
    return ms(grid.groupBy("region", "model", "cycle").agg(F.count(F.lit(1)).alias("n_cells")))


# --------------------------------------------------------------------------
# W, O, U: windows, order, set operations
# --------------------------------------------------------------------------
@query("w1_running_total", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, vt_s * 1000 AS ts_ms, cum FROM running
""")
def w1_running_total(spark, sf_dir):
    r = V.results(spark, sf_dir).select("region", "model", "cycle", "cat_id", "valid_time", "mean")
    return ms(SE.running_total(r).drop("mean"))


@query("o1_time_order", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, vt_s * 1000 AS ts_ms,
       CAST(row_number() OVER (PARTITION BY region, model, cycle_s, cat_id ORDER BY vt_s) AS INTEGER) AS pos
FROM results
""")
def o1_time_order(spark, sf_dir):
    r = V.results(spark, sf_dir).select("region", "model", "cycle", "cat_id", "valid_time")
    return ms(SE.time_order(r))


@query("u1_append_steps", f"""
SELECT s.region, s.model, s.cycle_s * 1000 AS cycle_ms, s.vt_s * 1000 AS ts_ms, s.cat_id, s.count, s.max, s.mean,
       CASE WHEN s.model = 'gfs' THEN p.name END AS "NAME"
FROM ({A4_SQL}) s JOIN polygons p ON p.cat_id = s.cat_id
""")
def u1_append_steps(spark, sf_dir):
    stats = Z.round_stats(_zonal(spark, sf_dir)).drop("step_h")
    props = PG.properties(_polys(spark, sf_dir), ["NAME"])
    gfs = stats.filter(F.col("model") == "gfs").join(props, ["region", "cat_id"], "inner")
    wrf = stats.filter(F.col("model") == "wrfpr")
    return ms(gfs.unionByName(wrf, allowMissingColumns=True))


@query("u2_listing_difference", """
SELECT DISTINCT region, model, cycle_s * 1000 AS cycle_ms FROM results r
WHERE cycle_s < (SELECT max(cycle_s) FROM results x WHERE x.region = r.region AND x.model = r.model)
""")
def u2_listing_difference(spark, sf_dir):
    return ms(SK.superseded(V.results(spark, sf_dir)))


# --------------------------------------------------------------------------
# C: time, string, math scalars
# --------------------------------------------------------------------------
@query("c1_step_expansion", """
SELECT c.model, c.cycle_s * 1000 AS cycle_ms, CAST(s.step_h AS INTEGER) AS step_h,
       (c.cycle_s + s.step_h * 3600) * 1000 AS ts_ms
FROM (SELECT DISTINCT model, cycle_s FROM grid) c,
     (SELECT 'gfs' AS model, unnest(range(6, 169, 6)) AS step_h
      UNION ALL SELECT 'wrfpr' AS model, unnest(range(1, 49)) AS step_h) s
WHERE c.model = s.model
""")
def c1_step_expansion(spark, sf_dir):
    cyc = V.grid(spark, sf_dir).select("model", "cycle").distinct()
    return ms(CY.step_expansion(cyc, models_df(spark)))


def _c2_sql(model, rules):
    whens = " ".join(f"WHEN hour(ts) > {h + 3} THEN date_trunc('day', ts) + INTERVAL {h} HOUR" for h in rules)
    last = max(rules)
    return (f"SELECT event_id, '{model}' AS model, epoch_ms(CASE {whens} "
            f"ELSE date_trunc('day', ts) - INTERVAL 1 DAY + INTERVAL {last} HOUR END) AS cycle_ms FROM events")


@query("c2_latest_cycle", _c2_sql("gfs", [18, 12, 6, 0]) + " UNION ALL " + _c2_sql("wrfpr", [18, 6]))
def c2_latest_cycle(spark, sf_dir):
    t = V.table(spark, sf_dir, "events").select("event_id", F.timestamp_micros(V.micros("ts")).alias("ts"))
    return ms(CY.latest_cycle(t).drop("ts"))


@query("c3_missing_steps", """
SELECT c.model, c.cycle_s * 1000 AS cycle_ms, CAST(s.step_h AS INTEGER) AS step_h,
       (c.cycle_s + s.step_h * 3600) * 1000 AS ts_ms
FROM (SELECT DISTINCT model, cycle_s FROM grid) c
JOIN (SELECT 'gfs' AS model, unnest(range(6, 169, 6)) AS step_h
      UNION ALL SELECT 'wrfpr' AS model, unnest(range(1, 49)) AS step_h) s ON c.model = s.model
WHERE NOT EXISTS (SELECT 1 FROM grid g WHERE g.model = c.model AND g.cycle_s = c.cycle_s AND g.step_h = s.step_h)
""")
def c3_missing_steps(spark, sf_dir):
    g = V.grid(spark, sf_dir)
    expected = CY.step_expansion(g.select("model", "cycle").distinct(), models_df(spark))
    return ms(CY.missing_steps(expected, g.select("model", "cycle", "step_h")))


@query("c4_parse_time", f"""
SELECT region, model, cat_id, {stamp('vt_s')} AS "Timestep",
       strftime(make_timestamp(vt_s * 1000000), '%Y-%m-%d %H:%M:%S') AS parsed
FROM results
""")
def c4_parse_time(spark, sf_dir):
    ref = src.to_reference_form(V.results(spark, sf_dir)).select("region", "model", "cat_id", "Timestep")
    return ref.withColumn("parsed", F.date_format(parse_stamp("Timestep"), "yyyy-MM-dd HH:mm:ss"))


@query("c5_format_time", """
SELECT DISTINCT model, cycle_s * 1000 AS cycle_ms,
       strftime(make_timestamp(cycle_s * 1000000), '%Y%m%d%H') AS stamp,
       strftime(make_timestamp(cycle_s * 1000000), '%Y-%m-%d %H:00:00') AS axis_origin,
       strftime(make_timestamp(cycle_s * 1000000), '%H') AS hour,
       strftime(make_timestamp(cycle_s * 1000000), '%Y%m%d') AS day
FROM results
""")
def c5_format_time(spark, sf_dir):
    c = V.results(spark, sf_dir).select("model", "cycle").distinct()
    return ms(c.select("model", "cycle", fmt("cycle", STAMP).alias("stamp"),
                       fmt("cycle", AXIS_ORIGIN).alias("axis_origin"), fmt("cycle", HOUR).alias("hour"),
                       fmt("cycle", DAY).alias("day")))


@query("c6_epoch_ms", f"""
SELECT region, model, cat_id, {stamp('vt_s')} AS "Timestep", vt_s * 1000 AS epoch_ms FROM results
""")
def c6_epoch_ms(spark, sf_dir):
    ref = src.to_reference_form(V.results(spark, sf_dir))
    return ref.select("region", "model", "cat_id", "Timestep",
                      epoch_ms(parse_stamp("Timestep")).alias("epoch_ms"))


@query("c7_cycle_label", """
SELECT m.model, CASE WHEN d.cycle_s IS NULL THEN 'No ' || m.display || ' Timestamp Detected'
                     ELSE m.display || ' data from ' || strftime(make_timestamp(d.cycle_s * 1000000), '%b %d, %I%p UTC')
                END AS label
FROM (VALUES ('gfs', 'GFS'), ('wrfpr', 'WRF-PR')) m(model, display)
LEFT JOIN (SELECT model, max(cycle_s) AS cycle_s FROM
             (SELECT region, model, cycle_s, arg_max(state, updated_s) AS state FROM runs GROUP BY ALL)
           WHERE state = 'done' GROUP BY model) d ON m.model = d.model
""")
def c7_cycle_label(spark, sf_dir):
    return CY.cycle_labels(models_df(spark), V.runs(spark, sf_dir))


@query("c8_time_from_name", """
SELECT DISTINCT model, strftime(make_timestamp(vt_s * 1000000), '%Y%m%d%H') || '.grb' AS name,
       strftime(make_timestamp(vt_s * 1000000), '%Y%m%d%H') || '.tif' AS tif_name, vt_s * 1000 AS ts_ms
FROM grid
""")
def c8_time_from_name(spark, sf_dir):
    names = V.grid(spark, sf_dir).select("model", GS.step_file_name(F.col("valid_time")).alias("name")).distinct()
    return names.select("model", "name", GS.replace_suffix(F.col("name"), ".grb", ".tif").alias("tif_name"),
                        epoch_ms(GS.time_from_name(F.col("name"))).alias("ts_ms"))


@query("c9_round_one", f"""
SELECT cat_id, threshold AS threshold_raw, {pyround1('threshold')} AS threshold FROM thresholds
""")
def c9_round_one(spark, sf_dir):
    t = _thresholds(spark, sf_dir)
    return t.select("cat_id", F.col("threshold").alias("threshold_raw"), _pyr("threshold").alias("threshold"))


# --------------------------------------------------------------------------
# R: series, risk, classes
# --------------------------------------------------------------------------
@query("r1_interval_series", f"""
, {CHARTS_SQL.strip()}
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, vt_s * 1000 AS ts_ms, value, threshold, chart_max FROM r1
""")
def r1_interval_series(spark, sf_dir):
    s = SE.interval_series(V.results(spark, sf_dir), _thresholds(spark, sf_dir), V.PRODUCT)
    return ms(s.drop("ts_ms"))


@query("r2_cumulative_series", f"""
, {CHARTS_SQL.strip()}
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, vt_s * 1000 AS ts_ms, value, threshold, chart_max FROM r2
""")
def r2_cumulative_series(spark, sf_dir):
    s = SE.cumulative_series(V.results(spark, sf_dir), _thresholds(spark, sf_dir), V.PRODUCT)
    return ms(s.drop("ts_ms"))


@query("r3_chart_types", f"""
, {CHARTS_SQL.strip()}
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, vt_s * 1000 AS ts_ms, value, threshold, chart_max,
       chart_type FROM charts
""")
def r3_chart_types(spark, sf_dir):
    s = SE.chart_types(V.results(spark, sf_dir), _thresholds(spark, sf_dir), V.PRODUCT)
    return ms(s.drop("ts_ms"))


@query("r5_time_to_threshold", f"""
SELECT r.region, r.model, r.cycle_s * 1000 AS cycle_ms, r.cat_id, t.thr AS threshold,
       min(CASE WHEN r.cum >= t.thr THEN r.vt_s END) * 1000 AS reached_at_ms,
       CAST((min(CASE WHEN r.cum >= t.thr THEN r.vt_s END) - r.cycle_s) // 3600 AS INTEGER) AS lead_h
FROM running r JOIN {THR_VALID} t ON r.cat_id = t.cat_id
GROUP BY r.region, r.model, r.cycle_s, r.cat_id, t.thr
""")
def r5_time_to_threshold(spark, sf_dir):
    run = SE.running_total(V.results(spark, sf_dir))
    return ms(risk.time_to_threshold(run, _thresholds(spark, sf_dir), V.PRODUCT))


def _rt_sql(cls_fn):
    return f"""
SELECT region, model, cycle_ms, cat_id, result_type, value, {cls_fn('value')} AS class,
       {_colour_sql(cls_fn('value'))} AS colour
FROM (SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, 'cum_mean' AS result_type, cum_mean AS value FROM clean_scales
      UNION ALL
      SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id, 'mean' AS result_type, mean AS value FROM clean_scales)
"""


@query("r6_class_bins", _rt_sql(lambda v: _cls_sql(v, 5)))
def r6_class_bins(spark, sf_dir):
    return ms(_no_nan(risk.class_bins(risk.result_type_long(_gap_scales(spark, sf_dir)), interval=5), "value"))


R7_INTERVAL = 3


@query("r7_reference_colour", _rt_sql(lambda v: _cls_sql(_cls_sql(v, R7_INTERVAL) + " * 5", R7_INTERVAL)))
def r7_reference_colour(spark, sf_dir):
    return ms(_no_nan(risk.reference_colour(risk.result_type_long(_gap_scales(spark, sf_dir)), interval=R7_INTERVAL), "value"))


@query("r9_multi_model", """
SELECT region, model, cycle_s * 1000 AS cycle_ms, cat_id,
       CASE WHEN count(*) = count(mean) THEN CAST(sum(CAST(mean AS DECIMAL(18,1))) AS DOUBLE) END AS cum_mean,
       max(mean) AS mean, max(max) AS max
FROM gresults_mr GROUP BY ALL
""")
def r9_multi_model(spark, sf_dir):
    """Every region and model in one job: the test data twice, the second
    region on a grid shifted half a cell west (other weights, clipped edge);
    a second variable on the grid and cells outside each region's box."""
    polys, gd, options = _two_regions(spark, sf_dir)
    _, scales = WF.run(spark, V.both_regions(V.raw_grid_vars(spark, sf_dir)), polys, gd, **options)
    return ms(scales)


def _two_regions(spark, sf_dir):
    """Polygons, grid geometry and run options of both test regions."""
    regions = {name: RegionSpec(name, name, 0.0, 15.0, -1e6, 20.0, ("gfs", "wrfpr")) for name in (V.REGION, V.REGION2)}
    gd = V.both_regions(V.grid_def(spark, sf_dir))
    gd = gd.withColumn("x0", F.when(F.col("region") == V.REGION2, F.lit(-0.5)).otherwise(F.col("x0")))
    return V.both_regions(_polys(spark, sf_dir)), gd, {
        "region_models": region_models_df(spark, regions), "regions": V.boxes(spark)}


# --------------------------------------------------------------------------
# T: streaming
# --------------------------------------------------------------------------
@query("k5_bucketed_run", f"""
SELECT region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, cat_id, count, max, mean
FROM gresults_mr WHERE region = '{V.REGION}'
""")
def k5_bucketed_run(spark, sf_dir):
    """The run over a grid and weights that are stored bucketed by cell."""
    tag = work_path(spark, "k5").rsplit("-", 1)[1]
    polys, gd = _polys(spark, sf_dir), V.grid_def(spark, sf_dir)
    grid = WF.subset(V.raw_grid_vars(spark, sf_dir), gd, V.boxes(spark))
    cells = BK.write_cells(grid, f"k5_cells_{tag}", work_path(spark, "k5-cells"), 8)
    weights = BK.write_cell_weights(Z.zonal_weights(PG.polygon_edges(polys), gd), f"k5_weights_{tag}", work_path(spark, "k5-weights"), 8)
    return ms(WF.bucketed_results(cells, weights, models_df(spark), WF.written_manifest(spark, cells), polys))


@query("k1_snapshot_read", f"""
SELECT r.region, r.model, r.cycle_s * 1000 AS cycle_ms, r.cat_id, count(*) AS n_steps, max(r.max) AS max,
       max(s.cum_mean) AS cum_mean
FROM gresults_mr r JOIN (
  SELECT region, model, cycle_s, cat_id,
         CASE WHEN count(*) = count(mean) THEN CAST(sum(CAST(mean AS DECIMAL(18,1))) AS DOUBLE) END AS cum_mean
  FROM gresults_mr GROUP BY ALL) s USING (region, model, cycle_s, cat_id)
WHERE r.region = '{V.REGION}' GROUP BY ALL
""")
def k1_snapshot_read(spark, sf_dir):
    """Two runs with one publish each; the second redoes the clobbered cycles.
    Results and scales are read as of one state of the pointer."""
    grid_path, out = work_path(spark, "k1-grid"), work_path(spark, "k1-out")
    SK.write_grid(V.raw_grid_vars(spark, sf_dir), grid_path)
    raw = SK.read_table(spark, grid_path)
    _, _, options = _two_regions(spark, sf_dir)
    polys, gd = _polys(spark, sf_dir), V.grid_def(spark, sf_dir)
    RC.run_cycles(spark, raw, polys, gd, out, snapshots=True, **options)
    oldest = SN.snapshot(spark, out).groupBy("region", "model").agg(F.min("cycle").alias("cycle"))
    SN.publish(spark.createDataFrame(oldest.collect(), oldest.schema), out, "", "clobbered")
    RC.run_cycles(spark, raw, polys, gd, out, snapshots=True, **options)
    at = SN.snapshot(spark, out)
    keys = ["region", "model", "cycle", "cat_id"]
    scales = SN.read_snapshot(spark, out, "scales", at).select(*keys, "cum_mean")
    return ms(SN.read_snapshot(spark, out, "results", at).join(scales, keys).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n_steps"), F.max("max").alias("max"), F.max("cum_mean").alias("cum_mean")))


@query("t1_incremental_ingest", f"""
SELECT region, model, cycle_s * 1000 AS cycle_ms, step_h, vt_s * 1000 AS ts_ms, cat_id, count, max, mean
FROM gresults_mr WHERE region = '{V.REGION}'
""")
def t1_incremental_ingest(spark, sf_dir):
    """The steps of every cycle land in four waves, each ingested before the
    next lands.  In one cycle of three, some steps of the second wave come with
    the last one."""
    landing, out, ck = (work_path(spark, "t1-landing"), work_path(spark, "t1-results"),
                        work_path(spark, "t1-checkpoint"))
    polys, gd = _polys(spark, sf_dir), V.grid_def(spark, sf_dir)
    weights = WF.materialise_weights(spark, polys, gd)
    raw_path = work_path(spark, "t1-raw")
    last = F.when(F.col("model") == "gfs", F.lit(168)).otherwise(F.lit(48))
    wave = F.least(F.floor((F.col("step_h") - 1) * 4 / last), F.lit(3))
    late = (F.pmod(F.unix_date(F.to_date("cycle")), F.lit(3)) == 0) & (wave == 1) & (F.col("step_h") % 4 == 0)
    V.raw_grid_vars(spark, sf_dir).withColumn("wave", F.when(late, F.lit(3)).otherwise(wave).cast("int")) \
        .write.partitionBy("wave").parquet(raw_path)
    for k in range(4):
        SK.write_table(spark.read.parquet(raw_path).filter(F.col("wave") == k).drop("wave"), landing, mode="append")
        ST.ingest(spark, landing, out, ck, weights, max_files_per_trigger=10_000, runs_path=work_path(spark, "t1-runs"),
                  catchments=polys, grid_def=gd, regions=V.boxes(spark))
    return ms(SK.read_table(spark, out))
