"""DuckDB SQL for the §7.3 views and the per-operator oracle queries.

Every literal is cast to DOUBLE where Spark computes in double (DuckDB reads
``1.4`` as a DECIMAL), integer arithmetic mirrors the Spark views exactly,
and times leave the queries as epoch milliseconds.
"""

from __future__ import annotations


def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def hed(num: str, den: str) -> str:
    """Exact half-even rounding of num/den (integers, den > 0)."""
    r = f"(((({num}) % ({den})) + ({den})) % ({den}))"
    q = f"((({num}) - {r}) // ({den}))"
    return (f"(CASE WHEN 2 * {r} > ({den}) THEN {q} + 1 "
            f"WHEN 2 * {r} = ({den}) AND ((({q}) % 2) + 2) % 2 = 1 THEN {q} + 1 ELSE {q} END)")


def pyround1(x: str) -> str:
    """Python's round(x, 1) on a double, exactly (mirror of rounding.py_round1)."""
    x = f"CAST({x} AS DOUBLE)"
    n = f"round_even({x} * 10.0::DOUBLE, 0)"
    a = f"({x} * 16.0::DOUBLE)"
    b = f"({x} * 4.0::DOUBLE)"
    s = f"({a} + {b})"
    bb = f"({s} - {a})"
    err = f"(({a} - ({s} - {bb})) + ({b} - {bb}))"
    up = f"({n} * 2 + 1)"
    dn = f"({n} * 2 - 1)"
    even_up = f"(CASE WHEN fmod({n} + 1, 2.0::DOUBLE) = 0 THEN {n} + 1 ELSE {n} END)"
    even_dn = f"(CASE WHEN fmod({n} - 1, 2.0::DOUBLE) = 0 THEN {n} - 1 ELSE {n} END)"
    r = (f"(CASE WHEN {s} > {up} OR ({s} = {up} AND {err} > 0) THEN {n} + 1 "
         f"WHEN {s} = {up} AND {err} = 0 THEN {even_up} "
         f"WHEN {s} < {dn} OR ({s} = {dn} AND {err} < 0) THEN {n} - 1 "
         f"WHEN {s} = {dn} AND {err} = 0 THEN {even_dn} ELSE {n} END)")
    return f"(CASE WHEN abs({x}) >= {float(2 ** 49)}::DOUBLE THEN {x} ELSE {r} / 10.0::DOUBLE END)"


def nround1(x: str) -> str:
    """numpy-style rint(x*10)/10."""
    return f"(round_even(CAST({x} AS DOUBLE) * 10.0::DOUBLE, 0) / 10.0::DOUBLE)"


def cell_value(cents: str) -> str:
    """Rain of a test cell: many decimals, no data in one cell-step of 101."""
    return (f"CASE WHEN (cat_id * 13 + vt_s // 3600) % 101 <> 0 THEN CAST({cents} AS DOUBLE) / 100.0::DOUBLE "
            f"+ CAST((cat_id * 31) % 997 + 1 AS DOUBLE) / 1000003.0::DOUBLE * step_h END")


def stamp(sec: str) -> str:
    """epoch seconds -> yyyyMMddHH bigint."""
    return f"CAST(strftime(make_timestamp(({sec}) * 1000000), '%Y%m%d%H') AS BIGINT)"


REGION = "testbasin"
REGION2 = "testbasin2"    # the same data on a grid shifted half a cell west (R9)


def weights_ctes(p: str, polys: str, grid_def: str) -> str:
    """Fine-cell weights by brute force: every fine centre of a part's box is
    tested against the part's edges, and counts once however many parts of
    its catchment hold it."""
    return f"""
{p}vert AS (
  SELECT region, cat_id, part, v.i AS i,
         CASE v.i WHEN 0 THEN cx - hw WHEN 1 THEN cx WHEN 2 THEN cx + hw WHEN 3 THEN cx ELSE cx - hw END AS x,
         CASE v.i WHEN 0 THEN cy WHEN 1 THEN cy + hh WHEN 2 THEN cy WHEN 3 THEN cy - hh ELSE cy END AS y
  FROM {polys}, (VALUES (0), (1), (2), (3), (4)) v(i)),
{p}edges AS (
  SELECT a.region, a.cat_id, a.part, 0 AS ring, a.i AS seq, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM {p}vert a JOIN {p}vert b ON a.region = b.region AND a.cat_id = b.cat_id AND a.part = b.part AND b.i = a.i + 1),
{p}box AS (
  SELECT p.region, g.model, p.cat_id, p.part, g.x0, g.y_top, g.dx, g.dy, g.factor,
         greatest(CAST(floor((g.y_top - (p.cy + p.hh)) / (g.dy / g.factor)) AS BIGINT) - 1, 0) AS i0,
         least(CAST(ceil((g.y_top - (p.cy - p.hh)) / (g.dy / g.factor)) AS BIGINT) + 1, g.n_rows * g.factor) AS i1,
         greatest(CAST(floor(((p.cx - p.hw) - g.x0) / (g.dx / g.factor)) AS BIGINT) - 1, 0) AS j0,
         least(CAST(ceil(((p.cx + p.hw) - g.x0) / (g.dx / g.factor)) AS BIGINT) + 1, g.n_cols * g.factor) AS j1
  FROM {polys} p JOIN {grid_def} g ON p.region = g.region),
{p}fine AS (
  SELECT region, model, cat_id, part, factor, i, j,
         x0 + (j + 0.5::DOUBLE) * (dx / factor) AS xc, y_top - (i + 0.5::DOUBLE) * (dy / factor) AS yc
  FROM (SELECT *, unnest(range(j0, greatest(j1, j0))) AS j
        FROM (SELECT *, unnest(range(i0, greatest(i1, i0))) AS i FROM {p}box))),
{p}weights AS (
  SELECT region, model, cat_id, CAST(i // factor AS INTEGER) AS "row", CAST(j // factor AS INTEGER) AS col,
         count(*) AS w
  FROM (SELECT DISTINCT region, model, cat_id, i, j, factor
        FROM (SELECT f.region, f.model, f.cat_id, f.part, f.i, f.j, f.factor
              FROM {p}fine f JOIN {p}edges e ON e.cat_id = f.cat_id AND e.region = f.region AND e.part = f.part
              WHERE (e.y1 > f.yc) != (e.y2 > f.yc)
                AND f.xc < e.x1 + (f.yc - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
              GROUP BY ALL HAVING count(*) % 2 = 1))
  GROUP BY ALL)"""


VIEWS = f"""
ev AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us,
         CAST(round(value * 100) AS BIGINT) AS cents
  FROM events),
cells_gfs AS (
  SELECT user_id AS cat_id, (us // 21600000000 + 1) * 21600 AS vt_s,
         sum(cents) AS cents, max(cents) AS mx_cents, count(*) AS n
  FROM ev GROUP BY 1, 2),
cells_wrfpr AS (
  SELECT user_id AS cat_id, (us // 3600000000 + 1) * 3600 AS vt_s,
         sum(cents) AS cents, max(cents) AS mx_cents, count(*) AS n
  FROM ev GROUP BY 1, 2),
cells0 AS (
  SELECT 'gfs' AS model, cat_id, vt_s, cents, mx_cents, n,
         ((vt_s - 21600 - 345600) // 604800) * 604800 + 345600 AS cycle_s FROM cells_gfs
  UNION ALL
  SELECT 'wrfpr' AS model, cat_id, vt_s, cents, mx_cents, n,
         ((vt_s - 3600 - 21600) // 172800) * 172800 + 21600 AS cycle_s FROM cells_wrfpr),
cells AS (SELECT *, CAST((vt_s - cycle_s) // 3600 AS INTEGER) AS step_h FROM cells0),
results AS (
  SELECT '{REGION}' AS region, model, cat_id,
         {D(hed('mx_cents', '10'))} / 10.0::DOUBLE AS max,
         CASE WHEN (cat_id * 7 + vt_s // 3600) % 41 <> 0 THEN {D(hed('cents', 'n * 10'))} / 10.0::DOUBLE END AS mean,
         n AS count, cycle_s, vt_s, step_h
  FROM cells),
thresholds_wide AS (
  SELECT c_custkey AS BASIN, c_acctbal / 20.0::DOUBLE AS "01FFG2018021312" FROM customer),
thresholds AS (
  SELECT BASIN AS cat_id, '01FFG2018021312' AS product, "01FFG2018021312" AS threshold
  FROM thresholds_wide),
grid AS (
  SELECT '{REGION}' AS region, model, cycle_s, step_h, vt_s, 'APCP' AS var, 'surface' AS level,
         CAST(cat_id // 15 AS INTEGER) AS "row", CAST(cat_id % 15 AS INTEGER) AS col,
         {cell_value('cents')} AS value
  FROM cells),
raw_grid AS (
  SELECT '{REGION}' AS region, model, cycle_s, step_h, vt_s, 'APCP' AS var, 'surface' AS level,
         CAST(cat_id // 15 AS INTEGER) AS "row", CAST(cat_id % 15 AS INTEGER) AS col,
         {cell_value("""CASE WHEN model = 'wrfpr'
                   THEN sum(cents) OVER (PARTITION BY model, cycle_s, cat_id ORDER BY vt_s
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                   ELSE cents END""")} AS value
  FROM cells),
grid_def AS (
  SELECT '{REGION}' AS region, m.model, 0.0::DOUBLE AS x0, 10.0::DOUBLE AS y_top,
         1.0::DOUBLE AS dx, 1.0::DOUBLE AS dy,
         CAST((SELECT max(user_id) // 15 FROM events) + 1 AS INTEGER) AS n_rows,
         15 AS n_cols, 10 AS factor
  FROM (VALUES ('gfs'), ('wrfpr')) m(model)),
polygons AS (
  SELECT '{REGION}' AS region, CAST(s_suppkey AS BIGINT) AS cat_id, s_name AS name,
         CAST(s_suppkey % 10 AS DOUBLE) * 1.5::DOUBLE + 0.7671::DOUBLE AS cx,
         9.5::DOUBLE - CAST(s_suppkey // 10 AS DOUBLE) + 0.0213::DOUBLE AS cy,
         CASE WHEN s_suppkey % 7 = 3 THEN 0.01::DOUBLE
              ELSE 0.9::DOUBLE + CAST(s_suppkey % 5 AS DOUBLE) * 0.13::DOUBLE END AS hw,
         CASE WHEN s_suppkey % 7 = 3 THEN 0.01::DOUBLE
              ELSE 0.7::DOUBLE + CAST(s_suppkey % 3 AS DOUBLE) * 0.17::DOUBLE END AS hh
  FROM supplier),
requests AS (
  SELECT o_orderkey AS request_id,
         '{{"region":"{REGION}","model":"' || CASE WHEN o_orderstatus = 'F' THEN 'wrfpr' ELSE 'gfs' END
         || '","watershedID":' || CAST(o_custkey AS VARCHAR) || '}}' AS body,
         CASE WHEN o_orderstatus = 'F' THEN 'wrfpr' ELSE 'gfs' END AS req_model,
         o_custkey AS req_cat
  FROM orders),
cycles_ranked AS (
  SELECT model, cycle_s, dense_rank() OVER (PARTITION BY model ORDER BY cycle_s DESC) AS rk
  FROM (SELECT DISTINCT model, cycle_s FROM cells)),
runs AS (
  SELECT r.region, model, cycle_s, 'done' AS state, cycle_s + 86400 AS updated_s
  FROM cycles_ranked, (VALUES ('{REGION}', 1), ('{REGION2}', 2)) r(region, n) WHERE rk > r.n
  UNION ALL
  SELECT '{REGION}', model, cycle_s, 'clobbered' AS state, cycle_s + 90000 AS updated_s FROM cycles_ranked WHERE rk = 2),
scales AS (
  SELECT region, model, cycle_s, cat_id,
         CASE WHEN count(*) = count(mean) THEN CAST(sum(CAST(mean AS DECIMAL(18,1))) AS DOUBLE) END AS cum_mean,
         max(mean) AS mean, max(max) AS max
  FROM results GROUP BY ALL),
gap_scales AS (
  SELECT region, model, cycle_s, cat_id,
         CASE WHEN cat_id % 7 = 2 THEN 'NaN'::DOUBLE WHEN cat_id % 11 = 5 THEN NULL ELSE cum_mean END AS cum_mean,
         CASE WHEN cat_id % 7 = 3 THEN 'NaN'::DOUBLE WHEN cat_id % 11 = 6 THEN NULL ELSE mean END AS mean,
         max FROM scales),
clean_scales AS (
  SELECT region, model, cycle_s, cat_id, CASE WHEN NOT isnan(cum_mean) THEN cum_mean END AS cum_mean,
         CASE WHEN NOT isnan(mean) THEN mean END AS mean, max FROM gap_scales),
cpoly AS (
  SELECT '{REGION}' AS region, c_custkey AS cat_id, p.part AS part,
         CAST(c_custkey % 15 AS DOUBLE) + 0.5::DOUBLE + CAST((c_custkey // 15) % 7 AS DOUBLE) * 0.0371::DOUBLE + p.sx AS cx,
         9.5::DOUBLE - CAST(c_custkey // 15 AS DOUBLE) * 0.1::DOUBLE - CAST(c_custkey % 11 AS DOUBLE) * 0.0293::DOUBLE + p.sy AS cy,
         0.45::DOUBLE + CAST(c_custkey % 5 AS DOUBLE) * 0.173::DOUBLE AS hw,
         0.35::DOUBLE + CAST(c_custkey % 3 AS DOUBLE) * 0.141::DOUBLE AS hh
  FROM customer, (VALUES (0, 0.0::DOUBLE, 0.0::DOUBLE), (1, 0.2137::DOUBLE, 0.1319::DOUBLE)) p(part, sx, sy)),
grid_def_mr AS (
  SELECT * FROM grid_def UNION ALL
  SELECT '{REGION2}' AS region, model, -0.5::DOUBLE AS x0, y_top, dx, dy, n_rows, n_cols, factor FROM grid_def),
polygons_mr AS (
  SELECT region, cat_id, name, 0 AS part, cx, cy, hw, hh FROM polygons UNION ALL
  SELECT '{REGION2}' AS region, cat_id, name, 0 AS part, cx, cy, hw, hh FROM polygons),
{weights_ctes('c', 'cpoly', 'grid_def')},
basin_poly AS (
  SELECT '{REGION}' AS region, CAST(s_suppkey AS BIGINT) AS cat_id, 0 AS part,
         CAST(s_suppkey % 7 AS DOUBLE) * 0.8713::DOUBLE + 4.7671::DOUBLE AS cx,
         7.1::DOUBLE - CAST(s_suppkey // 10 AS DOUBLE) + 0.0213::DOUBLE AS cy,
         4.3107::DOUBLE + CAST(s_suppkey % 5 AS DOUBLE) * 0.6171::DOUBLE AS hw,
         3.1093::DOUBLE + CAST(s_suppkey % 3 AS DOUBLE) * 0.4719::DOUBLE AS hh
  FROM supplier),
{weights_ctes('w', 'basin_poly', 'grid_def')},
{weights_ctes('b', 'polygons_mr', 'grid_def_mr')},
points AS (
  SELECT event_id, '{REGION}' AS region, fmod(value, 16.0::DOUBLE) - 0.5::DOUBLE AS lon,
         10.5::DOUBLE - CAST(event_id % 120 AS DOUBLE) / 10.0::DOUBLE AS lat
  FROM events),
zframe AS (
  SELECT g.*, p.cat_id FROM (SELECT DISTINCT region, model, cycle_s, step_h, vt_s FROM grid) g
  JOIN polygons p ON p.region = g.region),
zcells AS (
  SELECT g.region, g.model, g.cycle_s, g.step_h, g.vt_s, w.cat_id, sum(w.w) AS n, max(g.value) AS max,
         fsum(w.w * g.value) / sum(w.w) AS mean
  FROM grid g JOIN bweights w
    ON g.region = w.region AND g.model = w.model AND g."row" = w."row" AND g.col = w.col
  WHERE g.value IS NOT NULL GROUP BY ALL),
zstats AS (
  SELECT f.region, f.model, f.cycle_s, f.step_h, f.vt_s, f.cat_id, CAST(coalesce(z.n, 0) AS BIGINT) AS count, z.max, z.mean
  FROM zframe f LEFT JOIN zcells z USING (region, model, cycle_s, step_h, vt_s, cat_id)),
bstats AS (
  SELECT f.region, f.model, f.cycle_s, f.step_h, f.vt_s, f.cat_id, CAST(coalesce(z.n, 0) AS BIGINT) AS count, z.max, z.mean
  FROM zframe f LEFT JOIN (
    SELECT g.region, g.model, g.cycle_s, g.step_h, g.vt_s, w.cat_id, sum(w.w) AS n, max(g.value) AS max,
           fsum(w.w * g.value) / sum(w.w) AS mean
    FROM grid g JOIN wweights w ON g.region = w.region AND g.model = w.model AND g."row" = w."row" AND g.col = w.col
    WHERE g.value IS NOT NULL GROUP BY ALL) z USING (region, model, cycle_s, step_h, vt_s, cat_id)),
cstats AS (
  SELECT f.region, f.model, f.cycle_s, f.step_h, f.vt_s, c.c_custkey AS cat_id, CAST(coalesce(z.n, 0) AS BIGINT) AS count, z.max, z.mean
  FROM (SELECT DISTINCT region, model, cycle_s, step_h, vt_s FROM grid) f CROSS JOIN customer c LEFT JOIN (
    SELECT g.region, g.model, g.cycle_s, g.step_h, g.vt_s, w.cat_id, sum(w.w) AS n, max(g.value) AS max,
           fsum(w.w * g.value) / sum(w.w) AS mean
    FROM grid g JOIN cweights w ON g.region = w.region AND g.model = w.model AND g."row" = w."row" AND g.col = w.col
    WHERE g.value IS NOT NULL GROUP BY ALL) z
  ON z.region = f.region AND z.model = f.model AND z.cycle_s = f.cycle_s AND z.step_h = f.step_h AND z.vt_s = f.vt_s
     AND z.cat_id = c.c_custkey),
tile_cells AS (
  SELECT t.region, t.model, t.cycle_s, t.step_h, t.vt_s, c."row", c.col, g.value
  FROM (SELECT DISTINCT region, model, cycle_s, step_h, vt_s, "row" // 4 AS tr, col // 4 AS tc FROM raw_grid) t
  JOIN (SELECT DISTINCT region, model, cycle_s, "row", col FROM raw_grid) c
    ON c.region = t.region AND c.model = t.model AND c.cycle_s = t.cycle_s AND c."row" // 4 = t.tr AND c.col // 4 = t.tc
  LEFT JOIN raw_grid g ON g.region = t.region AND g.model = t.model AND g.cycle_s = t.cycle_s AND g.step_h = t.step_h
    AND g."row" = c."row" AND g.col = c.col),
tile_deacc AS (
  SELECT region, model, cycle_s, step_h, vt_s, "row", col,
         CASE WHEN model = 'wrfpr' THEN
              CASE WHEN row_number() OVER w = 1 THEN value ELSE value - lag(value) OVER w END
              ELSE value END AS value
  FROM tile_cells
  WINDOW w AS (PARTITION BY region, model, cycle_s, "row", col ORDER BY vt_s)),
tied AS (
  SELECT region, model, cycle_s, step_h, vt_s, "row", col,
         CASE WHEN model = 'wrfpr' THEN CASE WHEN row_number() OVER w = 1 THEN v ELSE v - lag(v) OVER w END ELSE v END AS v
  FROM (SELECT *, CAST(floor(value * 4.0::DOUBLE) / 4.0::DOUBLE AS DECIMAL(18,2)) AS v FROM raw_grid)
  WINDOW w AS (PARTITION BY region, model, cycle_s, "row", col ORDER BY vt_s)),
tied_stats AS (
  SELECT f.region, f.model, f.cycle_s, f.step_h, f.vt_s, f.cat_id, CAST(coalesce(z.n, 0) AS BIGINT) AS count, z.max, z.mean
  FROM zframe f LEFT JOIN (
    SELECT g.region, g.model, g.cycle_s, g.step_h, g.vt_s, w.cat_id, sum(w.w) AS n, CAST(max(g.v) AS DOUBLE) AS max,
           CAST(sum(w.w * g.v) AS DOUBLE) / CAST(sum(w.w) AS DOUBLE) AS mean
    FROM tied g JOIN bweights w ON g.region = w.region AND g.model = w.model AND g."row" = w."row" AND g.col = w.col
    WHERE g.v IS NOT NULL GROUP BY ALL) z USING (region, model, cycle_s, step_h, vt_s, cat_id)),
deacc AS (
  SELECT region, model, cycle_s, step_h, vt_s, "row", col,
         CASE WHEN model = 'wrfpr' THEN
              CASE WHEN row_number() OVER w = 1 THEN value ELSE value - lag(value) OVER w END
              ELSE value END AS value
  FROM raw_grid
  WINDOW w AS (PARTITION BY region, model, cycle_s, "row", col ORDER BY vt_s)),
complete AS (
  SELECT region, model, cycle_s, count(DISTINCT step_h) AS n_steps_seen FROM grid GROUP BY ALL
  HAVING count(DISTINCT step_h) >= CASE model WHEN 'gfs' THEN 28 ELSE 48 END),
deacc_mr AS (
  SELECT d.* FROM (SELECT * FROM deacc UNION ALL
                   SELECT '{REGION2}' AS region, model, cycle_s, step_h, vt_s, "row", col, value FROM deacc) d
  JOIN (VALUES ('{REGION}', 0.0::DOUBLE, 1.2::DOUBLE, 13.4::DOUBLE), ('{REGION2}', -0.5::DOUBLE, 0.4::DOUBLE, 12.0::DOUBLE))
       b(region, x0, "left", "right") ON b.region = d.region
  WHERE b.x0 + (d.col + 0.5::DOUBLE) * 1.0::DOUBLE BETWEEN b."left" AND b."right"),
complete_mr AS (
  SELECT region, model, cycle_s, count(DISTINCT step_h) AS n_steps_seen FROM deacc_mr GROUP BY ALL
  HAVING count(DISTINCT step_h) >= CASE model WHEN 'gfs' THEN 28 ELSE 48 END),
gated_mr AS (
  SELECT d.* FROM deacc_mr d SEMI JOIN complete_mr c USING (region, model, cycle_s)),
gcells_mr AS (
  SELECT g.region, g.model, g.cycle_s, g.step_h, g.vt_s, w.cat_id, sum(w.w) AS n, max(g.value) AS max,
         fsum(w.w * g.value) / sum(w.w) AS mean
  FROM gated_mr g JOIN bweights w
    ON g.region = w.region AND g.model = w.model AND g."row" = w."row" AND g.col = w.col
  WHERE g.value IS NOT NULL GROUP BY ALL),
gresults_mr AS (
  SELECT f.region, f.model, f.cycle_s, f.step_h, f.vt_s, f.cat_id, CAST(coalesce(z.n, 0) AS BIGINT) AS count,
         {nround1('z.max')} AS max, {nround1('z.mean')} AS mean
  FROM (SELECT s.*, p.cat_id FROM (SELECT DISTINCT region, model, cycle_s, step_h, vt_s FROM gated_mr) s
        JOIN polygons_mr p ON p.region = s.region) f
  LEFT JOIN gcells_mr z USING (region, model, cycle_s, step_h, vt_s, cat_id)),
running AS (
  SELECT *, CASE WHEN count(*) OVER upto = count(mean) OVER upto
                 THEN CAST(sum(CAST(mean AS DECIMAL(18,1))) OVER upto AS DOUBLE) END AS cum
  FROM results
  WINDOW upto AS (PARTITION BY region, model, cycle_s, cat_id ORDER BY vt_s
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""


def q(body: str) -> str:
    return "WITH " + VIEWS.strip() + "\n" + body.strip()
