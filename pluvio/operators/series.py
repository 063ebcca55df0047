"""Chart series per catchment.

The reference builds one chart per web request by scanning the whole results
file and looping over rows.  Here the series of *every* catchment is one
DataFrame; a chart is a key filter on it.  Windows are partitioned by
``(region, model, cycle, cat_id)``: one partition holds one catchment's steps
of one cycle, so its size is bounded by the model's step count however large
the data grows.
"""

from __future__ import annotations

import numbers

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions.rounding import decimal1, py_round1
from pluvio.operators.risk import threshold_lookup

SERIES_KEYS = ["region", "model", "cycle", "cat_id", "product"]   # product: when several thresholds


def _keys(df: DataFrame) -> list[str]:
    return [k for k in SERIES_KEYS if k in df.columns]


def _by_catchment(df: DataFrame) -> Window:
    return Window.partitionBy(*_keys(df)).orderBy("valid_time")


def time_order(results: DataFrame) -> DataFrame:
    """O1: position of each step on the catchment's time axis (file order = time)."""
    return results.withColumn("pos", F.row_number().over(_by_catchment(results)))


def running_total(results: DataFrame, value: str = "mean", out: str = "cum") -> DataFrame:
    """Running total of the interval means, rounded at each step.

    One-decimal inputs summed as exact decimals give the reference's
    step-by-step rounded total for any summation order.
    """
    w = _by_catchment(results).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return results.withColumn(out, _running(value, w))


def _running(value: str, w) -> "F.Column":
    """Exact running total; like the reference's float sum, a missing value
    (NaN/null) makes this and every later total missing."""
    c = F.col(value)
    missing = F.sum(F.when(c.isNull() | F.isnan(c), 1).otherwise(0)).over(w)
    return F.when(missing == 0, F.sum(decimal1(value)).over(w).cast("double"))


def chart_max(df: DataFrame, value: str = "value", threshold: str = "threshold",
              semantics: str = "reference") -> DataFrame:
    """The chart's upper bound per catchment.

    Reference form: the value at the *latest* time (``max`` of ``[time,
    value]`` pairs), raised to the threshold.  Clean form: the largest value.
    """
    w = Window.partitionBy(*_keys(df))
    if semantics == "reference":
        top = F.max(F.struct(F.col("valid_time"), F.col(value))).over(w)[value]
    else:
        top = F.max(value).over(w)
    return df.withColumn("chart_max", F.greatest(top, F.col(threshold)))


def chart_max_agg(df: DataFrame, value: str = "value", threshold: str = "threshold") -> DataFrame:
    """A7 as an aggregate: one row per catchment (``max(struct)`` = latest)."""
    latest = F.max(F.struct(F.col("valid_time"), F.col(value)))[value]
    return df.groupBy(*_keys(df)).agg(
        F.greatest(latest, F.max(threshold)).alias("chart_max"))


def interval_series(results: DataFrame, thresholds: DataFrame, product: str | None = None,
                    semantics: str = "reference") -> DataFrame:
    """``[epoch_ms, round(mean, 1)]`` per step, the threshold and the chart max."""
    s = results.select(*_keys(results), "valid_time", py_round1("mean").alias("value"))
    s = threshold_lookup(s, thresholds, product)
    s = chart_max(s, semantics=semantics)
    return s.withColumn("ts_ms", F.unix_millis("valid_time"))


def cumulative_series(results: DataFrame, thresholds: DataFrame, product: str | None = None,
                      semantics: str = "reference") -> DataFrame:
    """R2: as R1 with the running total (W1) as the value."""
    s = running_total(results.select(*_keys(results), "valid_time", "mean"), out="value").drop("mean")
    s = threshold_lookup(s, thresholds, product)
    s = chart_max(s, semantics=semantics)
    return s.withColumn("ts_ms", F.unix_millis("valid_time"))


def chart_types(results: DataFrame, thresholds: DataFrame, product: str | None = None,
                semantics: str = "reference") -> DataFrame:
    """Both chart types, tagged, so the page's choice is a filter.

    One threshold join and one window partitioning (by catchment) feed both
    series; each step then becomes two tagged rows.  One shuffle of the
    results instead of one per chart type.
    """
    s = threshold_lookup(results.select(*_keys(results), "valid_time", "mean"), thresholds, product)
    keys = _keys(s)                      # with ``product`` when several thresholds apply
    run = _by_catchment(s).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = (s.withColumn("v_int", py_round1("mean"))
         .withColumn("v_cum", _running("mean", run)))
    whole = Window.partitionBy(*keys)
    if semantics == "reference":
        top = F.max(F.struct("valid_time", "v_int", "v_cum")).over(whole)
        top_int, top_cum = top["v_int"], top["v_cum"]
    else:
        top_int, top_cum = F.max("v_int").over(whole), F.max("v_cum").over(whole)
    s = (s.withColumn("m_int", F.greatest(top_int, F.col("threshold")))
         .withColumn("m_cum", F.greatest(top_cum, F.col("threshold"))))
    two = F.explode(F.array(
        F.struct(F.lit("intervals").alias("chart_type"), F.col("v_int").alias("value"),
                 F.col("m_int").alias("chart_max")),
        F.struct(F.lit("cumulative").alias("chart_type"), F.col("v_cum").alias("value"),
                 F.col("m_cum").alias("chart_max"))))
    out = s.select(*keys, "valid_time", "threshold", two.alias("t"))
    return out.select(*keys, "valid_time", F.col("t.value").alias("value"), "threshold",
                      F.col("t.chart_max").alias("chart_max"), F.col("t.chart_type").alias("chart_type"),
                      F.unix_millis("valid_time").alias("ts_ms"))


def _num_text(c):
    """A number as JSON text; missing (null or NaN) is ``null``, never a gap."""
    return F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")).cast("string"), F.lit("null"))


def chart_json(series: DataFrame) -> DataFrame:
    """K3: one JSON document per chart, laid out as the reference's reply:
    ``{"values": [[ms, v], …], "threshold": t, "max": m}``.

    The group is one catchment's steps of one cycle (bounded by the step
    count).  Pairs are sorted by time inside the group.
    """
    keys = _keys(series) + (["chart_type"] if "chart_type" in series.columns else [])
    g = series.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("ts_ms", _num_text("value").alias("v")))).alias("pts"),
        F.max("threshold").alias("threshold"), F.max("chart_max").alias("chart_max"))
    pairs = F.array_join(F.transform("pts", lambda p: F.concat(
        F.lit("["), p["ts_ms"].cast("string"), F.lit(", "), p["v"], F.lit("]"))), ", ")
    doc = F.concat(F.lit('{"values": ['), pairs, F.lit('], "threshold": '), _num_text("threshold"),
                   F.lit(', "max": '), _num_text("chart_max"), F.lit("}"))
    return g.select(*keys, doc.alias("json"))


def scale_json(scales: DataFrame) -> DataFrame:
    """K4: the colour scales as JSON lines keyed like the reference's reply.

    One line per catchment: key ``"<cat_id>.0"`` (the id printed as a
    float) and ``{"cum_mean": …, "mean": …, "max": …}``.  One document for the
    whole table would pass it through a single task, so it is not built.
    """
    keys = [k for k in ("region", "model", "cycle") if k in scales.columns]
    body = F.concat(F.lit('{"cum_mean": '), _num_text("cum_mean"), F.lit(', "mean": '), _num_text("mean"),
                    F.lit(', "max": '), _num_text("max"), F.lit("}"))
    return scales.select(*keys, F.concat(F.col("cat_id").cast("string"), F.lit(".0")).alias("key"),
                         body.alias("json"))


def decode_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """Request bodies (JSON text) -> typed fields.

    ``json_tuple`` parses each body once for all three fields (a typed
    ``from_json`` is split by the optimizer into one parse per field).  The
    id may arrive as ``11111`` or ``11111.0``; anything else matches nothing.
    """
    others = [c for c in requests.columns if c != body]
    t = F.json_tuple(F.col(body), "region", "model", "watershedID").alias("region", "model", "_wid")
    wid = F.col("_wid")
    cat = F.coalesce(wid.try_cast("bigint"), wid.try_cast("double").try_cast("bigint"))
    return requests.select(*others, t).select(*others, "region", "model", cat.alias("cat_id"))


def point_filter(results: DataFrame, cat_id=None, requests: DataFrame | None = None) -> DataFrame:
    """rows of the requested catchments.

    One id: a typed equality filter (pushed to the scan).  A batch of
    requests: a semi join with the distinct requested keys, so duplicate
    requests do not multiply rows.
    """
    if requests is None:
        if isinstance(cat_id, bool) or not isinstance(cat_id, numbers.Integral):
            # typed comparison as in the reference: a text id equals no catchment
            return results.filter(F.lit(False))
        return results.filter(F.col("cat_id") == F.lit(int(cat_id)).cast("bigint"))
    keys = [k for k in ("region", "model", "cat_id") if k in requests.columns and k in results.columns]
    return results.join(requests.select(*keys).distinct(), keys, "left_semi")
