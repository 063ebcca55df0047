"""Catchment summaries, thresholds and map classes.

Group keys are ``(region, model, cycle, cat_id)`` throughout: regions, models
and cycles are ordinary keys, so one job serves them all (R9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions.classes import DEFAULT_INTERVAL, class_of, colour_of, reference_class
from pluvio.functions.rounding import decimal_sum1, py_round1
from pluvio.functions.timefmt import parse_stamp

RUN_KEYS = ["region", "model", "cycle"]
RESULT_TYPES = ["cum_mean", "mean"]          # map colouring choices (F5)


def _keys(df: DataFrame, keys=RUN_KEYS) -> list[str]:
    return [k for k in keys if k in df.columns]


def catchment_summary(results: DataFrame, semantics: str = "reference") -> DataFrame:
    """A5: per catchment ``cum_mean = round(sum(mean), 1)``, ``mean = max(mean)``,
    ``max = max(max)``.

    Algebraic aggregates: partial aggregation runs before the shuffle, so a
    catchment holding a third of all rows costs one partial row per task.
    The sum is exact (decimal), independent of row order.  Reference form: a
    missing mean makes ``cum_mean`` missing; ``'clean'`` skips it.
    """
    keys = _keys(results) + ["cat_id"]
    return results.groupBy(*keys).agg(
        decimal_sum1("mean", poison=(semantics == "reference")).alias("cum_mean"),
        F.max(number("mean")).alias("mean"),
        F.max(number("max")).alias("max"))


def distinct_catchments(results: DataFrame, first_seen: bool = False) -> DataFrame:
    """The catchments present, per region and model.

    ``first_seen`` adds each catchment's first valid time, the order in which
    the reference met them (sort by it only where the order is wanted).
    """
    keys = _keys(results, ["region", "model"]) + ["cat_id"]
    if first_seen:
        return results.groupBy(*keys).agg(F.min("valid_time").alias("first_seen"))
    return results.select(*keys).distinct()


def first_thresholds(thresholds: DataFrame, product: str | None = None) -> DataFrame:
    """One threshold per catchment (J1's first match), per product when no
    product is chosen.

    With an ``ordinal`` column (source order) the first row wins; otherwise
    the smallest value, which is deterministic.
    """
    t = thresholds
    if product is not None:
        t = t.filter(F.col("product") == product)
    keys = _keys(t, ["region"]) + ["cat_id"]
    if product is None and "product" in t.columns:
        keys.append("product")          # every product: one threshold row per product
    pick = (F.min_by("threshold", "ordinal") if "ordinal" in t.columns else F.min("threshold"))
    return t.groupBy(*keys).agg(pick.alias("threshold"))


def _join_keys(left: DataFrame, right: DataFrame) -> list[str]:
    return [k for k in ("region", "cat_id") if k in left.columns and k in right.columns]


def threshold_lookup(keyed: DataFrame, thresholds: DataFrame, product: str | None = None,
                     rounded: bool = True) -> DataFrame:
    """Attach each catchment's threshold (inner: no threshold, no row).

    The threshold table has one row per catchment; AQE turns this into a
    broadcast join when its measured size is small and keeps a shuffle join
    otherwise.  ``rounded`` applies the reference's Python rounding (C9).
    """
    t = first_thresholds(thresholds, product)
    if rounded:
        t = t.withColumn("threshold", py_round1("threshold"))
    return keyed.join(t, _join_keys(keyed, t), "inner")


def issued_thresholds(thresholds: DataFrame) -> DataFrame:
    """Thresholds by issue: ``([region,] cat_id, family, issued, until, threshold)``.

    A product's name ends in the time it was issued (``01FFG2018021312``: family
    01FFG, 2018-02-13 12 UTC); names without such an ending are no issues.  An
    issue holds for a catchment until the next one that has a value for it.  The
    window holds one catchment's issues.
    """
    name = F.regexp_extract("product", r"^(.*?)(\d{10})$", 1)
    stamp = F.regexp_extract("product", r"^(.*?)(\d{10})$", 2)
    t = (thresholds.filter(F.col("threshold").isNotNull() & (stamp != ""))
         .withColumn("family", name).withColumn("issued", parse_stamp(stamp)).filter(F.col("issued").isNotNull()))
    keys = _keys(t, ["region"]) + ["cat_id", "family", "issued"]
    pick = F.min_by("threshold", "ordinal") if "ordinal" in t.columns else F.min("threshold")
    one = t.groupBy(*keys).agg(pick.alias("threshold"))
    until = F.lead("issued").over(Window.partitionBy(*keys[:-1]).orderBy("issued"))
    return one.withColumn("until", until)


def threshold_as_of(keyed: DataFrame, thresholds: DataFrame, rounded: bool = True) -> DataFrame:
    """J1 by issue time: each key's threshold from the latest issue not after its
    cycle, with ``family`` and ``issued`` (inner: no issue so far, no row).

    An equi-join on the catchment; the issues' periods do not overlap, so a key
    meets one of them, whatever their number.
    """
    t = issued_thresholds(thresholds)
    if rounded:
        t = t.withColumn("threshold", py_round1("threshold"))
    holds = (F.col("cycle") >= F.col("issued")) & (F.col("until").isNull() | (F.col("cycle") < F.col("until")))
    return keyed.join(t, _join_keys(keyed, t), "inner").filter(holds).drop("until")


def missing_thresholds(keyed: DataFrame, thresholds: DataFrame, product: str | None = None) -> DataFrame:
    """Catchments without a threshold (the reference raised an error)."""
    t = first_thresholds(thresholds, product)
    return keyed.join(t, _join_keys(keyed, t), "left_anti")


def require_thresholds(keyed: DataFrame, thresholds: DataFrame, product: str | None = None,
                       show: int = 10) -> None:
    """J1's strict form: raise if any catchment has no threshold.

    Only a count and a few example ids reach the driver.
    """
    miss = missing_thresholds(keyed.select(*_keys(keyed, ["region"]), "cat_id").distinct(),
                              thresholds, product)
    n = miss.count()
    if n:
        ids = [r["cat_id"] for r in miss.select("cat_id").orderBy("cat_id").limit(show).collect()]
        raise ValueError(f"{n} catchment(s) without a threshold, e.g. {ids}")


def number(c) -> "F.Column":
    """NaN to null: Spark orders NaN above every number, so it would reach any threshold."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def valid_threshold(col="threshold"):
    """Sentinels (negative values such as -999, -333) mean "no threshold"."""
    c = number(col)
    return F.when(c >= 0, c)


def _with_threshold(keyed: DataFrame, thresholds: DataFrame, product: str | None, as_of: bool) -> DataFrame:
    """``keyed`` with its valid threshold: that of a product, or as of its cycle."""
    if as_of:
        return threshold_as_of(keyed, thresholds, rounded=False).withColumn("threshold", valid_threshold())
    t = first_thresholds(thresholds, product).withColumn("threshold", valid_threshold())
    return keyed.join(t, _join_keys(keyed, t), "inner")


def threshold_compare(scales: DataFrame, thresholds: DataFrame, product: str | None = None, as_of: bool = False) -> DataFrame:
    """Which catchments reach their flash-flood threshold.

    Compares total (``cum_mean``), largest interval mean and largest cell
    maximum with the threshold; sentinel thresholds and missing rain give nulls.
    ``as_of``: the threshold of the latest issue not after the cycle.
    """
    j = _with_threshold(scales, thresholds, product, as_of)
    return j.select("*",
                    (number("cum_mean") >= F.col("threshold")).alias("cum_exceeds"),
                    (number("mean") >= F.col("threshold")).alias("mean_exceeds"),
                    (number("max") >= F.col("threshold")).alias("max_exceeds"))


def time_to_threshold(running: DataFrame, thresholds: DataFrame, product: str | None = None,
                      value: str = "cum", as_of: bool = False) -> DataFrame:
    """First valid time at which the running total reaches the threshold.

    ``running`` holds one row per catchment and step with the running total
    (W1).  The minimum is algebraic (partial aggregation); catchments that
    never reach it keep a null time.  ``lead_h`` is hours after the cycle.
    """
    j = _with_threshold(running, thresholds, product, as_of)
    keys = _keys(running) + ["cat_id"] + [c for c in ("product", "family", "issued") if c in j.columns and c not in running.columns]
    hit = F.when(number(value) >= F.col("threshold"), F.col("valid_time"))
    out = j.groupBy(*keys).agg(F.max("threshold").alias("threshold"),
                               F.min(hit).alias("reached_at"))
    if "cycle" in out.columns:
        out = out.withColumn(
            "lead_h", ((F.unix_seconds("reached_at") - F.unix_seconds("cycle")) / 3600).cast("int"))
    return out


def result_type_long(scales: DataFrame, types: list[str] | None = None) -> DataFrame:
    """all colouring choices at once -> ``(…, cat_id, result_type, value)``."""
    types = types or RESULT_TYPES
    keys = _keys(scales) + ["cat_id"]
    return scales.unpivot(keys, types, "result_type", "value")


def class_bins(df: DataFrame, value: str = "value", interval: int = DEFAULT_INTERVAL) -> DataFrame:
    """Seven classes by interval k; below 0 (or NaN) -> no class."""
    cls = class_of(F.col(value), interval)
    return df.withColumn("class", cls).withColumn("colour", colour_of(F.col("class")))


def reference_colour(df: DataFrame, value: str = "value", interval: int = DEFAULT_INTERVAL) -> DataFrame:
    """The map's own re-binned rule (equals R6 only at k = 5)."""
    cls = reference_class(F.col(value), interval)
    return df.withColumn("class", cls).withColumn("colour", colour_of(F.col("class")))


def colour_lookup(polygons: DataFrame, scales: DataFrame, result_type: str = "cum_mean",
                  interval: int = DEFAULT_INTERVAL, semantics: str = "reference") -> DataFrame:
    """Catchment polygons with their colour, for every run that summarised them.

    ``polygons LEFT JOIN scales`` on (region, cat_id): a polygon without any
    summary keeps one row with null run keys and no colour (the reference
    threw).  No pairs are formed beyond the matching rows.
    """
    feats = polygons.select("region", "cat_id")
    vals = scales.select(*_keys(scales), "cat_id", F.col(result_type).alias("value"))
    j = feats.join(vals, _join_keys(feats, vals), "left")
    fn = reference_class if semantics == "reference" else class_of
    return j.withColumn("class", fn(F.col("value"), interval)).withColumn("colour", colour_of(F.col("class")))


def absent_polygons(polygons: DataFrame, scales: DataFrame) -> DataFrame:
    """Polygons that have no summary row (what made the map throw)."""
    return polygons.select("region", "cat_id").join(
        scales.select("region", "cat_id").distinct(), ["region", "cat_id"], "left_anti")
