"""What the web page asked for, for every catchment at once.

E2 (chart): the reference answered one request by scanning the results file
and looping over its rows.  ``chart_documents`` builds the chart of every
catchment, both types, in one job; a request is then a key lookup
(``lookup_charts`` joins a batch of decoded requests).

E3 (map colours): ``colour_map`` gives every polygon its class and colour for
each run, from the colour scales.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from pluvio.functions.classes import DEFAULT_INTERVAL
from pluvio.operators.risk import colour_lookup
from pluvio.operators.series import chart_json, chart_types, decode_requests


def chart_documents(results: DataFrame, thresholds: DataFrame, product: str | None = None,
                    semantics: str = "reference") -> DataFrame:
    """Every catchment's chart JSON, one row per (region, model, cycle, cat_id, chart_type)."""
    return chart_json(chart_types(results, thresholds, product, semantics))


def lookup_charts(charts: DataFrame, requests: DataFrame, chart_type: str = "cumulative") -> DataFrame:
    """Answer a batch of request bodies: join on (region, model, cat_id)."""
    req = decode_requests(requests)
    keys = ["region", "model", "cat_id"]
    return req.join(charts.filter(charts.chart_type == chart_type), keys, "inner")


def colour_map(polygons: DataFrame, scales: DataFrame, result_type: str = "cum_mean",
               interval: int = DEFAULT_INTERVAL, semantics: str = "reference") -> DataFrame:
    return colour_lookup(polygons, scales, result_type, interval, semantics)
