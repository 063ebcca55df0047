"""Model and region registry.

One row per model / region.  The tables are literal, so the planner knows their
bytes and broadcasts them by size.  A new model is a new ``ModelSpec``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pluvio.session import literal_table


@dataclass(frozen=True)
class ModelSpec:
    name: str
    display: str
    step_start: int          # first forecast step, hours after the cycle
    step_inc: int            # hours between steps
    n_steps: int             # steps per complete cycle
    cycle_hours: tuple       # UTC hours at which cycles start
    ready_lag_h: int         # a cycle is taken once the clock is past hour + lag
    factor: int              # refinement factor of the zonal statistics
    accumulation: str        # 'interval' (used as read) | 'running' (differenced)


@dataclass(frozen=True)
class RegionSpec:
    name: str
    display: str
    left: float
    right: float
    bottom: float
    top: float
    models: tuple = field(default_factory=tuple)


# The two forecast models and their settings.
MODELS = {
    "gfs": ModelSpec("gfs", "GFS", 6, 6, 28, (0, 6, 12, 18), 3, 100, "interval"),
    "wrfpr": ModelSpec("wrfpr", "WRF-PR", 1, 1, 48, (6, 18), 3, 20, "running"),
}

# The two regions, their subset boxes (lon/lat) and models.
REGIONS = {
    "hispaniola": RegionSpec("hispaniola", "Hispaniola", -75.0, -68.0, 17.0, 20.5, ("gfs", "wrfpr")),
    "centralamerica": RegionSpec("centralamerica", "Central America", -94.25, -75.5, 5.5, 19.5, ("gfs",)),
}

MODEL_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("display", T.StringType(), False),
    T.StructField("step_start", T.IntegerType(), False),
    T.StructField("step_inc", T.IntegerType(), False),
    T.StructField("n_steps", T.IntegerType(), False),
    T.StructField("cycle_hours", T.ArrayType(T.IntegerType()), False),
    T.StructField("ready_lag_h", T.IntegerType(), False),
    T.StructField("factor", T.IntegerType(), False),
    T.StructField("accumulation", T.StringType(), False),
])

REGION_SCHEMA = T.StructType([
    T.StructField("region", T.StringType(), False),
    T.StructField("display", T.StringType(), False),
    T.StructField("left", T.DoubleType(), False),
    T.StructField("right", T.DoubleType(), False),
    T.StructField("bottom", T.DoubleType(), False),
    T.StructField("top", T.DoubleType(), False),
])


def models_df(spark: SparkSession, models: dict | None = None) -> DataFrame:
    rows = [(m.name, m.display, m.step_start, m.step_inc, m.n_steps, list(m.cycle_hours),
             m.ready_lag_h, m.factor, m.accumulation) for m in (models or MODELS).values()]
    return literal_table(spark, rows, MODEL_SCHEMA)


def regions_df(spark: SparkSession, regions: dict | None = None) -> DataFrame:
    rows = [(r.name, r.display, r.left, r.right, r.bottom, r.top)
            for r in (regions or REGIONS).values()]
    return literal_table(spark, rows, REGION_SCHEMA)


def region_models_df(spark: SparkSession, regions: dict | None = None) -> DataFrame:
    """Which models run for which region (the region -> model choice)."""
    rows = [(r.name, m) for r in (regions or REGIONS).values() for m in r.models]
    return literal_table(spark, rows, "region string, model string")
