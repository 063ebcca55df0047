"""Table sources: zonal results, thresholds, colour scales.

The canonical results schema is

    region string, model string, cat_id bigint, max double, mean double,
    count bigint, cycle timestamp, valid_time timestamp, step_h int

plus any catchment properties (``NAME``, ``ISO3``...).  The reference's CSV
form names the two times ``Forecast Timestamp`` and ``Timestep`` and writes
them as ``yyyyMMddHH`` integers; ``to_reference_form`` / ``normalise_results``
convert between the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions.timefmt import parse_stamp, to_stamp

FORECAST_TS = "Forecast Timestamp"
TIMESTEP = "Timestep"
STAT_COLS = ["cat_id", "max", "mean", "count"]


def _reader(spark: SparkSession, fmt: str):
    r = spark.read
    if fmt == "csv":
        # every column as text; typed by ``normalise_results`` (no inference pass)
        r = r.option("header", True).option("inferSchema", False)
    return r.format(fmt)


def read_results(spark: SparkSession, path: str, fmt: str = "parquet",
                 columns: list[str] | None = None) -> DataFrame:
    """Results scan with column projection.

    Parquet is the normal form (pruning and pushdown reach the scan); CSV in
    the reference's layout is read as text and typed.  ``columns`` is the
    projection, e.g. ``['cat_id', 'mean', 'max', 'Timestep']``.
    """
    df = _reader(spark, fmt).load(path)
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    return df


def type_reference_columns(df: DataFrame) -> DataFrame:
    """Cast the reference CSV's known columns (text) to their types."""
    casts = {"cat_id": "bigint", "max": "double", "mean": "double", "count": "bigint",
             FORECAST_TS: "bigint", TIMESTEP: "bigint"}
    return df.select(*[F.col(f"`{c}`").cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`")
                       for c in df.columns])


def normalise_results(df: DataFrame, region: str | None = None, model: str | None = None) -> DataFrame:
    """Reference CSV form -> canonical form (times as UTC timestamps)."""
    df = type_reference_columns(df)
    out = df
    if FORECAST_TS in df.columns:
        out = out.withColumn("cycle", parse_stamp(F.col(f"`{FORECAST_TS}`"))).drop(FORECAST_TS)
    if TIMESTEP in df.columns:
        out = out.withColumn("valid_time", parse_stamp(F.col(TIMESTEP))).drop(TIMESTEP)
    if region is not None and "region" not in out.columns:
        out = out.withColumn("region", F.lit(region))
    if model is not None and "model" not in out.columns:
        out = out.withColumn("model", F.lit(model))
    return out


def to_reference_form(results: DataFrame, props: list[str] | None = None) -> DataFrame:
    """the statistics with ``Forecast Timestamp`` and ``Timestep`` columns.

    Column order follows the reference file: properties, cat_id, max, mean,
    count, Forecast Timestamp, Timestep.
    """
    props = props or []
    keep = [c for c in ("region", "model") if c in results.columns]
    return results.select(*keep, *props, *STAT_COLS,
                          to_stamp("cycle").alias(FORECAST_TS),
                          to_stamp("valid_time").alias(TIMESTEP))


def read_thresholds(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """S2 (scan): the threshold table as stored (wide: BASIN + products, and
    the region where the table or its folders name one).

    ``ordinal`` is the row's place in its file, so that the first of several
    rows of a catchment can be told (J1).
    """
    df = _reader(spark, fmt).load(path)
    if fmt != "csv":
        return df
    kinds = {"BASIN": "bigint", "region": "string", "ordinal": "bigint"}
    out = df.select(*[F.col(f"`{c}`").cast(kinds.get(c, "double")).alias(c) for c in df.columns],
                    F.struct("_metadata.file_path", "_metadata.file_block_start").alias("_at"))
    if "ordinal" not in df.columns:
        # ids rise within a task, and a task reads a file's range in order
        out = out.withColumn("ordinal", F.struct("_at", F.monotonically_increasing_id().alias("row")))
    return out.drop("_at")


def thresholds_long(wide: DataFrame, key: str = "BASIN", products: list[str] | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """Wide threshold table -> ``(cat_id, product, threshold)``.

    Negative thresholds are the reference's sentinels (-999, -333) and are
    kept here; operators that compare against thresholds treat them as none.
    """
    keep = keep or [c for c in ("region", "ordinal") if c in wide.columns]
    products = products or [c for c in wide.columns if c not in (key, *keep)]
    longf = wide.unpivot([key, *keep], products, "product", "threshold")
    return longf.select(F.col(key).cast("bigint").alias("cat_id"), *keep, "product",
                        F.col("threshold").cast("double").alias("threshold"))


def read_scales(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3: colour-scale scan (``cat_id, cum_mean, mean, max``), keyed by cat_id.

    ``cat_id`` may have been printed as ``11111.0``: cast through double.
    """
    df = _reader(spark, fmt).load(path)
    base = ["cat_id", "cum_mean", "mean", "max"]
    extra = [c for c in df.columns if c not in base]
    out = df.select(*extra, F.col("cat_id").cast("double").cast("bigint").alias("cat_id"),
                    *[F.col(c).cast("double").alias(c) for c in base[1:]])
    if "cycle" in extra and out.schema["cycle"].dataType.typeName() != "timestamp":
        out = out.withColumn("cycle", parse_stamp(F.col("cycle").cast("string")))
    return out
