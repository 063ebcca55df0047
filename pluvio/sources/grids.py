"""Grid sources: tiles, file listings, times from file names.

Binary GRIB/GeoTIFF/NetCDF decoding is not done here (see README): grids
arrive as Parquet, either long (one row per cell and step) or as tiles of
``T x T`` cells (``values array<array<double>>``) which ``explode_tiles``
turns into the long form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions.timefmt import STAMP, fmt, parse_stamp

STEP_KEYS = ["region", "model", "cycle", "step_h", "valid_time"]


def explode_tiles(tiles: DataFrame, values: str = "values") -> DataFrame:
    """Tile rows -> ``(…, row, col, value)``, one row per tile cell.

    ``tiles``: step keys, ``tile_row0``, ``tile_col0`` and a 2-D array.  A
    nodata cell (null/NaN) stays as a row with a null value: its step exists,
    so de-accumulation does not difference across it.
    """
    keys = [k for k in tiles.columns if k not in (values, "tile_row0", "tile_col0")]
    a = tiles.select(*keys, "tile_row0", "tile_col0", F.posexplode(values).alias("ri", "rowvals"))
    b = a.select(*keys, "tile_row0", "tile_col0", "ri", F.posexplode("rowvals").alias("ci", "value"))
    b = b.withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    return b.select(*keys, (F.col("tile_row0") + F.col("ri")).cast("int").alias("row"),
                    (F.col("tile_col0") + F.col("ci")).cast("int").alias("col"), "value")


def make_tiles(grid: DataFrame, size: int = 8, value: str = "value") -> DataFrame:
    """Long grid -> tiles of ``size x size`` (missing cells null).

    A tile group holds at most size^2 cells, whatever the grid size.
    """
    keys = [k for k in grid.columns if k not in ("row", "col", value)]
    t = (grid.withColumn("tile_row0", (F.col("row") - F.pmod("row", F.lit(size))).cast("int"))
         .withColumn("tile_col0", (F.col("col") - F.pmod("col", F.lit(size))).cast("int")))
    slot = (F.col("row") - F.col("tile_row0")) * size + (F.col("col") - F.col("tile_col0"))
    g = t.groupBy(*keys, "tile_row0", "tile_col0").agg(
        F.map_from_entries(F.collect_list(F.struct(slot.alias("k"), F.col(value).alias("v")))).alias("m"))
    idx = F.sequence(F.lit(0), F.lit(size - 1))
    dense = F.transform(idx, lambda r: F.transform(idx, lambda c: F.element_at(F.col("m"), r * size + c)))
    return g.select(*keys, "tile_row0", "tile_col0", dense.alias("values"))


def list_files(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """The files under ``path`` matching ``glob`` (contents are not read).

    Order is never taken from the listing; callers order by a time column.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", True).load(path))
    return df.select("path", "length", "modificationTime",
                     F.element_at(F.split("path", "/"), -1).alias("file_name"))


def read_step_files(spark: SparkSession, path: str, glob: str = "*.parquet",
                    schema=None) -> DataFrame:
    """S6 + C8 on landed files: one file per step named ``yyyyMMddHH.<ext>``.

    The suffix filter is ``pathGlobFilter``; each row's valid time comes from
    its file's name (``_metadata.file_name``), so no listing order is needed.
    """
    r = spark.read.option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return df.select("*", time_from_name(F.col("_metadata.file_name")).alias("valid_time"))


def partition_value(path_col, key: str):
    """``key=value`` directory component of a path (``None`` when absent)."""
    v = F.regexp_extract(path_col, rf"/{key}=([^/]+)/", 1)
    return F.when(v != "", F.url_decode(v))


def time_from_name(name_col, prefix_len: int = 10):
    """Valid time from a file name whose first 10 characters are ``yyyyMMddHH``."""
    return parse_stamp(F.substring(name_col, 1, prefix_len))


def replace_suffix(name_col, old: str, new: str):
    """``2019062118.grb`` -> ``2019062118.tif`` (suffix only)."""
    return F.regexp_replace(name_col, F.lit(r"\Q" + old + r"\E$"), F.lit(new))


def step_file_name(ts_col, suffix: str = ".grb"):
    """The reference's per-step file name: ``yyyyMMddHH`` + suffix."""
    return F.concat(fmt(ts_col, STAMP), F.lit(suffix))
