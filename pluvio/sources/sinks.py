"""Sinks: partitioned tables, retention.

Tables are Parquet partitioned by ``region/model/cycle`` with the cycle in
the directory as ``yyyyMMddHH``.  Overwrites are *dynamic*: only the
partitions present in the written DataFrame are replaced, so re-running one
cycle never touches the others, and a failed task is simply retried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions.timefmt import STAMP, fmt as fmt_time, parse_stamp, parse_stamp_number
from pluvio.operators.grid import step_manifest
from pluvio.session import work_path
from pluvio.sources.grids import list_files, partition_value

PARTS = ["region", "model", "cycle"]


MAX_RECORDS_PER_FILE = 5_000_000


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite", fmt: str = "parquet", rebalance: bool = True,
                cluster_by: list[str] | None = None, replace: str = "dynamic") -> str:
    """K1/K2/K5: write partitioned by region/model/cycle (dynamic overwrite).

    Rows are rebalanced by the partition keys first: AQE measures the shuffle
    and splits a partition value that is larger than the advisory size over
    several tasks and joins small ones, so the number of files follows the
    bytes, and a region or cycle holding a third of all rows is still written
    by many tasks.  ``rebalance=False`` writes from where the rows are, without
    a shuffle (up to tasks x partitions files, each capped at
    ``MAX_RECORDS_PER_FILE`` rows).  ``cluster_by`` orders rows inside each
    file, so Parquet row-group statistics on those columns can skip data.
    ``replace='static'`` replaces the whole table.
    """
    parts = [p for p in (partition_by or PARTS) if p in df.columns]
    out = df
    for f in df.schema.fields:
        if f.name in parts and f.dataType.typeName() == "timestamp":
            out = out.withColumn(f.name, fmt_time(F.col(f.name), STAMP))
    if parts and rebalance:
        out = out.hint("rebalance", *parts)
    order = parts + [c for c in (cluster_by or []) if c in out.columns]
    if order:
        out = out.sortWithinPartitions(*order)
    w = (out.write.mode(mode).option("partitionOverwriteMode", replace)
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).format(fmt))
    if fmt == "csv":
        w = w.option("header", True)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
    return path


def write_grid(grid: DataFrame, path: str, manifest: str | None = None, **kw) -> str:
    """K5: a grid table, partitioned by region/model/cycle, rows ordered by
    variable, if there are several, and cell: a scan for one variable (F3) skips
    the others' pages.

    ``manifest``: also write there the steps of the cycles just written (one
    row per step), from which the completeness gate reads.
    """
    write_table(grid, path, cluster_by=["var", "level", "row", "col"], **kw)
    if manifest:
        written = grid.select("region", "model", "cycle").distinct()
        steps = step_manifest(read_table(grid.sparkSession, path).join(written, PARTS, "left_semi"))
        write_table(steps, manifest)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a table written by ``write_table``; the cycle comes back as a timestamp."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    kind = df.schema["cycle"].dataType.typeName() if "cycle" in df.columns else "timestamp"
    if kind in ("integer", "long"):
        df = df.withColumn("cycle", parse_stamp_number("cycle"))
    elif kind != "timestamp":
        df = df.withColumn("cycle", parse_stamp(F.col("cycle").cast("string")))
    return df


def partition_listing(spark: SparkSession, path: str) -> DataFrame:
    """The (region, model, cycle) partitions of a stored table, from its file
    listing: no data file is opened."""
    files = list_files(spark, path, "part-*")
    return files.select(partition_value(F.col("path"), "region").alias("region"),
                        partition_value(F.col("path"), "model").alias("model"),
                        parse_stamp(partition_value(F.col("path"), "cycle")).alias("cycle")).distinct()


def in_partitions(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of a stored table in the (region, model, cycle) partitions
    listed in ``keys``, a table of any size.

    Spark prunes a scan by another table only where that table is filtered,
    so the keys pass a comparison that they all meet; while they are small
    enough to be broadcast, only their partitions are opened.
    """
    return df.join(keys.select(*PARTS).filter(F.col("region") >= F.lit("")), PARTS, "left_semi")


def latest_cycles(df: DataFrame) -> DataFrame:
    """The current cycle per (region, model) of a table or of its listing."""
    return df.groupBy("region", "model").agg(F.max("cycle").alias("cycle"))


def retain_latest(df: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """K7: keep only each (region, model)'s current cycle (semi join).

    ``listing``: the table's partitions, so that the latest cycles are learned
    without reading the table.
    """
    return in_partitions(df, latest_cycles(df if listing is None else listing))


def superseded(df: DataFrame) -> DataFrame:
    """Every (region, model, cycle) but the current one — what retention removes."""
    cycles = df.select("region", "model", "cycle").distinct()
    return cycles.join(latest_cycles(cycles), PARTS, "left_anti")


def apply_retention(spark: SparkSession, src: str, dst: str) -> str:
    """K7 on storage: make ``dst`` the current cycles of ``src`` and nothing
    else.  Only their partitions are read: the latest cycles come from the
    listing, are written as a table of known size and prune the scan."""
    path = work_path(spark, "current")
    latest_cycles(partition_listing(spark, src)).write.parquet(path)
    write_table(in_partitions(read_table(spark, src), spark.read.parquet(path)), dst, replace="static")
    return dst


def to_reference_scales(scales: DataFrame) -> DataFrame:
    """K2 in the reference's CSV layout: ``cat_id`` printed as a float
    (``11111.0``), then ``cum_mean, mean, max``."""
    keys = [k for k in ("region", "model", "cycle") if k in scales.columns]
    return scales.select(*keys, F.col("cat_id").cast("double").alias("cat_id"), "cum_mean", "mean", "max")
