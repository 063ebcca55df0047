"""Grids and weights stored side by side: bucketed by cell (K5 for runs that repeat).

A grid written with ``write_cells`` and weights written with
``write_cell_weights`` into the same number of buckets lie in files by the hash
of (region, model, row, col).  The window of the de-accumulation, the test for
covered cells and the weights join all group by the cell, so none of them moves
the grid: only the statistics are shuffled.  Spark plans this by the table's
bucket specification, kept in the catalog; ``register`` puts a stored table into
a new session's catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions.timefmt import STAMP, fmt, parse_stamp

CELL = ["region", "model", "row", "col"]


def _save(df: DataFrame, name: str, path: str, buckets: int, partition_by: list[str]) -> None:
    # one file for each bucket and partition
    w = (df.repartition(buckets, *CELL).sortWithinPartitions(*partition_by, *CELL).write.mode("overwrite").format("parquet")
         .option("path", path).bucketBy(buckets, *CELL).sortBy(*CELL))
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)


def write_cells(grid: DataFrame, name: str, path: str, buckets: int = 64) -> DataFrame:
    """A grid table partitioned by cycle and bucketed by cell; returns it as read back."""
    _save(grid.withColumn("cycle", fmt("cycle", STAMP)), name, path, buckets, ["cycle"])
    return read_cells(grid.sparkSession, name)


def read_cells(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).withColumn("cycle", parse_stamp(F.col("cycle")))


def write_cell_weights(weights: DataFrame, name: str, path: str, buckets: int = 64) -> DataFrame:
    """Cell weights in the buckets of a grid; returns them as read back."""
    _save(weights, name, path, buckets, [])
    return weights.sparkSession.table(name)


def register(spark: SparkSession, name: str, path: str, schema: str, buckets: int = 64, partitioned: bool = True) -> None:
    """A stored bucketed table in this session's catalog.  ``schema`` is its DDL
    as written, the partition column ``cycle string`` included."""
    by = "PARTITIONED BY (cycle)" if partitioned else ""
    keys = ", ".join(f"`{c}`" for c in CELL)
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet {by} CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")
