"""One atomic publish over all tables of a run (K1, K2, K6, K7).

With dynamic overwrites each table of a run becomes visible by itself: between
two of them a reader sees new results beside old colour scales.  Here a run
writes every table under a version of its own,

    out/<table>/version=<v>/region=/model=/cycle=

which no reader looks at, and at its end appends one file to ``out/published``:
the cycles it has done, with their version.  That file is the only pointer, for
all tables, and the run state as well.  It appears whole or not at all, so a run
that breaks off between two tables leaves the old snapshot, and a reader who
takes every table by one state of the pointer sees one run of each cycle.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.session import literal_table, read_parquet_or_none
from pluvio.sources.sinks import PARTS, latest_cycles, read_table, write_table

VERSION = "version"
POINTER_SCHEMA = "region string, model string, cycle timestamp, state string, updated_at timestamp, version string"


def new_version() -> str:
    """A name for a run's tables; names sort by time."""
    return datetime.now(timezone.utc).strftime("v%Y%m%dT%H%M%S%f") + uuid.uuid4().hex[:6]


def pointer(spark: SparkSession, out: str) -> DataFrame:
    """All that was ever published: run state rows with their version."""
    found = read_parquet_or_none(spark, f"{out}/published", POINTER_SCHEMA)
    return literal_table(spark, [], POINTER_SCHEMA) if found is None else found


def write_version(df: DataFrame, out: str, table: str, version: str) -> None:
    """A run's rows of one table, not visible yet."""
    write_table(df.withColumn(VERSION, F.lit(version)), f"{out}/{table}", [VERSION, *PARTS])


def read_version(spark: SparkSession, out: str, table: str, version: str) -> DataFrame:
    """What one run wrote of a table, published or not."""
    return read_table(spark, f"{out}/{table}").filter(F.col(VERSION) == version).drop(VERSION)


def publish(done: DataFrame, out: str, version: str, state: str = "done") -> None:
    """Make a version the current one of its cycles, in every table at once.  The
    list of cycles (keys, not data) goes into one file, which is renamed into place."""
    (done.select(*PARTS, F.lit(state).alias("state"), F.current_timestamp().alias("updated_at"), F.lit(version).alias(VERSION))
     .repartition(1).write.mode("append").parquet(f"{out}/published"))


def snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The version that counts for each cycle: ``region, model, cycle, version``.
    A cycle that was marked clobbered later keeps its version until it is redone.
    To read several tables as of one moment, take this once and pass it on."""
    rows = pointer(spark, out).filter(F.col("state") == "done")
    return rows.groupBy(*PARTS).agg(F.max_by(VERSION, "updated_at").alias(VERSION))


def read_snapshot(spark: SparkSession, out: str, table: str, at: DataFrame | None = None, current: bool = False) -> DataFrame:
    """A table as published: the rows of each cycle's version.  Versions and
    cycles are partitions, so others are not opened.  ``current``: only each
    region's and model's latest cycle (K7)."""
    at = snapshot(spark, out) if at is None else at
    if current:
        at = at.join(latest_cycles(at), PARTS, "left_semi")
    keys = [VERSION, *PARTS]
    return read_table(spark, f"{out}/{table}").join(at.select(*keys).filter(F.col(VERSION) >= F.lit("")), keys, "left_semi").drop(VERSION)


def superseded_versions(spark: SparkSession, out: str, table: str) -> DataFrame:
    """(version, region, model, cycle) of a table that no snapshot shows: redone
    cycles, and runs that broke off.  What a clean-up may remove once no run is
    under way."""
    keys = [VERSION, *PARTS]
    return read_table(spark, f"{out}/{table}").select(*keys).distinct().join(snapshot(spark, out), keys, "left_anti")
