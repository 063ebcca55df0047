"""Incremental cycle ingestion with Structured Streaming.

New grid files land in a folder partitioned by ``region/model/cycle``.  A
file stream with ``availableNow`` processes each file exactly once (the
checkpoint replaces the reference's timestamp file).  A micro-batch reads its
own rows and nothing else of the landing folder: a running total is differenced
from the cell's last one, which an earlier batch has kept as state.

Beside the results stand three tables, partitioned by batch:

* ``totals/``  each cell's last running total, for the cycles a batch touched;
* ``steps/``   the steps that a batch brought;
* ``staged/``  the statistics of these steps.

A cycle whose expected steps are all there is published: its staged statistics
(one row per catchment and step, no grid) are copied to the results.

Steps may come late.  Where a batch brings a step that is not after all those
seen of its cycle, the differences of later steps change; that cycle is read
whole from the landing folder and its statistics are staged anew, all of them
as of this batch.  What a later batch staged of a step counts.

A batch that is run again after a failure finds the tables as they were: it
reads only what earlier batches wrote, and overwrites what it had written
itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.functions.timefmt import STAMP, fmt, parse_stamp
from pluvio.operators.cycles import record_runs
from pluvio.operators.grid import complete_cycles, deaccumulate, deaccumulate_from, step_manifest
from pluvio.operators.zonal import covered_cells, round_stats, zonal_stats
from pluvio.plans.catalog import MODELS, models_df
from pluvio.plans.workflow import subset
from pluvio.session import ensure_utc, read_parquet_or_none, work_path
from pluvio.sources.sinks import PARTS, in_partitions, read_table, write_table

LANDING_SCHEMA = T.StructType([
    T.StructField("step_h", T.IntegerType()),
    T.StructField("valid_time", T.TimestampType()),
    T.StructField("var", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("row", T.IntegerType()),
    T.StructField("col", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("region", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("cycle", T.StringType()),
])

BATCH = "batch"
TABLES = {
    "totals": "row int, col int, valid_time timestamp, value double, batch long, region string, model string, cycle string",
    "steps": "step_h int, valid_time timestamp, n_cells long, batch long, region string, model string, cycle string",
    "staged": ("step_h int, valid_time timestamp, cat_id long, count long, max double, mean double, "
               "batch long, region string, model string, cycle string"),
}


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("cycle", parse_stamp(F.col("cycle")))


def _kept(session: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = work_path(session, name)
    df.write.parquet(path)
    return session.read.parquet(path)


class _State:
    """The tables of a stream as one batch sees them.  ``steps`` is written last
    and tells which batch holds the last word on a cycle and on a step."""

    def __init__(self, spark: SparkSession, root: str, batch: int):
        self.spark, self.root, self.batch = spark, root, batch

    def read(self, name: str, cycles: DataFrame, upto: int) -> DataFrame:
        """What batches up to ``upto`` wrote for ``cycles``: batch and cycle are
        partitions, so nothing else is opened."""
        found = read_parquet_or_none(self.spark, f"{self.root}/{name}", TABLES[name])
        if found is None:
            found = self.spark.createDataFrame([], TABLES[name])
        return in_partitions(_typed(found.filter(F.col(BATCH) <= upto)), cycles)

    def latest(self, cycles: DataFrame, key: list[str], upto: int) -> DataFrame:
        """The batch that holds the last word on each ``key``, as a written table:
        its size is known, so joins with it are broadcast and never move a cycle's
        totals or statistics to one task."""
        by = self.read("steps", cycles, upto).groupBy(*key).agg(F.max(BATCH).alias(BATCH))
        return _kept(self.spark, by, "latest")

    def last_totals(self, cycles: DataFrame) -> DataFrame:
        """Each cell's last running total before this batch."""
        by = self.latest(cycles, PARTS, self.batch - 1)
        return self.read("totals", cycles, self.batch - 1).join(by, [*PARTS, BATCH], "left_semi").drop(BATCH)

    def statistics(self, cycles: DataFrame) -> DataFrame:
        """The statistics of every step, this batch's included."""
        key = [*PARTS, "step_h", "valid_time"]
        by = self.latest(cycles, key, self.batch)
        return self.read("staged", cycles, self.batch).join(by, [*key, BATCH], "left_semi").drop(BATCH)

    def write(self, name: str, df: DataFrame) -> None:
        write_table(df.withColumn(BATCH, F.lit(self.batch).cast("long")), f"{self.root}/{name}", [BATCH, *PARTS])


def ingest(spark: SparkSession, landing: str, results_path: str, checkpoint: str,
           weights: DataFrame, model_specs: dict | None = None,
           max_files_per_trigger: int = 64, runs_path: str | None = None,
           catchments: DataFrame | None = None, grid_def: DataFrame | None = None,
           regions: DataFrame | None = None, state_path: str | None = None):
    """Run the stream until all landed files are processed; returns the query.

    Only the rain variable at the surface, and with ``grid_def`` and
    ``regions`` only the cells of the region's box, reach the statistics.
    With ``runs_path`` each micro-batch appends to the state table (K6), as
    its last action, the cycles whose results it has written, and no others.
    ``state_path`` (default: beside the checkpoint) holds the stream's tables.
    """
    ensure_utc(spark)
    specs = model_specs or MODELS
    mdf = models_df(spark, specs)
    running = [m.name for m in specs.values() if m.accumulation == "running"]
    state_root = state_path or f"{checkpoint.rstrip('/')}-state"

    def batch(df: DataFrame, epoch_id: int) -> None:
        session = df.sparkSession
        state = _State(session, state_root, epoch_id)
        boxes = regions if grid_def is not None else None
        # the one read of the new files
        new = _kept(session, subset(_typed(df), grid_def, boxes), "new-steps")
        manifest = _kept(session, step_manifest(new), "manifest")
        touched = manifest.select(*PARTS).distinct()
        seen = state.read("steps", touched, epoch_id - 1).groupBy(*PARTS).agg(F.max("valid_time").alias("seen"))
        late = _kept(session, manifest.join(seen, PARTS).filter(F.col("valid_time") <= F.col("seen")).select(*PARTS).distinct(), "late")

        # steps in order: differences from the cells' last totals
        in_order = new.join(late, PARTS, "left_anti")
        run = covered_cells(in_order.filter(F.col("model").isin(running)), weights)
        cell = [*PARTS, "row", "col"]
        increments, totals = deaccumulate_from(run, state.last_totals(touched))
        # late steps: their cycles whole
        whole = subset(_typed(in_partitions(session.read.schema(LANDING_SCHEMA).parquet(landing),
                                            late.withColumn("cycle", fmt("cycle", STAMP)))), grid_def, boxes)
        whole_run = covered_cells(whole.filter(F.col("model").isin(running)), weights)
        again = step_manifest(whole)
        grid = (in_order.filter(~F.col("model").isin(running)).unionByName(increments)
                .unionByName(whole.filter(~F.col("model").isin(running))).unionByName(deaccumulate(whole_run)))
        steps = manifest.join(late, PARTS, "left_anti").unionByName(again)
        state.write("staged", zonal_stats(grid, weights, catchments=catchments, steps=steps))
        whole_last = whole_run.groupBy(*cell).agg(F.max("valid_time").alias("valid_time"), F.max_by("value", "valid_time").alias("value"))
        state.write("totals", totals.join(late, PARTS, "left_anti").unionByName(whole_last))
        state.write("steps", steps)

        # complete cycles are published from the staged statistics
        ready = _kept(session, complete_cycles(state.read("steps", touched, epoch_id), mdf).select(*PARTS), "ready")
        write_table(round_stats(state.statistics(ready)), results_path)
        if runs_path is not None:
            record_runs(session, ready, runs_path)

    stream = (spark.readStream.schema(LANDING_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(landing))
    q = (stream.writeStream.foreachBatch(batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_results(spark: SparkSession, results_path: str) -> DataFrame:
    return read_table(spark, results_path)
