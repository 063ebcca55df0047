"""A long backlog in the scheduled run."""
import dataclasses
import glob

import pytest
from pyspark.sql import functions as F

from pluvio.plans import run_cycles as R
from pluvio.plans.catalog import MODELS, RegionSpec, region_models_df
from pluvio.testing import views as V
from pluvio.testing.suite import _polys

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def backlog(spark):
    def make(n):
        grid = spark.range(n).select(
            F.lit(V.REGION).alias("region"), F.lit("gfs").alias("model"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 21600).alias("cycle"), F.lit(6).alias("step_h"),
            F.timestamp_seconds(F.lit(1704088800) + F.col("id") * 21600).alias("valid_time"),
            F.lit(0).alias("row"), F.lit(1).alias("col"), F.lit(2.5).alias("value"))
        rm = region_models_df(spark, {V.REGION: RegionSpec(V.REGION, "t", 0, 15, -90, 10, ("gfs",))})
        return lambda out: R.run_cycles(spark, grid, _polys(spark, SF), V.grid_def(spark, SF), out, region_models=rm,
                                        model_specs={"gfs": dataclasses.replace(MODELS["gfs"], n_steps=1)})
    return make


def test_key_lists_are_written_by_many_tasks(spark, backlog, monkeypatch):
    """Neither the pending nor the ready keys go through one task."""
    paths, own = {}, R.work_path
    monkeypatch.setattr(R, "work_path", lambda s, name: paths.setdefault(name, own(s, name)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert backlog(40)(own(spark, "many")).count() == 40
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in ("pending", "ready"):
        assert len(glob.glob(f"{paths[name].removeprefix('file:')}/part-*")) > 1, name
