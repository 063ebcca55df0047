"""Forecast cycles: steps, availability, state.

The reference keeps one timestamp file per model and decides from the wall
clock.  Here cycle state is a table ``runs(region, model, cycle, state,
updated_at)`` (state ``'done'`` or ``'clobbered'``) and every decision is a
join.  The region is part of the key: a cycle that is complete in one region
and late in another is done in the first and pending in the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.functions.timefmt import add_hours, cycle_label, utc_day, utc_hour
from pluvio.plans.catalog import MODELS

RUN_KEYS = ["region", "model", "cycle"]


def step_expansion(cycles: DataFrame, models_df: DataFrame) -> DataFrame:
    """Each (model, cycle) -> its forecast steps and valid times."""
    m = models_df.select("model", "step_start", "step_inc", "n_steps")
    j = cycles.join(m, ["model"], "inner")
    last = F.col("step_start") + (F.col("n_steps") - 1) * F.col("step_inc")
    j = j.withColumn("step_h", F.explode(F.sequence("step_start", last, "step_inc")))
    return (j.withColumn("valid_time", add_hours(F.col("cycle"), F.col("step_h")))
            .drop("step_start", "step_inc", "n_steps"))


def _model_array(models: dict):
    return F.array(*[F.struct(F.lit(m.name).alias("model"),
                              F.array(*[F.lit(h) for h in m.cycle_hours]).alias("hours"),
                              F.lit(m.ready_lag_h).alias("lag"))
                     for m in models.values()])


def latest_cycle(times: DataFrame, ts: str = "ts", models: dict | None = None) -> DataFrame:
    """For each clock time, each model's latest available cycle.

    A cycle at hour h is taken once the clock is past ``h + lag``; before the
    first one of the day, yesterday's last cycle.  The model list is the
    registry (a literal array), so no join is needed.
    """
    models = models or MODELS
    t = times.withColumn("_m", F.explode(_model_array(models)))
    hour = utc_hour(ts)
    ready = F.filter(F.col("_m.hours"), lambda h: hour > h + F.col("_m.lag"))
    day = F.unix_date(utc_day(ts)).cast("long") * 24
    cycle = F.timestamp_seconds(F.when(F.size(ready) > 0, day + F.array_max(ready))
                                .otherwise(day - 24 + F.array_max(F.col("_m.hours"))) * 3600)
    return t.withColumn("model", F.col("_m.model")).withColumn("cycle", cycle).drop("_m")


def missing_steps(expected: DataFrame, arrived: DataFrame,
                  keys: tuple = ("model", "cycle", "step_h")) -> DataFrame:
    """Expected steps that have not arrived."""
    k = [c for c in keys if c in expected.columns and c in arrived.columns]
    return expected.join(arrived.select(*k).distinct(), k, "left_anti")


def run_state(runs: DataFrame) -> DataFrame:
    """The last recorded state of each (region, model, cycle)."""
    return runs.groupBy(*RUN_KEYS).agg(F.max_by("state", "updated_at").alias("state"))


def pending_cycles(wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """Wanted cycles that still need a run.

    Last state ``'done'`` -> skip; ``'clobbered'`` -> forced re-run; no state
    -> new.  ``reason`` says which.
    """
    st = run_state(runs)
    j = wanted.select(*RUN_KEYS).distinct().join(st, RUN_KEYS, "left")
    return (j.filter(F.col("state").isNull() | (F.col("state") != "done"))
            .select(*RUN_KEYS, F.coalesce(F.col("state"), F.lit("new")).alias("reason")))


def record_runs(spark, done: DataFrame, path: str, state: str = "done") -> None:
    """K6: append the finished cycles to the state table — the job's last action."""
    (done.select(*RUN_KEYS, F.lit(state).alias("state"),
                 F.current_timestamp().alias("updated_at"))
     .write.mode("append").parquet(path))


def cycle_labels(models_df: DataFrame, runs: DataFrame) -> DataFrame:
    """``GFS data from Jun 21, 12PM UTC`` per model, from its last done cycle."""
    st = run_state(runs).filter(F.col("state") == "done")      # done in any region
    last = st.groupBy("model").agg(F.max("cycle").alias("cycle"))
    j = models_df.select("model", "display").join(last, ["model"], "left")
    return j.select("model", cycle_label(F.col("display"), F.col("cycle")).alias("label"))
