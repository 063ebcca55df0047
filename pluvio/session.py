"""Session helpers: configuration for scale, UTC, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings the library relies on.  AQE re-plans joins at runtime: a join side
# whose *measured* shuffle output is below the broadcast threshold becomes a
# broadcast-hash join, anything larger stays a sort-merge join, and skewed
# partitions are split.  That is the size check behind every join in this
# package: no table is broadcast by hint.
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "pluvio",
                  shuffle_partitions: int | None = None, **extra) -> SparkSession:
    """Create (or get) a session with the library's settings.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update({k: str(v) for k, v in extra.items()})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All time logic is defined in UTC (forecast cycles are UTC)."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    On a cluster this names shared storage and is always read from the
    session; without it there is no folder that all executors see, and this
    raises.  Only a ``local`` master (tests) gets a folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pluvio-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/pluvio/{name}-{uuid.uuid4().hex[:12]}"


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType | str):
    """A table of values given in the program.  It is handed over as an Arrow
    table, which Spark keeps as a local relation: its size is known to the
    planner, so joins with it are broadcast by measured bytes, without a hint."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), schema)


def read_parquet_or_none(spark: SparkSession, path: str, schema=None):
    """A Parquet table at ``path`` on any storage Spark reads, or ``None``
    when nothing is there yet (no local file-system checks)."""
    from pyspark.errors import AnalysisException
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        df = r.parquet(path)
        df.schema  # resolves the path
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
