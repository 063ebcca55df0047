"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.session import work_path

#: A word: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of an Arrow batch on its way to a Python worker: with long texts the
#: default of 64 MB stands several times in each worker and its executor.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each context, the way
    ``--py-files`` does: Spark's own file server carries it to the executors.
    Arrow batches are kept small, unless the cluster has set their size."""
    sc = spark.sparkContext
    if sc.getConf().get(BATCH_BYTES[0]) is None:
        spark.conf.set(*BATCH_BYTES)
    if getattr(sc, "_pluvio_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.TemporaryDirectory(prefix="pluvio-ship-")      # the file server reads from here until the end
    path = os.path.join(folder.name, "pluvio_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(at, n), os.path.relpath(os.path.join(at, n), os.path.dirname(top)))
    sc.addPyFile(path)
    sc._pluvio_shipped = folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts the lineage
    with files that outlive any executor."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)      # texts shrink by a third more
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of a text as long; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A never-null string that sorts sources by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def unit_hash(hex_text: Column) -> Column:
    """The first 13 hex digits of a digest as a double strictly between 0 and 1."""
    return (F.conv(F.substring(hex_text, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def buckets_for(spark: SparkSession, least: int = 64) -> int:
    """Parts that a rank or prefix sum of one source is split into.  Follows
    ``spark.sql.shuffle.partitions``, the setting a cluster sizes to its data."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def learning_row(doc_id: Column) -> Column:
    """Rows a model may learn from: crc32 of the id's decimal text, modulo 5, is not 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1000, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows and about ``size`` bytes, so
    that what a Python worker holds does not follow the length of the texts."""
    for b in batches:
        at = 0
        step = max(1, min(rows, int(b.num_rows * size / max(1, b.nbytes))))
        while at < b.num_rows:
            yield b.slice(at, step)
            at += step
