"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order; row r of n (from 1) gets
the fraction (r - 1/2) / n.  Sorting all rows by fraction interleaves the
sources in proportion, so every contiguous cut has the mixture of the whole.
The sorted sequence is cut into ``n_shards`` runs whose row counts differ by
one at most.

No rank is computed over a whole source or table in one task.  The random
order is cut into buckets by its leading digits; ranks inside a bucket are
shifted by the number of rows in earlier buckets.  The second rank, along the
fractions, needs no counting pass: how many rows of a source of n fall below a
fraction is arithmetic on n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pluvio.llm.common import buckets_for, source_key

LAW = "rows"


def interleaved_shards(docs: DataFrame, n_shards: int = 16, seed: int = 17, buckets: int | None = None) -> DataFrame:
    """``doc_id, source, size, text_crc32, shard, slot`` for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus one (null: 1) and ``text_crc32``
    the unsigned CRC-32 of those bytes (null: that of no bytes, 0).  ``slot``
    counts from 0 without gaps in each shard.  Row counts of shards differ by
    one at most; with fewer rows than shards some shards are empty.  A null
    source is a source of its own, sorted last.  The order is that of a digest
    of id and text, so rows without an id, or with one id, spread over all
    buckets.  Rows equal in id and text are interchangeable: they get
    neighbouring ranks in either order.  An empty table gives no rows.
    """
    b = buckets or buckets_for(docs.sparkSession)
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                              F.xxhash64("text").cast("string")).cast("binary"))
    keyed = docs.select(
        "doc_id", "source", source_key(F.col("source")).alias("sk"), order.alias("o"), "text",
    ).withColumn("b", F.conv(F.substring("o", 1, 8), 16, 10).cast("long") * b / F.lit(2 ** 32)) \
     .withColumn("b", F.floor("b").cast("int"))

    # rows of each source before each bucket
    per = W.partitionBy("sk")
    counts = (keyed.groupBy("sk", "b").agg(F.count(F.lit(1)).alias("c"))
              .select("sk", "b",
                      (F.sum("c").over(per.orderBy("b").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("c")).alias("before"),
                      F.sum("c").over(per.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("n")))

    rows = keyed.select(
        "doc_id", "source", "sk", "o", "b",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    inside = F.row_number().over(W.partitionBy("sk", "b").orderBy("o", "doc_id", "text_crc32", "size"))
    ranked = (rows.withColumn("k", inside.cast("long"))
              .join(counts, ["sk", "b"])
              .withColumn("odd", (F.col("before") + F.col("k")) * 2 - 1)          # 2r - 1; the fraction is odd / 2n
              .withColumn("f", F.expr(f"(odd * {b}L) div (2 * n)")))

    # rows below fraction f / b: r <= floor(ceil(2nf / b) / 2) in each source
    starts = (counts.groupBy("sk").agg(F.max("n").alias("n"))
              .select("n", F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("f"))
              .groupBy(F.col("f").cast("long").alias("f"))
              .agg(F.sum(F.expr(f"((2 * n * f + {b - 1}L) div {b}L) div 2")).alias("start"), F.sum("n").alias("total")))
    along = F.row_number().over(W.partitionBy("f").orderBy(F.col("odd") / (F.col("n") * 2.0), "sk", "odd"))
    placed = (ranked.withColumn("j", along.cast("long"))
              .join(starts, "f")
              .withColumn("at", F.col("start") + F.col("j") - 1)
              .withColumn("shard", F.expr(f"(at * {n_shards}L) div total")))
    slot = F.expr(f"at - (shard * total + {n_shards - 1}L) div {n_shards}L")
    return placed.select("doc_id", "source", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), slot.alias("slot"))
