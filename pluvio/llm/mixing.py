"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Every source gets a token budget (its target).  As many complete epochs as fit
come first: each of the source's documents is taken that often.  What is left
of the budget is filled by a weighted random sample without replacement: a
document of quality weight w draws the exponential key -ln(u) / w, the source
is read in the order of keys, and a running total of sizes decides where the
budget ends.

Running totals are split: keys are cut into buckets by a fixed increasing
function of the key, each bucket is summed and the sums are added up per
source, so no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pluvio.llm.common import buckets_for, materialise, source_key, unit_hash, word_count

#: Weights of the sources in code point order, repeating.
SOURCE_WEIGHTS = (1, 2, 3)
#: A source is read at most so often.
MAX_EPOCHS = 3


def quality_weight(text: Column, size: Column) -> Column:
    """Weight of a document in the draw, 0.25 to 2: falls with the share of
    mark-up symbols and with the distance of the mean word length from 6."""
    chars = F.length(text).cast("double")
    symbols = chars - F.length(F.translate(text, "#*$%&|<>", ""))
    mean = chars / F.greatest(size, F.lit(1))
    return F.when(F.coalesce(chars, F.lit(0.0)) == 0, F.lit(0.25)).otherwise(
        F.least(F.lit(2.0), F.greatest(F.lit(0.25), F.lit(2.0) - F.abs(mean - 6.0) / 6.0 - symbols * 20.0 / chars)))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sk, source_size, target`` for each source from rows of ``sk, size``.

    The sum of all sizes is shared by weight; a target stops at three times
    its source's size and the excess is shared again by weight until no target
    is above.  That ends where ``target = min(cap, level * weight)`` for one
    level, found here by a running sum over the sources in the order in which
    they reach their caps.  The windows see one row for each source.
    """
    n = len(SOURCE_WEIGHTS)
    whole = W.partitionBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weights = F.element_at(F.array(*[F.lit(float(w)) for w in SOURCE_WEIGHTS]), F.col("i") % n + 1)
    src = (sizes.groupBy("sk").agg(F.sum("size").alias("source_size"))
           .withColumn("i", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("sk")) - 1)
           .withColumn("w", weights)
           .withColumn("total", F.sum("source_size").over(whole).cast("double"))
           .withColumn("cap", F.col("source_size").cast("double") * MAX_EPOCHS)
           .withColumn("full_at", F.col("cap") / F.col("w")))
    by_cap = W.partitionBy(F.lit(0)).orderBy("full_at", "sk")
    src = (src.withColumn("capped", F.sum("cap").over(by_cap.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("cap"))
           .withColumn("open", F.sum("w").over(by_cap.rowsBetween(W.currentRow, W.unboundedFollowing)))
           .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
           .withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(whole)))
    return src.select("sk", "source_size", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def mix_sources(docs: DataFrame, seed: int = 29, buckets: int | None = None) -> DataFrame:
    """``doc_id, source, text_md5, size, source_size, target, taken`` for every row of ``docs``.

    ``taken`` is the number of words the mix takes from the row: its size once
    for each complete epoch, and once more if the sample holds it.  The
    document that the end of the budget cuts is taken if that comes nearer to
    the target.  Sources with no words have target 0; empty and null texts
    have size 0 and are taken 0 times.  A null source is a source of its own.
    Rows equal in id and text have equal keys and follow one another in either
    order.  Keys come from a seeded digest, so reruns agree.  An empty table
    gives no rows.
    """
    b = buckets or buckets_for(docs.sparkSession)
    rows = docs.select("doc_id", "source", "text", word_count(F.col("text")).alias("size"),
                       source_key(F.col("source")).alias("sk"),
                       F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_md5"))
    u = unit_hash(F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_md5").cast("binary")))
    rows = rows.withColumn("key", -F.log(u) / quality_weight(F.col("text"), F.col("size"))).drop("text")
    # 1 - exp(-key) spreads the keys of weight 1 evenly and never reverses two keys
    rows = rows.withColumn("b", F.least(F.floor((1 - F.exp(-F.col("key"))) * b), F.lit(b - 1)).cast("int"))
    rows = materialise(rows, "mix-sizes")                 # texts are read once

    per = W.partitionBy("sk").orderBy("b").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = rows.groupBy("sk", "b").agg(F.sum("size").alias("s"))
    budget = (sums.withColumn("before", F.sum("s").over(per) - F.col("s")).drop("s")
              .join(source_targets(sums.select("sk", F.col("s").alias("size"))), "sk")
              .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
              .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    run = F.sum("size").over(W.partitionBy("sk", "b").orderBy("key", "doc_id", "size", "text_md5")
                             .rowsBetween(W.unboundedPreceding, W.currentRow))
    drawn = (rows.withColumn("run", run).join(budget, ["sk", "b"])
             .withColumn("end", F.col("before") + F.col("run"))
             .withColumn("begin", F.col("end") - F.col("size")))
    sampled = (F.col("begin") < F.col("rest")) & (F.col("end") - F.col("rest") <= F.col("rest") - F.col("begin"))
    sampled = sampled | (F.col("end") <= F.col("rest"))
    return drawn.select(
        "doc_id", "source", "text_md5", "size", "source_size", "target",
        (F.col("size") * (F.col("epochs") + F.when(sampled & (F.col("size") > 0), 1).otherwise(0))).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = 29) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken,
    with all their columns.  Rows with no words cannot count towards any
    target and leave."""
    times = (mix_sources(docs, seed).filter("taken > 0")
             .select(F.col("doc_id").alias("mix_id"), "text_md5", F.col("source").alias("mix_source"),
                     F.expr("int(taken div size)").alias("times"))
             .groupBy("mix_id", "text_md5", "mix_source").agg(F.sum("times").alias("times")))
    # rows equal in id, text and source share their copies: one of them carries all
    whole = docs.select(F.struct("*").alias("r"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_md5"))
    one = W.partitionBy("r.doc_id", "text_md5", "r.source").orderBy(F.xxhash64("r"))
    whole = whole.withColumn("one", F.row_number().over(one)).filter("one = 1")
    on = F.col("r.doc_id").eqNullSafe(F.col("mix_id")) & (whole["text_md5"] == times["text_md5"]) & F.col("r.source").eqNullSafe(F.col("mix_source"))
    return (whole.join(times, on).select("r", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
            .select("r.*"))
