"""One registered query for each operator, over whole tables.

A query calls its operator with production parameters and derives the columns
it returns from the operator's output.  ``SQL`` holds DuckDB SQL for the same
rows where SQL can express them on whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import (ann, byte_bpe, hard_negatives, language_id, line_dedup, mixing, near_dup, periodic_runs, quality_rules,
                        sharding, suffix_dedup, token_counts, toxicity)
from pluvio.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f
    return put


N_SHARDS = 16

@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.interleaved_shards(table(spark, sf_dir, "documents"), N_SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk
  FROM documents),
q AS (
  SELECT *, md5(t) AS h, length(t)::DOUBLE AS chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::DOUBLE AS symbols FROM d),
k AS (
  SELECT doc_id, size, sk, h,
         -ln((('0x' || left(md5('29:' || coalesce(doc_id::VARCHAR, 'null') || ':' || h), 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
         / CASE WHEN chars = 0 THEN 0.25 ELSE least(2.0, greatest(0.25,
               2.0 - abs(chars / greatest(size, 1) - 6.0) / 6.0 - symbols * 20.0 / chars)) END AS key
  FROM q),
s AS (SELECT sk, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY sk) - 1 AS i FROM k GROUP BY sk),
c AS (
  SELECT sk, source_size, [1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE][(i % 3 + 1)::INT] AS w, source_size::DOUBLE * 3 AS cap,
         sum(source_size) OVER ()::DOUBLE AS total FROM s),
l AS (
  SELECT *, (total - (sum(cap) OVER (ORDER BY cap / w, sk ROWS UNBOUNDED PRECEDING) - cap))
            / sum(w) OVER (ORDER BY cap / w, sk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM c),
g AS (
  SELECT sk, source_size,
         least(cap, max(CASE WHEN lev <= cap / w THEN lev END) OVER () * w) AS target FROM l),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM g),
r AS (
  SELECT k.*, source_size, target, epochs, target - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY k.sk ORDER BY key, doc_id, size, h ROWS UNBOUNDED PRECEDING)::BIGINT AS e
  FROM k JOIN b USING (sk))
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN size > 0 AND (e <= rest OR (e - size < rest AND e - rest <= rest - (e - size)))
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


@query("op2_mixing", OP2_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_minhash_near_dedup")
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def encoding_digests(docs: DataFrame) -> DataFrame:
    """Digests of every text's token ids and of what they decode to."""
    out = byte_bpe.decode(byte_bpe.encode(docs))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op4_byte_level_bpe")
def op4_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_digests(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "removed_lines", "removed_chunks", "text")


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text before and after a revision that touches it in
    three places: some characters replaced, a line break put in, the first
    character taken out."""
    n = F.coalesce(F.length("text"), F.lit(0))
    edit = lambda at, length, new: F.struct(at.cast("int").alias("at"), F.lit(length).alias("len"), F.lit(new).alias("new"))
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.array(
        edit(F.floor(n / 3), 7, " revised "), edit(F.floor(n / 3 * 2), 0, "\n"), edit(F.lit(0), 1, "")).alias("edits"))
    return token_counts.edited_counts(rows)


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = language_id.identify(table(spark, sf_dir, "documents"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
n AS (SELECT *, row_number() OVER () AS rid FROM d),
grams AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM n WHERE len(w) > 3),
keys AS (SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS g FROM grams),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM keys) WHERE c > 1),
cover AS (SELECT rid, count(DISTINCT p) AS c FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c, 0) AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(w, lambda x: list_contains([{stop}], lower(x)))) AS n_stop
  FROM n LEFT JOIN cover USING (rid)),
f AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND {rules} AS kept
FROM f
"""
_MEASURE_SQL = {
    "mean_word_chars": "word_chars / greatest(n_words, 1)", "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "stop_share": "n_stop / greatest(n_words, 1)", "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
}


def _rules_sql() -> str:
    parts = [f"{_MEASURE_SQL[r.measure]} {op} {float(b)}::DOUBLE"
             for r in quality_rules.RULES for op, b in ((">=", r.low), ("<=", r.high)) if b is not None]
    return " AND ".join(parts)


@query("op9_quality_rules", OP9_SQL.replace("{stop}", ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS))
       .replace("{rules}", _rules_sql()))
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"))
    return out.select(F.col("r.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


@query("op10_approximate_nearest_neighbours")
def op10_approximate_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@query("op11_suffix_array_dedup")
def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(periodic_runs.with_cycles(table(spark, sf_dir, "documents")))
    # the longest run; among equals the smallest start, then period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.l").alias("length"),
                    (-F.col("best.p")).alias("period"), F.expr("floor(1000 * best.l / -best.p)").cast("long").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


@query("op13_hard_negatives")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(hard_negatives.quantised(vectors, label=label))
