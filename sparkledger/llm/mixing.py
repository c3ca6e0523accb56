"""Mixing sources to target weights (DataFrame operations only).

Every document gets a hash-random key. Within a source, documents are ranged by that key
into buckets; bucket sums, added up in key order, give every document the number of
words before it (a distributed prefix sum: no task ever sorts a whole source). The mix
takes whole epochs while the target allows it and cuts the last epoch at the exact budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, staged, table

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often.
MAX_EPOCHS = 3
KEY_SALT = "mix:"
#: Hex digits of the key that place a document in a bucket.
KEY_DIGITS = 7


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Inclusive running sums over the total order ``order`` of any number of rows.

    Rows are range-partitioned; each range adds the totals of the ranges before it."""
    spark = df.sparkSession
    ranged = staged(df.repartitionByRange(partitions(spark), *order)
                    .withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{k}") for k, c in sums.items()])
    # one row a range: as many as there are shuffle partitions
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0))
                                        .alias(f"_o_{k}") for k in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0)
    own = ranged.select("*", *[F.sum(c).over(inside).alias(f"_s_{k}") for k, c in sums.items()])
    return own.join(F.broadcast(offsets), "_range").select(
        *df.columns, *[(F.col(f"_s_{k}") + F.col(f"_o_{k}")).alias(k) for k in sums])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, documents) -> the same with ``target`` in words.

    Shares follow the weights; a target stops at ``max_epochs`` times its source's size
    and the excess goes to the others by weight, until none is above. With sources in
    order of cap / weight that is one cut: those before it sit at their cap."""
    by_name = [F.col("source").isNull().cast("int"), F.col("source")]
    rank = running(sizes, by_name, {"_rank": F.lit(1).cast("long")})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int") + 1)
    weighed = rank.select("source", "source_size", "documents", weight.cast("long").alias("_w"),
                          (F.col("source_size") * max_epochs).alias("_cap"))
    ratio = F.col("_cap") / F.col("_w")
    ordered = running(weighed.withColumn("_ratio", ratio),
                      [F.col("_ratio"), *by_name],
                      {"_caps": F.col("_cap"), "_ws": F.col("_w")})
    ordered = staged(ordered, "ordered-sources")
    total, weight_sum = ordered.agg(F.sum("source_size"), F.sum("_w")).first()
    total, weight_sum = total or 0, weight_sum or 0
    capped = F.col("_caps") + F.col("_ratio") * (F.lit(weight_sum) - F.col("_ws")) <= F.lit(total)
    marked = ordered.withColumn("_capped", capped)
    used, rest = marked.agg(F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0)),
                            F.sum(F.when(F.col("_capped"), 0).otherwise(F.col("_w")))).first()
    level = (total - used) / rest if rest else 0.0
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")) \
        .otherwise(F.lit(float(level)) * F.col("_w"))
    return staged(marked.select("source", "source_size", "documents", target.alias("target")),
                  "targets")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Words that the mix takes from every document.

    Returns doc_id, source, size, source_size, target, taken, epochs (whole passes over
    the document) and cut (words of the last, partial pass). A null text has 0 words; a
    null source is a source of its own; a null doc_id has a key like any other; rows that
    repeat a doc_id are documents of their own, equal ones interchangeable. An empty table
    gives no rows. Other columns are not read."""
    spark = docs.sparkSession
    hashed = F.md5(F.concat(F.lit(KEY_SALT), F.coalesce(F.col("doc_id").cast("string"),
                                                        F.lit(""))))
    sized = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                               F.col("source").cast("string").alias("source"),
                               word_count(F.col("text")).alias("size"),
                               hashed.alias("_key")), "sizes")
    targets = source_targets(sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents")),
        weights, max_epochs)
    rows = sized.count()
    per_bucket = max(64, math.ceil(rows / (4 * partitions(spark))))
    place = F.conv(F.substring("_key", 1, KEY_DIGITS), 16, 10).cast("long")
    buckets = F.ceil(F.col("documents") / F.lit(per_bucket))
    bucket = F.floor(place * buckets / F.lit(16 ** KEY_DIGITS)).cast("long")
    named = targets.select(F.col("source").alias("_source"), "source_size", "documents", "target")
    # skewed by source; the sources' side is joined as it is, so AQE can broadcast or split
    placed = sized.join(named, sized["source"].eqNullSafe(named["_source"]), "inner") \
        .withColumn("_bucket", bucket)
    group = [F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_n"),
             F.col("_bucket")]
    placed = placed.select("*", *group[:2])
    sums = placed.groupBy("_s", "_n", "_bucket").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_s", "_n").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = staged(sums.select("_s", "_n", "_bucket",
                                 F.coalesce(F.sum("_sum").over(earlier), F.lit(0))
                                 .alias("_offset")), "bucket-offsets")
    inside = Window.partitionBy("_s", "_n", "_bucket") \
        .orderBy("_key", F.col("doc_id"), "size").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("size").over(inside) - F.col("size") + F.col("_offset")
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    left = F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")
    return (placed.join(offsets, ["_s", "_n", "_bucket"])
            .select("doc_id", "source", "size", "source_size", "target",
                    whole.alias("epochs"), before.alias("_before"))
            .withColumn("cut", F.greatest(F.lit(0).cast("long"),
                                          F.least(F.col("size"), left - F.col("_before"))))
            .withColumn("taken", F.col("epochs") * F.col("size") + F.col("cut"))
            .select("doc_id", "source", "size", "source_size", "target", "taken",
                    "epochs", "cut"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat('mix:', coalesce(doc_id::VARCHAR, ''))) AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM sized GROUP BY source),
ratios AS (
  SELECT *, source_size * 3 AS cap, (source_size * 3)::DOUBLE / w AS ratio FROM sources),
running AS (
  SELECT *, sum(cap) OVER o AS caps, sum(w) OVER o AS ws,
         sum(source_size) OVER () AS total, sum(w) OVER () AS wsum
  FROM ratios WINDOW o AS (ORDER BY ratio, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
marked AS (
  SELECT *, caps::DOUBLE + ratio * (wsum - ws)::DOUBLE <= total::DOUBLE AS capped FROM running),
level AS (
  SELECT (max(total) - sum(CASE WHEN capped THEN cap ELSE 0 END))::DOUBLE
         / nullif(sum(CASE WHEN capped THEN 0 ELSE w END), 0)::DOUBLE AS lam FROM marked),
targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE ELSE lam * w::DOUBLE END AS target
  FROM marked, level),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0
              THEN floor(t.target / t.source_size::DOUBLE)::BIGINT ELSE 0 END AS epochs,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id NULLS FIRST, s.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size AS earlier
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size,
          floor(target - (epochs * source_size)::DOUBLE)::BIGINT - earlier)))::BIGINT AS taken
FROM placed
"""
