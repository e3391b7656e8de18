"""Mixing sources to target weights with hash-threshold histograms (native: DataFrame functions only).

Every document has a fixed 60-bit hash of its id and text. A source's mix takes every document ``full``
times and those under a hash threshold once more. The threshold comes from nested histograms:
sums of sizes by source and the next 12 bits, of which only the bucket that holds the budget's
boundary is looked into further, so nothing is ever sorted by hash.

Defined cases. Null text: size 0. Null source: a source of its own, ranked last; the empty
string is another source. Rows with equal ids and texts share a hash and are taken or left together. A null id
or text hashes as the empty string. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polyscribe.llm.common import WORD, discard, materialise, table

HASH_BITS, STEP_BITS = 60, 12


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), epochs: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row a source: (src, source_size, target).

    Sources in code-point order (null last) weigh ``weights``, repeating, and share ``epochs`` times
    the sum of all sizes. A target stops at ``cap`` times its source's size and the excess is shared
    again by weight until none is above. Only sums reach the driver.
    """
    per = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    # one row a source, so the ranking window is as small as the list of sources
    rank = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = materialise(per.withColumn("weight", weight), "mix-sources")
    capped = F.lit(cap) * F.col("source_size")
    level, total = 0.0, per.agg(F.sum("source_size")).first()[0] or 0
    while True:
        full = capped < F.col("weight") * F.lit(level)
        spent, open_weight = per.agg(
            F.coalesce(F.sum(F.when(full, capped)), F.lit(0.0)), F.coalesce(F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.lit(0.0))
        ).first()
        higher = (epochs * total - spent) / open_weight if open_weight else level
        if higher <= level:
            break
        level = higher
    return per.select("src", "source_size", F.least(capped, F.col("weight") * F.lit(level)).alias("target"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1), epochs: float = 1.5, cap: float = 2.0,
) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    sizes = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("src"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("/"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))), 1, HASH_BITS // 4), 16, 10).cast("long").alias("h"),
        ),
        "mix-sizes",
    )
    targets = source_targets(sizes, weights, epochs, cap).withColumn(
        "full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    )
    targets = materialise(targets.withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")), "mix-targets")

    state, candidates, used = targets.select("src", "rest", F.lit(0).cast("long").alias("prefix")), sizes.select("src", "size", "h"), []
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        bucket = F.shiftright("h", shift)
        sums = candidates.groupBy("src", bucket.alias("bucket")).agg(F.sum("size").alias("held"))
        before = F.coalesce(F.sum("held").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sums = sums.withColumn("before", before).alias("a").join(state.select("src", "rest").alias("b"), F.col("a.src").eqNullSafe(F.col("b.src")))
        edge = sums.filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("held")))
        state = materialise(edge.select("a.src", (F.col("rest") - F.col("before")).alias("rest"), F.col("bucket").alias("prefix"), "held"), "mix-edge")
        used.append(state)
        narrowed = candidates.alias("a").join(state.select("src", "prefix").alias("b"), F.col("a.src").eqNullSafe(F.col("b.src")) & (bucket == F.col("b.prefix")))
        candidates = narrowed.select("a.src", "a.size", "a.h")
    # the boundary hash itself: taken if that brings the sum nearer to the budget
    bound = state.select("src", (F.col("prefix") + F.when(2 * F.col("rest") >= F.col("held"), 1).otherwise(0)).alias("bound"))
    plan = targets.alias("t").join(bound.alias("b"), F.col("t.src").eqNullSafe(F.col("b.src")), "left").select("t.*", F.coalesce("b.bound", F.lit(0)).alias("bound"))
    plan = materialise(plan, "mix-plan")
    discard(*used, targets)
    return sizes.alias("d").join(plan.alias("p"), F.col("d.src").eqNullSafe(F.col("p.src"))).select(
        "d.doc_id", "d.size", "p.source_size", "p.target",
        (F.col("d.size") * (F.col("p.full") + F.when(F.col("d.h") < F.col("p.bound"), 1).otherwise(0))).alias("taken"),
        F.col("d.src").alias("source"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS weight
  FROM s
), r AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
         row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source) AS k FROM w
), c AS (
  SELECT a.k, a.most / a.weight AS ratio,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM r)::DOUBLE - coalesce((SELECT sum(most) FROM r b WHERE b.k < a.k), 0)::DOUBLE)
           / (SELECT sum(weight) FROM r b WHERE b.k >= a.k) AS level
  FROM r a
), l AS (
  SELECT level FROM c WHERE level <= ratio ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size, least(most, weight * (SELECT level FROM l)) AS target FROM r
), u AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS full_times FROM t
), g AS (
  SELECT source, h, sum(size) AS held, coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d GROUP BY source, h
)
SELECT d.doc_id, d.size, u.source_size, u.target,
       CAST(d.size * (u.full_times + CASE WHEN 2 * (u.target - u.full_times * u.source_size - g.before) >= g.held THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       d.source
FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source
JOIN g ON d.source IS NOT DISTINCT FROM g.source AND d.h = g.h
"""
