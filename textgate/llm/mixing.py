"""Mixing sources to target weights with hash-threshold histograms, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textgate.ranking import with_position
from textgate.session import materialise

#: Bits of the hash, and bits that one histogram resolves.
HASH_BITS, LEVEL_BITS = 60, 12
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2


def size_of(text: str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in the text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def stable_hash(key: str) -> Column:
    """60 bits of the MD5 of the key as text (null: the empty text), as a non-negative bigint."""
    hexed = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(hexed, 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with target: weights repeat over the sources by code point,
    null last, and share out ``share`` times all sizes; a target stops at ``most`` times its
    source's size and the excess is shared again by weight.

    Each round sends three sums to the driver; a round caps at least one more source.
    """
    ordered = with_position(sources, [F.col("source").isNull(), F.col("source")], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = materialise(ordered.select("source", "source_size", weight.alias("weight"), (most * F.col("source_size")).alias("cap")), "weights")
    budget = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    per_weight, full = 0.0, 0
    while True:
        is_full = F.col("cap") <= F.lit(per_weight) * F.col("weight")
        capped, free, n = weighed.agg(F.coalesce(F.sum(F.when(is_full, F.col("cap"))), F.lit(0)),
                                      F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0.0)),
                                      F.count_if(is_full)).first()
        if not free or (per_weight and n == full):
            break
        per_weight, full = (budget - capped) / free, n
    return weighed.withColumn("target", F.least(F.col("cap").cast("double"), F.lit(float(per_weight)) * F.col("weight")))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``budgets`` (source, whole, budget) with below and upto: rows (source, size, h) of a source
    with h < below, or h <= upto, sum up to its budget as nearly as their hashes allow.

    Level by level, sizes are summed by source and the next bits of the hash; the running sum
    over at most 4,096 buckets finds the one that crosses the budget, and only its rows go into
    the next histogram. After the last bits, the rows of the one crossing hash are taken when
    that comes nearer to the budget. Nothing is sorted but a source's buckets.
    """
    state = budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("taken"))
    shift, crossed = HASH_BITS, None
    while shift:
        shift -= LEVEL_BITS
        here = rows.alias("r").join(state.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))
                                    & (F.shiftright("r.h", shift + LEVEL_BITS) == F.col("s.prefix")))
        histogram = here.groupBy("s.source", "s.budget", "s.taken", F.shiftright("r.h", shift).alias("bucket")) \
            .agg(F.sum("r.size").alias("size"))
        upto = F.sum("size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
        crossed = histogram.withColumn("end", F.col("taken") + upto).filter("end > budget") \
            .groupBy("source", "budget").agg(F.min(F.struct("bucket", "size", "end")).alias("x")) \
            .select("source", "budget", F.col("x.bucket").alias("prefix"), (F.col("x.end") - F.col("x.size")).alias("taken"),
                    F.col("x.end").alias("end"))
        state = crossed = materialise(crossed, "thresholds")
    whole = F.lit(1 << HASH_BITS).cast("long")  # no bucket crosses: the budget holds every row
    nearer = F.col("end") - F.col("c.budget") < F.col("c.budget") - F.col("taken")
    return budgets.alias("b").join(crossed.alias("c"), F.col("b.source").eqNullSafe(F.col("c.source")), "left").select(
        "b.*", F.coalesce(F.when(nearer, F.col("prefix") + 1).otherwise(F.col("prefix")), whole).alias("below"))


def _cuts(rows: DataFrame, weights: tuple[float, ...], share: float, most: int) -> DataFrame:
    """Per source of ``rows`` (source, size, h): ``of`` (the source), source_size, target, times, below."""
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = materialise(goal.withColumn("times", times).withColumn("budget", F.col("target") - F.col("times") * F.col("source_size")), "targets")
    return materialise(thresholds(rows, goal).select(F.col("source").alias("of"), "source_size", "target", "times", "below"), "cuts")


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return materialise(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_of(text_col).alias("size"),
                                   stable_hash(id_col).alias("h")), "sizes")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, source, size, source_size, target, taken.

    A source whose target is up to its size takes the documents below a hash threshold once. One
    with a larger target takes every document (target div size) times, and those below a
    threshold once more; taken = size times those. The hash is of the id alone, so reruns agree
    and the selections for growing targets are nested. Rows that repeat an id are taken or left
    together. Null and empty texts have size 0. Null sources are a source of their own, the last.
    An empty table gives an empty one. Texts are read once; all else works on (id, source, size, hash).
    """
    rows = _sizes(docs, id_col, text_col, source_col)
    cut = _cuts(rows, weights, share, most)
    return rows.join(cut, rows["source"].eqNullSafe(cut["of"])).select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target",
        (F.col("size") * (F.col("times") + (F.col("h") < F.col("below")).cast("long"))).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as ``mix`` takes it.

    The thresholds, a row per source, meet the documents where they are: no text is shuffled.
    """
    cut = _cuts(_sizes(docs, id_col, text_col, source_col), weights, share, most).select(
        F.struct("of", "times", "below").alias("_cut"))
    copies = F.col("_cut.times") + (stable_hash(id_col) < F.col("_cut.below")).cast("long")
    return docs.join(cut, docs[source_col].eqNullSafe(cut["_cut.of"])) \
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select(*[docs[f"`{c}`"] for c in docs.columns])


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
  FROM d GROUP BY source),
total AS (SELECT 1.5::DOUBLE * sum(source_size) AS budget FROM s),
-- sources by the share per weight at which they are full; the level is the first that the sources not yet full do not reach
f AS (
  SELECT *, 2 * source_size / weight AS full_at,
         coalesce(sum(2 * source_size) OVER w, 0)::DOUBLE AS capped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS free
  FROM s WINDOW w AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT min_by((budget - capped) / free, full_at) FILTER (WHERE (budget - capped) / free < full_at) AS share_per_weight FROM f, total),
t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce(share_per_weight, 0) * weight) AS target FROM s, level),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM t),
c AS (
  SELECT d.*, source_size, target, times, target - times * source_size AS budget,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (size * (times + CASE WHEN upto <= budget OR (upto - own <= budget AND upto - budget < budget - (upto - own))
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
