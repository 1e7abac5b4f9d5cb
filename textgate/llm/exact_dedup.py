"""Exact dedup against a persistent digest index, bucketed and sorted by digest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.session import materialise, scratch_path

#: Digests a bucket of a fresh index is sized for.
PER_BUCKET = 2_000_000


def normalised(text: str | Column) -> Column:
    """``text`` with each run of ASCII white space as one space; null is empty.

    Only runs that are not already one space are matched, so plain prose costs one scan.
    """
    return F.regexp_replace(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")),
                            r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def buckets_for(rows: int) -> int:
    """Buckets of an index of ``rows`` digests: a power of two, 16 at least."""
    return max(16, 1 << max(0, -(-rows // PER_BUCKET) - 1).bit_length())


class DigestIndex:
    """Digests seen so far, at ``path``, as a Parquet table bucketed and sorted by digest.

    The files are the state. A new session registers the same folder again (the bucket count
    must be the one it was made with) and goes on. ``add`` may be repeated after a failure: rows
    that an earlier try appended are found again and decide the same.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, id_type: str = "bigint") -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id {id_type}, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def add(self, docs: DataFrame, batch: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Decide every row of ``docs`` and append its new digests.

        Returns one row per input row: ``id_col``, keep_id, group_size (rows of this batch with
        that text), kept, digest. keep_id is the id in the index when the text was seen in an
        earlier batch (then no row of this batch is kept), else the batch's smallest id with that
        text. Null texts equal empty ones. Rows that repeat both id and text keep one of them. A
        null id is larger than any other; a group of null ids keeps one row with keep_id null.
        Other columns are not read. An empty table gives an empty one.

        Only (id, digest) pairs are shuffled. A group of copies is pre-aggregated for the
        anti-join; the last join has its rows on one side, which AQE splits when they are skewed.
        """
        rows = docs.select(F.col(id_col).alias("_id"), F.unhex(F.sha2(normalised(text_col), 256)).alias("_digest")) \
            .groupBy("_digest", "_id").agg(F.count("*").alias("_copies"))
        rows = materialise(rows, "digests")
        groups = rows.groupBy("_digest").agg(F.min("_id").alias("_least"), F.sum("_copies").alias("group_size"))
        groups = groups.repartition(self.buckets, "_digest")
        index = self.spark.table(self.table)
        fresh = groups.join(index, groups["_digest"] == index["digest"], "left_anti")
        fresh.select(F.col("_digest").alias("digest"), F.col("_least").alias("keep_id"), F.lit(batch).alias("batch")) \
            .repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        index = self.spark.table(self.table)
        decided = groups.join(index, groups["_digest"] == index["digest"]).select(
            "_digest", "keep_id", "group_size", (F.col("batch") == batch).alias("_own"))
        # written: the digest side of the next join must come from a shuffle for AQE to split a hot digest
        decided = materialise(decided, "decided")
        first = F.col("_own") & F.col("_id").eqNullSafe(F.col("keep_id"))
        return rows.join(decided, "_digest") \
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))) \
            .select(F.col("_id").alias(id_col), "keep_id", "group_size", (first & (F.col("_copy") == 1)).alias("kept"),
                    F.col("_digest").alias("digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``DigestIndex.add`` of the whole table to a new index in the shared scratch folder."""
    spark = docs.sparkSession
    index = DigestIndex(spark, scratch_path(spark, "digest-index"), buckets_for(docs.count()),
                        docs.schema[id_col].dataType.simpleString())
    return index.add(docs, "all", id_col, text_col)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, all columns, each text once."""
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select(
        F.col(id_col).alias("_keep_id"), F.col("digest").alias("_keep_digest"))
    kept = materialise(kept, "kept")
    same = docs[id_col].eqNullSafe(kept["_keep_id"]) \
        & (F.unhex(F.sha2(normalised(docs[text_col]), 256)) == kept["_keep_digest"])
    out = docs.join(kept, same, "left_semi")
    # a repeated id can bring one text in twice; whole rows are compared only where that occurs
    if docs.groupBy(id_col).count().filter("count > 1").limit(1).count():
        own = f"_digest_{uuid.uuid4().hex[:8]}"
        out = out.withColumn(own, F.sha2(normalised(text_col), 256)).dropDuplicates([id_col, own]).drop(own)
    return out


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
