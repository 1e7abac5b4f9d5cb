"""Sharding by jump consistent hashing: no ring table, and a new shard takes rows only into itself."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textgate.ranking import with_position
from textgate.session import materialise

#: Fixed value: the multiplier of the method's 64-bit linear congruential generator.
MULTIPLIER = 2862933555777941757


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to ``shards`` - 1, of each 64-bit key; all keys jump together."""
    if shards < 1:
        raise ValueError("there must be a shard")
    key = keys.astype(np.uint64)
    shard, live, jump = np.zeros(len(key), np.int64), np.arange(len(key)), np.zeros(len(key), np.int64)
    while len(live):
        shard[live] = jump
        key = key * np.uint64(MULTIPLIER) + np.uint64(1)
        jump = ((jump + 1) * (float(1 << 31) / ((key >> np.uint64(33)) + np.uint64(1)).astype(float))).astype(np.int64)
        on = jump < shards
        live, key, jump = live[on], key[on], jump[on]
    return shard


def key_hash(key: str | Column) -> Column:
    """64 bits of a key that stay the same everywhere: Spark's xxhash64 of the key as text (null: empty)."""
    key = key if isinstance(key, Column) else F.col(key)
    return F.xxhash64(F.coalesce(key.cast("string"), F.lit("")))


def shard_of(key: str | Column, shards: int) -> Column:
    """The shard of a key (any type, as text)."""
    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return jump(key_hash(key))


def shard_manifest(docs: DataFrame, shards: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key_col``, size, text_crc32, law ('key'), shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1, text_crc32 its unsigned CRC-32 (null: the empty text).
    slot counts a shard's rows from 0 without gaps, by key, CRC and size (null keys first; rows
    equal in all three in any order). grown_shard is the shard with one shard more. Null keys are
    one key; repeated keys share a shard. Other columns are not read; an empty table gives an
    empty one. Texts are read once and never shuffled; slots come from a range partitioning of
    (shard, key), so neither a large shard nor a repeated key is one task's work.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(key_col).alias("key"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = materialise(rows.select("*", shard_of("key", shards).alias("shard"), shard_of("key", shards + 1).alias("grown_shard"),
                                   F.monotonically_increasing_id().alias("row")), "shards")
    placed = with_position(rows, ["shard", "key", "text_crc32", "size", "row"])
    before = rows.groupBy("shard").agg(F.count("*").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(before), "shard").select(  # a row per shard
        F.col("key").alias(key_col), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("position") - F.col("before")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int, key_col: str = "doc_id", files: int = 8) -> None:
    """Write whole rows to ``path``/shard=N, in up to ``files`` files a shard; a column named shard is replaced."""
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(files))
    docs.withColumn("shard", shard_of(key_col, shards)).repartition(shards * files, "shard", spread).write.partitionBy("shard").parquet(path)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textgate.plans.fixtures import table

    return shard_manifest(table(spark, sf_dir, "documents"), 16)
