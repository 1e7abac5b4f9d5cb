"""Gapless positions over a whole table without a single-task window."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textgate.session import materialise


def with_position(df: DataFrame, order: list[str | Column], name: str = "position") -> DataFrame:
    """``df`` plus ``name``: its 0-based place in ``order``, over the whole table.

    The rows are range-partitioned by ``order`` and sorted inside the partitions; each row's place
    is its place in its partition plus the rows of the partitions before. Only one count per
    partition is summed up over all. The numbered rows are written once, so that the range
    boundaries (which Spark samples) are the same for the counts and the rows. ``order`` should be
    unique; equal rows get their numbers in no defined order.
    """
    part, low = (f"_{p}_{uuid.uuid4().hex[:8]}" for p in ("part", "low"))
    # the low 33 bits of monotonically_increasing_id count the rows of a partition
    numbered = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(low, F.monotonically_increasing_id())
        .withColumn(part, F.shiftright(low, 33)).withColumn(low, F.col(low).bitwiseAND((1 << 33) - 1)), "ranked")
    # one row per partition: a window over these is small whatever the table's size
    before = numbered.groupBy(part).agg(F.count("*").alias("_n")).select(
        part, F.coalesce(F.sum("_n").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        .alias("_before"))
    return numbered.join(F.broadcast(before), part) \
        .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col(low)).alias(name))
