"""Rows by their place in stored files: the order of a table without a key.

A row's place is its file (by path) and its offset there; numbering the places gives positions from 0
without gaps that do not depend on how files are split among tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.ranking import with_position


def read_placed(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The Parquet files below ``path`` plus ``position``: the row's number in file order (files by path)."""
    file, row = (f"_{n}_{uuid.uuid4().hex[:8]}" for n in ("file", "row"))
    df = spark.read.parquet(path)
    placed = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    return with_position(placed, [file, row], position).drop(file, row)


def first_rows(df: DataFrame, n: int = 5, position: str = "position") -> DataFrame:
    """The ``n`` rows that come first in file order (a limit by design), in that order."""
    return df.orderBy(position).limit(n)


def zip_as_placed(left: DataFrame, right: DataFrame, position: str = "position") -> DataFrame:
    """``left`` with the columns of the row of ``right`` that has the same position.

    Both are joined by position, so neither is brought together in one task. Tables of different lengths
    raise ``ValueError``, as do columns that both have.
    """
    both = (set(left.columns) & set(right.columns)) - {position}
    if both:
        raise ValueError(f"both tables have {sorted(both)}")
    sizes = [df.agg(F.count("*"), F.max(position)).first() for df in (left, right)]
    if sizes[0] != sizes[1] or any(n and last != n - 1 for n, last in sizes):
        raise ValueError(f"the tables have {sizes[0][0]} and {sizes[1][0]} rows, or positions with gaps")
    return left.join(right, position).select(*[left[f"`{c}`"] for c in left.columns], *[right[f"`{c}`"] for c in right.columns if c != position])
