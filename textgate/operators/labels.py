"""Label domain: distinct labels, the label ↔ id map, encode / decode, attaching predictions.

A label map has one row per class and any number of classes. Encoding and decoding are left joins
with it; Spark broadcasts the map when its size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgate.ranking import with_position


def distinct_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Sorted distinct labels (partial aggregation map-side, K rows out)."""
    return df.select(label).distinct().orderBy(label)


def build_label_map(df: DataFrame, label: str = "label", id_col: str = "id") -> DataFrame:
    """Sorted distinct labels numbered 0..K-1 (nulls left out).

    The labels are aggregated on the executors and numbered by their place in a range
    partitioning; no list of them reaches the driver.
    """
    names = df.select(F.col(label)).filter(F.col(label).isNotNull()).distinct()
    return with_position(names, [label], id_col).withColumn(id_col, F.col(id_col).cast("int"))


def as_label_map(spark, label_map: DataFrame | Sequence[str]) -> DataFrame:
    """A map table (label, id) from a table or from labels in id order."""
    if isinstance(label_map, DataFrame):
        return label_map.select("label", F.col("id").cast("int").alias("id"))
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("id", T.IntegerType())])
    return spark.createDataFrame([(str(x), i) for i, x in enumerate(label_map)], schema)


def encode_labels(df: DataFrame, label_map: DataFrame | Sequence[str], label: str = "label",
                  out: str = "labels") -> DataFrame:
    """label → id; a label missing from the map gives null and the row is kept."""
    m = as_label_map(df.sparkSession, label_map).select(F.col("label").alias("_map_label"), F.col("id").alias("_map_id"))
    return df.join(m, df[label] == m["_map_label"], "left").withColumn(out, F.col("_map_id")).drop("_map_label", "_map_id")


def decode_labels(df: DataFrame, label_map: DataFrame | Sequence[str], id_col: str = "predicted_id",
                  out: str = "predicted_label") -> DataFrame:
    """id → label; an id outside the map raises (a dict lookup in the reference)."""
    m = as_label_map(df.sparkSession, label_map).select(F.col("label").cast("string").alias("_map_label"), F.col("id").alias("_map_id"))
    j = df.join(m, df[id_col].cast("int") == m["_map_id"], "left")
    unknown = F.raise_error(F.concat(F.lit("unknown class id: "), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return j.withColumn(out, F.when(F.col("_map_id").isNull(), unknown.cast("string")).otherwise(F.col("_map_label"))) \
        .drop("_map_label", "_map_id")


def attach_predictions(rows: DataFrame, predictions: DataFrame, key: str | Sequence[str],
                       pred: str = "predicted_label") -> DataFrame:
    """Put predictions beside their rows by key: every row keeps its one row.

    The reference aligns by position; Spark has no row order, so the key is explicit. Prefer
    carrying the row's columns through scoring, which needs no join at all. A row without a
    prediction and a key with two predictions raise, naming the key. Null keys match null keys.
    """
    keys = [key] if isinstance(key, str) else list(key)
    named = [f"_key_{i}" for i in range(len(keys))]
    one = predictions.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, named)]) \
        .agg(F.count("*").alias("_found"), F.first(pred).alias("_prediction"))
    same = [rows[k].eqNullSafe(one[n]) for k, n in zip(keys, named)]
    joined = rows.join(one, same, "left")
    where = F.to_json(F.struct(*[F.col(k) for k in keys]))
    checked = F.when(F.col("_found").isNull(), F.raise_error(F.concat(F.lit("no prediction for "), where)).cast("string")) \
        .when(F.col("_found") > 1, F.raise_error(F.concat(F.lit("several predictions for "), where)).cast("string")) \
        .otherwise(F.col("_prediction"))
    return joined.withColumn(pred, checked.cast(predictions.schema[pred].dataType)).drop("_found", "_prediction", *named)
