"""Writers: tables, splits, metrics, label maps, history, reports, models.

CSV output keeps pandas' conventions: header, quotes doubled (``escape='"'``), field blanks
kept (Spark trims them by default). Small K-sized outputs (reports, matrices, metrics) are
written as one ordered file; data-sized outputs keep their partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WRITE_CSV = {"header": "true", "escape": '"', "quote": '"', "encoding": "UTF-8",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_table(df: DataFrame, path: str, fmt: str = "csv", sep: str = ",", mode: str = "overwrite") -> None:
    """Write CSV with header (or parquet / json); the folder is created."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.options(**WRITE_CSV, sep=sep).csv(path)
    else:
        w.format(fmt).save(path)


def write_small(df: DataFrame, path: str, order: Sequence[str] = ("row_order",), fmt: str = "csv") -> None:
    """A K-sized table as one file in row order (sort, then a single output partition)."""
    keys = [c for c in order if c in df.columns]
    out = (df.orderBy(*keys) if keys else df).coalesce(1)
    write_table(out, path, fmt)


def write_splits(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> None:
    """All splits in one write, one folder per split value (partition pruning on read); then, as the last
    write, a manifest of each split's rows and digest, as they are read back."""
    from textgate.sources import manifest as MF

    spark = df.sparkSession
    w = df.write.mode("overwrite").partitionBy(split_col)
    if fmt == "csv":
        w.options(**WRITE_CSV).csv(path)
    else:
        w.format(fmt).save(path)
    try:
        stored = split_table(spark, path, fmt)
    except AnalysisException:  # no row, so no folder
        stored = None
    MF.publish(spark, path, fmt, MF.digests(stored, split_col) if stored is not None else {})


def split_table(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    options = {**WRITE_CSV, "inferSchema": "false", "multiLine": "true", "sep": ","} if fmt == "csv" else {}
    return spark.read.options(**options).format(fmt).load(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A one-row metrics frame as JSON (non-ASCII kept)."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def label_map_frame(spark: SparkSession, label_map: DataFrame | Sequence[str]) -> DataFrame:
    if isinstance(label_map, DataFrame):
        return label_map.select("label", F.col("id").cast("int"))
    return spark.createDataFrame([(str(x), i) for i, x in enumerate(label_map)], "label string, id int")


def write_label_map(spark: SparkSession, label_map: DataFrame | Sequence[str], path: str, rows: int = 10_000) -> None:
    """``{"label2id": {label: id}, "id2label": {"id": label}}`` (ids as string keys in the second).

    A map of more than ``rows`` labels becomes several such documents, each with a run of ids and in a
    file of its own, so no task holds more than that; readers put them together.
    """
    m = label_map_frame(spark, label_map)
    doc = m.groupBy(F.floor(F.col("id") / rows).alias("_run")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "id")))).alias("label2id"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("id").cast("string"), "label"))))
        .alias("id2label"))
    one = m.agg(F.max("id")).first()[0]
    doc = doc.drop("_run")
    (doc.coalesce(1) if one is None or one < rows else doc).write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)


def write_history(history: DataFrame, path: str) -> bool:
    """The epoch log as CSV; nothing is written when it is empty. Returns whether it wrote."""
    if history.isEmpty():
        return False
    write_small(history, path, ("epoch",))
    return True


def write_ordered(df: DataFrame, path: str, order: Sequence[str], drop: Sequence[str] = ("row_order",)) -> None:
    """A K-sized table as one CSV file, rows sorted by ``order``, helper columns dropped."""
    out = df.orderBy(*order).coalesce(1)
    write_table(out.drop(*drop), path)


def write_report(report: DataFrame, path: str) -> None:
    """The classification report: row names first (``class``), then precision, recall, f1-score,
    support, in report order."""
    by = [c for c in report.columns if c not in ("row_order", "class", "precision", "recall", "f1_score", "support")]
    out = report.select(*by, "class", "precision", "recall", F.col("f1_score").alias("f1-score"), "support",
                        "row_order")
    write_ordered(out, path, (*by, "row_order"))


def write_confusion(matrix: DataFrame, path: str) -> None:
    """The confusion matrix, truth names in the first column, rows in label order."""
    write_ordered(matrix, path, ("row_order",))


def write_misclassified(rows: DataFrame, path: str) -> None:
    write_table(rows, path)


def save_model(model, path: str) -> None:
    """Export pipeline + label map + column names to one folder."""
    model.save(path)
