"""Stored splits are checked on reading; label maps of any size."""

import shutil

import pytest
from pyspark.sql import functions as F

from textgate.sources import readers as R
from textgate.sources import writers as W


def table(spark, names=("train", "validation", "test"), n=60):
    return spark.createDataFrame([(i, f"text {i}", "valida" if i % 3 else None, names[i % len(names)]) for i in range(n)],
                                 "doc_id int, text string, label string, split string")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_whole_splits_come_back(spark, tmp_path, fmt):
    df = table(spark).repartition(4)
    W.write_splits(df, str(tmp_path / "s"), fmt=fmt)
    back = R.read_splits(spark, str(tmp_path / "s"), fmt=fmt)
    assert sorted((int(r.doc_id), r.text, r.label, r.split) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    W.write_splits(df.filter("doc_id < 30"), str(tmp_path / "s"), fmt=fmt)  # stored again: the new manifest counts
    assert R.read_splits(spark, str(tmp_path / "s"), fmt=fmt).count() == 30


def test_half_written_splits_are_none(spark, tmp_path):
    path = tmp_path / "s"
    W.write_splits(table(spark), str(path))
    shutil.copytree(path, tmp_path / "half", ignore=shutil.ignore_patterns("_manifest"))
    assert R.read_splits(spark, str(tmp_path / "half")) is None
    assert R.read_splits(spark, str(tmp_path / "half"), verify=False).count() == 60
    W.write_splits(table(spark, ("train", "test")), str(tmp_path / "two"))
    assert R.read_splits(spark, str(tmp_path / "two")) is None
    W.write_splits(table(spark).limit(0), str(tmp_path / "none"))
    assert R.read_splits(spark, str(tmp_path / "none")) is None


def test_truncated_swapped_and_changed_splits_are_refused(spark, tmp_path):
    def stored(name):
        W.write_splits(table(spark).repartition(1), str(tmp_path / name))
        return tmp_path / name

    lost = stored("lost")
    next((lost / "split=test").glob("*.parquet")).unlink()
    with pytest.raises(ValueError, match="'test' has 0 rows, published were 20"):
        R.read_splits(spark, str(lost))
    swapped = stored("swapped")
    for a, b in (("train", "x"), ("test", "train"), ("x", "test")):
        (swapped / f"split={a}").rename(swapped / f"split={b}")
    with pytest.raises(ValueError, match="'train' has 20 rows, published were 20 .other contents.*'test'"):
        R.read_splits(spark, str(swapped))
    changed = stored("changed")
    spark.createDataFrame([(999, "late", "valida")], "doc_id int, text string, label string").write.mode("append").parquet(str(changed / "split=validation"))
    with pytest.raises(ValueError, match="'validation' has 21 rows, published were 20"):
        R.read_splits(spark, str(changed))
    assert R.read_splits(spark, str(changed), names=("train", "test")) is not None


def test_a_null_moved_to_another_column_is_another_row(spark):
    from textgate.sources.manifest import digests

    a = spark.createDataFrame([("x", None), ("y", "z")], "a string, b string")
    b = spark.createDataFrame([(None, "x"), ("y", "z")], "a string, b string")
    assert digests(a) != digests(b) and digests(a) == digests(a.orderBy("a").select("b", "a").repartition(3))


def test_a_million_labels(spark, tmp_path):
    labels = spark.range(1_000_000).select(F.format_string("label %07d", "id").alias("label"), F.col("id").cast("int").alias("id"))
    W.write_label_map(spark, labels, str(tmp_path / "m"))
    assert R.read_label_map(spark, str(tmp_path / "m")).exceptAll(labels).count() == 0 and R.read_label_map(spark, str(tmp_path / "m")).count() == 1_000_000
    assert R.read_id2label(spark, str(tmp_path / "m")).select("label", "id").exceptAll(labels).count() == 0
    one = spark.read.text(str(tmp_path / "m")).agg(F.max(F.length("value"))).first()[0]
    assert one < 1_000_000
