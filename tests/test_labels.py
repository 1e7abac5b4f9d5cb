import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from textgate import jobs
from textgate.operators import labels as LB
from textgate.operators.split import stratified_split


def test_more_than_ten_thousand_labels(spark):
    df = spark.range(24_000).select(F.col("id").alias("doc_id"), F.format_string("c%05d", F.col("id") % 12_000).alias("label"))
    m = LB.build_label_map(df)
    assert {(r.label, r.id) for r in m.collect()} == {(f"c{i:05d}", i) for i in range(12_000)}
    enc = LB.encode_labels(df, m)
    assert enc.filter(F.col("labels") != F.col("doc_id") % 12_000).count() == 0 and enc.count() == 24_000
    dec = LB.decode_labels(enc, m, "labels")
    assert dec.filter("label <> predicted_label").count() == 0 and dec.count() == 24_000


def test_unknown_labels_and_ids(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "z")], "k int, label string")
    assert {(r.k, r.labels) for r in LB.encode_labels(df, ["a", "b"]).collect()} == {(1, 1), (2, None), (3, None)}
    ids = spark.createDataFrame([(1, 5)], "k int, predicted_id int")
    with pytest.raises(PySparkException, match="unknown class id: 5"):
        LB.decode_labels(ids, ["a", "b"]).collect()
    assert LB.build_label_map(df.filter("k = 2")).count() == 0


def test_attach_predictions_is_one_to_one(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y2"), (None, "n")], "k int, body string")
    preds = spark.createDataFrame([(2, "b"), (1, "a"), (None, "c")], "k int, predicted_label string")
    got = {(r.k, r.body, r.predicted_label) for r in LB.attach_predictions(rows, preds, "k").collect()}
    assert got == {(1, "x", "a"), (2, "y", "b"), (2, "y2", "b"), (None, "n", "c")}
    with pytest.raises(PySparkException, match="no prediction for"):
        LB.attach_predictions(rows, preds.filter("k = 2"), "k").collect()
    with pytest.raises(PySparkException, match="several predictions for"):
        LB.attach_predictions(rows, preds.unionByName(preds), "k").collect()


def test_keyless_files_split_alike_however_they_are_packed(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for f in range(6):
        lines = [f"pregunta {f * 60 + i % 55};{'valida' if i % 3 else 'no_valida'};s{i % 4}" for i in range(60)]
        (src / f"{f}.csv").write_text("text;label;subtype\n" + "\n".join(lines) + "\n", encoding="utf-8")
    got = []
    size = "spark.sql.files.maxPartitionBytes"
    for n, value in enumerate(("128m", "1k")):
        spark.conf.set(size, value)
        try:
            df, key = jobs.read_input(spark, str(src), ";", None, str(tmp_path / f"out{n}"), multi_line=False)
            split = stratified_split(df, key).groupBy("text", "label", "subtype", "split").count()
            got.append({tuple(r) for r in split.collect()})
        finally:
            spark.conf.set(size, "128m")
    assert got[0] == got[1]
