"""Positions of stored rows, batches of a fixed size, and predictors with several ragged inputs."""

import csv

import numpy as np
import pytest
from pyspark.sql import functions as F

from textgate.operators import encode as E
from textgate.operators.score import score_with_inputs
from textgate.session import scratch_path
from textgate.sources import positions as P
from textgate.sources import readers as R


def ordered(spark, n, files, name="k"):
    path = scratch_path(spark, "placed")
    spark.range(n).select(F.col("id").alias(name)).repartitionByRange(files, name).sortWithinPartitions(name).write.parquet(path)
    return path


def test_positions_do_not_follow_the_splits(spark):
    path, before = ordered(spark, 5000, 3), spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (before, "2000b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert P.read_placed(spark, path).filter("k != position").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_zip_and_first_rows(spark):
    a, b = P.read_placed(spark, ordered(spark, 1000, 4, "a")), P.read_placed(spark, ordered(spark, 1000, 7, "b"))
    both = P.zip_as_placed(a, b)
    assert both.columns == ["a", "position", "b"] and both.count() == 1000 and both.filter("a != b").count() == 0
    assert [r.a for r in P.first_rows(a.filter("a % 7 = 3"), 3).collect()] == [3, 10, 17]
    with pytest.raises(ValueError, match="1000 and 999"):
        P.zip_as_placed(a, P.read_placed(spark, ordered(spark, 999, 2, "b")))
    with pytest.raises(ValueError, match="gaps"):
        P.zip_as_placed(a.filter("a > 0"), b.filter("b > 0"))
    with pytest.raises(ValueError, match="'a'"):
        P.zip_as_placed(a, a)


@pytest.mark.parametrize("size", ["128m", "200b"])
def test_csv_rows_are_numbered_in_file_order(spark, tmp_path, size):
    rows = [(f"{i} " + "line\n" * (i % 4) + "x" * (i % 90), "valida") for i in range(300)]
    rows[150] = ("long\n" * 300, "valida")
    for k, name in enumerate(("a.csv", "b.csv", "c.csv")):
        with (tmp_path / name).open("w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, delimiter=";", lineterminator="\n")
            w.writerow(("text", "label"))
            w.writerows(rows[100 * k:100 * (k + 1)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        df = R.read_labelled(spark, str(tmp_path), position="at")
        got = sorted((r["at"], r["text"], r["label"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [(i, *r) for i, r in enumerate(rows)]


@pytest.mark.parametrize("n", [0, 5, 8, 403])
def test_batches_of_eight(spark, n):
    df = spark.range(n).select((F.col("id") % 50).alias("k"), F.when(F.col("id") % 3 == 0, "x").alias("batch_text"), F.lit(None).cast("int").alias("_place"))
    runs = [E.assign_batches(d) for d in (df.repartition(5), df.coalesce(1))]
    assert runs[0].columns == [*df.columns, "batch"]
    sizes = {r["batch"]: r["count"] for r in runs[0].groupBy("batch").count().collect()}
    assert sorted(sizes) == list(range(-(-n // 8))) and all(c == 8 for b, c in sizes.items() if b < n // 8)
    a, b = (sorted(map(repr, r.collect())) for r in runs)
    assert a == b
    if n > 100:
        other = E.assign_batches(df, seed=7)
        assert sorted(map(repr, other.collect())) != a
        own = E.assign_batches(spark.range(n), key="id").collect()
        assert len({r.id // 8 for r in own if r["batch"] == 0}) > 3  # shuffled


def test_ragged_inputs_equal_row_by_row(spark):
    def make_model():
        def predict(input_ids, attention_mask):
            assert input_ids.shape == attention_mask.shape
            first = np.where(attention_mask.sum(1) > 0, input_ids[:, 0], -1)
            return np.stack([(input_ids * attention_mask).sum(1), attention_mask.sum(1) * 2.5, first * 1.0], axis=1)

        return predict

    rnd = np.random.default_rng(1)
    rows = [(i, [int(x) for x in rnd.integers(0, 50, n)], [1] * n, "kept") for i, n in enumerate(rnd.geometric(0.05, 300).tolist())]
    rows += [(900, [], [], "e"), (901, None, None, None)]
    df = spark.createDataFrame(rows, "id long, input_ids array<int>, attention_mask array<int>, padded string").repartition(3)
    args = dict(make_predict_fn=make_model, inputs=["input_ids", "attention_mask"], labels=["a", "b", "c"], batch_size=16, padded="extra")
    by_length = score_with_inputs(df, **args).collect()
    arrival = score_with_inputs(df, **args, by_length=False).collect()
    one = score_with_inputs(df, **{**args, "batch_size": 1}).collect()
    key = lambda rs: sorted((r.id, r.padded, r.predicted_label, round(r.confidence, 12)) for r in rs if r.id < 900)
    assert key(by_length) == key(arrival) == key(one) and len(by_length) == 302
    predict = make_model()
    for r in by_length:
        ids = next(x[1] for x in rows if x[0] == r.id) or []
        z = predict(np.array([ids or [0]]), np.array([[1] * len(ids) or [0]]))[0]
        assert r.predicted_id == int(z.argmax()) and r.confidence == pytest.approx(1 / np.exp(z - z.max()).sum())
    assert sum(r.extra for r in by_length) < 0.3 * sum(r.extra for r in arrival)
    assert all(r.extra == 0 for r in one if r.id < 900)
    bad = spark.createDataFrame([(1, [1, 2], [1], "x")], df.schema)
    with pytest.raises(Exception, match="differ in length"):
        score_with_inputs(bad, **args).collect()
