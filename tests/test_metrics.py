import math

import pytest
from pyspark.sql import functions as F

from textgate.functions import logits as L
from textgate.operators import metrics as M


def metrics_of(spark, logits, labels):
    df = spark.createDataFrame(list(zip(logits, labels)), "logits array<double>, label int")
    df = df.withColumn("pred", L.argmax_class("logits"))
    return M.metrics_from_confusion(M.confusion_counts(df, "label", "pred")).first()


def test_metrics_from_logits_by_hand(spark):
    m = metrics_of(spark, [[3.0, 1.0, 2.0], [0.5, 0.4, 4.0], [-1.0, 2.5, 0.0], [6.0, 5.0, 4.0]], [0, 2, 1, 2])
    # class 0: 1 of 1 found in 2 guesses; class 1: exact; class 2: 1 of 2 found in 1 guess
    assert m.accuracy == 0.75 and math.isclose(m.f1_macro, (2 / 3 + 1 + 2 / 3) / 3)


def sk_report(truth, pred, labels=None):
    """Hand-rolled scikit-learn classification_report(output_dict=True, zero_division=0) semantics."""
    classes = sorted(set(truth) | set(pred)) if labels is None else list(labels)
    rows = {}
    for c in classes:
        tp = sum(1 for t, p in zip(truth, pred) if t == c and p == c)
        sup = sum(1 for t in truth if t == c)
        prd = sum(1 for p in pred if p == c)
        pr = tp / prd if prd else 0.0
        rc = tp / sup if sup else 0.0
        f1 = 2 * tp / (sup + prd) if sup + prd else 0.0
        rows[str(c)] = (pr, rc, f1, float(sup))
    n = sum(r[3] for r in rows.values())
    acc = sum(1 for t, p in zip(truth, pred) if t == p) / len(truth)
    k = len(classes)
    rows["accuracy"] = (acc, acc, acc, acc)
    rows["macro avg"] = tuple(sum(r[i] for r in list(rows.values())[:k]) / k for i in range(3)) + (n,)
    rows["weighted avg"] = tuple(sum(r[i] * r[3] for r in list(rows.values())[:k]) / n if n else 0.0
                                 for i in range(3)) + (n,)
    return rows


CASES = [
    ([0, 0, 1, 1, 2, 2, 2, 0, 1, 2, 2], [0, 1, 1, 2, 2, 2, 0, 0, 1, 1, 2]),
    ([0, 0, 0, 1], [0, 0, 0, 3]),          # class only in predictions
    ([5, 5, 5], [5, 5, 5]),                # single class
]


@pytest.mark.parametrize("truth,pred", CASES)
def test_report_matches_sklearn_conventions(spark, truth, pred):
    df = spark.createDataFrame(list(zip(truth, pred)), "label int, pred int")
    got = {r["class"]: (r.precision, r.recall, r.f1_score, r.support)
           for r in M.classification_report(df, "label", "pred").collect()}
    exp = sk_report(truth, pred)
    assert set(got) == set(exp)
    for k, v in exp.items():
        assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(got[k], v)), (k, got[k], v)
    order = [r["class"] for r in M.classification_report(df, "label", "pred").orderBy("row_order").collect()]
    assert order[-3:] == ["accuracy", "macro avg", "weighted avg"]


def test_report_with_unseen_listed_class(spark):
    truth, pred = [0, 0, 1], [0, 1, 1]
    df = spark.createDataFrame(list(zip(truth, pred)), "label int, pred int")
    rep = M.classification_report(df, "label", "pred", labels=[0, 1, 2], names=["a", "b", "c"])
    got = {r["class"]: (r.precision, r.recall, r.f1_score, r.support) for r in rep.collect()}
    assert got["c"] == (0.0, 0.0, 0.0, 0.0)
    assert math.isclose(got["macro avg"][2], (2 / 3 + 2 / 3 + 0) / 3)
    assert "accuracy" in got


def test_report_micro_when_labels_leave_out_a_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 0)], "label int, pred int")
    got = {r["class"] for r in M.classification_report(df, "label", "pred", labels=[0, 1]).collect()}
    assert "micro avg" in got and "accuracy" not in got


def test_macro_f1_is_not_weighted(spark):
    truth = [0, 0, 0, 0, 0, 0, 0, 1, 1, 2, 2]
    pred = [0, 0, 0, 0, 0, 0, 1, 1, 0, 2, 0]
    df = spark.createDataFrame(list(zip(truth, pred)), "label int, pred int")
    f1 = M.f1_macro(df, "label", "pred").first().f1_macro
    exp = sk_report(truth, pred)["macro avg"][2]
    assert math.isclose(f1, exp)


def test_confusion_matrix_dense(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a"), ("zz", "a")], "label string, pred string")
    conf = M.confusion_counts(df, "label", "pred")
    m = M.confusion_matrix(conf, ["a", "b", "c"]).orderBy("row_order").collect()
    assert [(r.label, r.a, r.b, r.c) for r in m] == [("a", 1, 1, 0), ("b", 0, 1, 0), ("c", 1, 0, 0)]
    p = M.confusion_matrix_prefixed(conf, ["a", "b", "c"]).orderBy("row_order").first()
    assert (p.label, p.pred_a, p.pred_b) == ("real_a", 1, 1)


def test_misclassified_null_safe(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, None, "a"), (4, None, None)],
                               "k int, label string, predicted_label string")
    assert sorted(r.k for r in M.misclassified(df).collect()) == [2, 3]


def test_per_split_equals_separate(spark):
    rows = [(i % 2, i % 3, (i * 7) % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "split int, label int, pred int")
    both = M.classification_report(df, "label", "pred", by=["split"])
    for s in (0, 1):
        one = M.classification_report(df.filter(F.col("split") == s), "label", "pred")
        a = sorted((r["class"], round(r.f1_score, 12)) for r in both.filter(F.col("split") == s).collect())
        b = sorted((r["class"], round(r.f1_score, 12)) for r in one.collect())
        assert a == b
