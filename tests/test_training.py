import math

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from textgate.operators.score import score
from textgate.plans import fixtures as fx
from textgate.plans.training import best_candidates, evaluate_model, load_gate, train_gate
from textgate.session import scratch_path


@pytest.fixture(scope="module")
def gate(spark):
    root = scratch_path(spark, "test-gate")
    return train_gate(fx.dirty(spark, SF001), "doc_id", save_to=root), root


def test_history_and_selection(spark, gate):
    res, _ = gate
    hist = res.history.orderBy("epoch").collect()
    assert [r.epoch for r in hist] == [1, 2, 3, 4]
    best = max(hist, key=lambda r: (r.f1_macro, -r.epoch))
    assert res.best_epoch == best.epoch
    top = best_candidates(res.history).collect()
    assert len(top) == 2 and top[0].epoch == best.epoch


def test_training_is_deterministic(spark, gate):
    res, _ = gate
    again = train_gate(fx.dirty(spark, SF001), "doc_id")
    a = [(r.epoch, round(r.f1_macro, 9)) for r in res.history.orderBy("epoch").collect()]
    b = [(r.epoch, round(r.f1_macro, 9)) for r in again.history.orderBy("epoch").collect()]
    assert a == b


def test_probabilities_and_reload(spark, gate):
    res, root = gate
    test = spark.read.parquet(f"{root}/splits").filter(F.col("split") == "test")
    s = score(test, res.model).collect()
    assert s and all(math.isclose(sum(r.probabilities.values()), 1.0) for r in s)
    assert all(r.predicted_label in ("no_valida", "valida") for r in s)
    loaded = load_gate(spark, f"{root}/model")
    assert loaded.labels == res.model.labels == ["no_valida", "valida"]
    s2 = {r.doc_id: r.predicted_label for r in score(test, loaded).collect()}
    assert s2 == {r.doc_id: r.predicted_label for r in s}


def test_evaluate_model_outputs(spark, gate):
    res, root = gate
    test = spark.read.parquet(f"{root}/splits").filter(F.col("split") == "test")
    ev = evaluate_model(test, res.model)
    rep = {r["class"]: r for r in ev.report.collect()}
    assert {"no_valida", "valida", "accuracy", "macro avg", "weighted avg"} <= set(rep)
    m = ev.metrics.first()
    assert math.isclose(m.accuracy, rep["accuracy"].precision)
    n_wrong = ev.misclassified.count()
    assert math.isclose(m.accuracy, 1 - n_wrong / test.count())
    assert sum(r.no_valida + r.valida for r in ev.confusion.collect()) == test.count()


def test_missing_model_raises(spark):
    with pytest.raises(FileNotFoundError):
        load_gate(spark, scratch_path(spark, "nothing-here"))


def test_stream_score_equals_batch(spark, gate):
    from textgate.operators.clean import drop_blank_asks, drop_control_words
    from textgate.streaming.questions import stream_score

    res, _ = gate
    schema = fx.table(spark, SF001, "conversations").schema
    sink, ckpt = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt")
    stream_score(spark, SF001, schema, res.model, sink, ckpt, glob="conversations.parquet").awaitTermination()
    streamed = {(r.conv_id, r.turn): (r.predicted_label, round(r.confidence, 9))
                for r in spark.read.parquet(sink).collect()}
    batch_in = drop_control_words(drop_blank_asks(fx.asks(spark, SF001)))
    batch = {(r.conv_id, r.turn): (r.predicted_label, round(r.confidence, 9))
             for r in score(batch_in, res.model).collect()}
    assert streamed == batch and len(batch) > 0


def test_save_evaluation_files(spark, gate, tmp_path):
    from textgate.plans.training import save_evaluation

    res, root = gate
    test = spark.read.parquet(f"{root}/splits").filter(F.col("split") == "test")
    out = str(tmp_path / "eval")
    ev = evaluate_model(test, res.model)
    save_evaluation(ev, out)
    ev.release()
    rep = spark.read.option("header", True).csv(f"{out}/classification_report")
    assert rep.columns == ["class", "precision", "recall", "f1-score", "support"]
    assert [r["class"] for r in rep.collect()][-3:] == ["accuracy", "macro avg", "weighted avg"]
    cm = spark.read.option("header", True).csv(f"{out}/confusion_matrix")
    assert cm.columns == ["label", "no_valida", "valida"]
    assert spark.read.json(f"{out}/metrics").columns == ["accuracy", "f1_macro"]


def test_score_ignores_unseen_labels(spark, gate):
    res, _ = gate
    df = spark.createDataFrame([(1, "texto nuevo", "otra"), (2, "otro texto", None)], "doc_id int, text string, label string")
    out = score(df, res.model).collect()
    assert [r.label for r in out] == ["otra", None] and all(r.predicted_label for r in out)


def test_line_stream_clean_and_score(spark, gate, tmp_path):
    from textgate.streaming.questions import clean_questions, read_question_lines, start_sink

    res, _ = gate
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("¿A qué hora abre la piscina?\n  \nSalir\n EXIT \nhorario de la biblioteca \n", encoding="utf-8")
    lines = clean_questions(read_question_lines(spark, str(src)))
    sink, ckpt = scratch_path(spark, "lines"), scratch_path(spark, "lines-ckpt")
    start_sink(score(lines, res.model).drop("class_probs"), sink, ckpt).awaitTermination()
    got = sorted(r.text for r in spark.read.parquet(sink).collect())
    assert got == sorted(["horario de la biblioteca", "¿A qué hora abre la piscina?"])


def test_score_texts_record_shape(spark, gate):
    from textgate.operators.score import score_texts

    res, _ = gate
    out = score_texts(spark, res.model, ["¿Cuál es el horario?", "hola"])
    assert [r["text"] for r in out] == ["¿Cuál es el horario?", "hola"]
    assert all(set(r) == {"text", "predicted_label", "confidence", "probabilities"} for r in out)
    assert all(abs(r["confidence"] - max(r["probabilities"].values())) < 1e-12 for r in out)


def test_train_gate_checks_before_training(spark):
    rows = [(i, "texto" if i % 9 else "  ", "valida" if i % 2 else "no_valida") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label string")
    with pytest.raises(ValueError, match="blank rows"):
        train_gate(df, "doc_id")
    bad = spark.createDataFrame([(i, "texto", "otra" if i == 3 else "valida") for i in range(40)],
                                "doc_id bigint, text string, label string")
    with pytest.raises(ValueError, match="otra"):
        train_gate(bad, "doc_id")


def test_stored_splits_read_back_clean(spark, gate):
    from textgate.sources.readers import read_splits

    res, root = gate
    back = read_splits(spark, f"{root}/splits")
    assert set(back.columns) == set(res.splits.columns)
    assert back.count() == res.splits.count()
