from conftest import SF001
from textgate.jobs import main
from textgate.plans import fixtures as fx
from textgate.sources import writers as W


def test_train_evaluate_predict_stream(spark, tmp_path):
    raw = str(tmp_path / "raw")
    W.write_table(fx.dirty(spark, SF001).drop("doc_id"), raw, sep=";")
    out = str(tmp_path / "gate")
    tr = main(["train", "--input", raw, "--out", out], spark)
    assert tr["best_epoch"] in (1, 2, 3, 4) and len(tr["history"]) == 4
    ev = main(["evaluate", "--out", out], spark)
    assert 0.0 <= ev["accuracy"] <= 1.0 and 0.0 <= ev["f1_macro"] <= 1.0
    pr = main(["predict", "--out", out, "--text", "¿Horario?", "--text", "hola"], spark)
    assert [r["text"] for r in pr] == ["¿Horario?", "hola"]
    src = tmp_path / "questions"
    src.mkdir()
    (src / "q.txt").write_text("uno\n\nsalir\ndos\n", encoding="utf-8")
    sink = str(tmp_path / "sink")
    main(["stream", "--out", out, "--source", str(src), "--sink", sink, "--once"], spark)
    assert sorted(r.text for r in spark.read.parquet(sink).collect()) == ["dos", "uno"]
