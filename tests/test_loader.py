from pathlib import Path

import pytest

from textgate.sources import readers as R
from textgate.sources import writers as W


def test_file_without_subtype_gets_the_default(spark, tmp_path: Path):
    p = tmp_path / "three.csv"
    p.write_text("label;text\nvalida;¿Abren el lunes?\nno_valida; cielo \nvalida;parque norte\n", encoding="utf-8")
    rows = {(r.text, r.label, r.subtype) for r in R.load_dataset(spark, str(p)).collect()}
    assert rows == {("¿Abren el lunes?", "valida", "sin_subtipo"), ("cielo", "no_valida", "sin_subtipo"), ("parque norte", "valida", "sin_subtipo")}


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_are_bound_by_their_own_headers(spark, tmp_path: Path, multi_line):
    (tmp_path / "a.csv").write_text("text;label;subtype\nuno;valida;x\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("\ufefflabel;text\r\nno_valida;dos\r\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("subtype;label;text\ny;valida;tres\n", encoding="utf-8")
    (tmp_path / "d.csv").write_text("text;label;subtype\ncuatro;valida;z\n", encoding="utf-8")
    (tmp_path / "empty.csv").write_text("", encoding="utf-8")
    df = R.read_labelled(spark, str(tmp_path), multi_line=multi_line)
    assert {(r.text, r.label, r.subtype) for r in df.collect()} == {
        ("uno", "valida", "x"), ("dos", "no_valida", None), ("tres", "valida", "y"), ("cuatro", "valida", "z")}


def test_bom_quotes_newlines(spark, tmp_path: Path):
    p = tmp_path / "bom.csv"
    p.write_text('﻿text;label;subtype\n"a;b ""q""\nline";VALIDA;X\n', encoding="utf-8")
    df = R.read_labelled(spark, str(p))
    assert df.columns == ["text", "label", "subtype"]
    assert df.first().text == 'a;b "q"\nline'


def test_missing_label_column(spark, tmp_path: Path):
    p = tmp_path / "bad.csv"
    p.write_text("text;other\nx;y\n", encoding="utf-8")
    with pytest.raises(ValueError, match="'label'"):
        R.read_labelled(spark, str(p))


def test_blank_row_fails(spark, tmp_path: Path):
    p = tmp_path / "blank.csv"
    p.write_text("text;label\n   ;valida\nok;valida\n", encoding="utf-8")
    with pytest.raises(ValueError, match="blank"):
        R.load_dataset(spark, str(p))


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_auto_delimiter(spark, tmp_path: Path, sep):
    p = tmp_path / "auto.csv"
    p.write_text(f"text{sep}label{sep}subtype\nuno{sep}valida{sep}a\n", encoding="utf-8")
    df = R.read_labelled_auto(spark, str(p))
    assert df.columns == ["text", "label", "subtype"]
    assert df.first().label == "valida"


def test_round_trip_keeps_blanks_and_quotes(spark, tmp_path: Path):
    rows = [("  padded  ", "valida", 'say "hi", ok'), ("x\ny", "no_valida", "a;b")]
    df = spark.createDataFrame(rows, "text string, label string, subtype string")
    W.write_table(df, str(tmp_path / "t"))
    back = R.read_labelled(spark, str(tmp_path / "t"), ",")
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_splits_and_label_map_round_trip(spark, tmp_path: Path):
    df = spark.createDataFrame([(i, "t", "valida" if i % 3 else "no_valida", s)
                                for i, s in enumerate(["train", "validation", "test"] * 4)],
                               "doc_id int, text string, label string, split string")
    W.write_splits(df, str(tmp_path / "s"))
    assert R.read_splits(spark, str(tmp_path / "s")).count() == 12
    W.write_splits(df.filter("split != 'test'"), str(tmp_path / "s2"))
    assert R.read_splits(spark, str(tmp_path / "s2")) is None
    assert R.read_splits(spark, str(tmp_path / "nothing")) is None
    W.write_label_map(spark, ["no_valida", "valida"], str(tmp_path / "lm"))
    assert sorted(tuple(r) for r in R.read_label_map(spark, str(tmp_path / "lm")).collect()) == [("no_valida", 0), ("valida", 1)]
    assert sorted(tuple(r) for r in R.read_id2label(spark, str(tmp_path / "lm")).collect()) == [(0, "no_valida"), (1, "valida")]


def test_reference_label_map_json(spark, tmp_path: Path):
    p = tmp_path / "labels.json"
    p.write_text('{\n  "label2id": {\n    "no_valida": 0,\n    "valida": 1\n  },\n  "id2label": {\n    "0": "no_valida",\n'
                 '    "1": "valida"\n  }\n}', encoding="utf-8")
    assert sorted(tuple(r) for r in R.read_label_map(spark, str(p)).collect()) == [("no_valida", 0), ("valida", 1)]


def test_history_not_written_when_empty(spark, tmp_path: Path):
    from textgate.plans.training import HISTORY_SCHEMA

    empty = spark.createDataFrame([], HISTORY_SCHEMA)
    assert W.write_history(empty, str(tmp_path / "h")) is False
    assert not (tmp_path / "h").exists()
