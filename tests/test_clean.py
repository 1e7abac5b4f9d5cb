import pytest
from pyspark.sql import functions as F

from textgate.functions import text as X
from textgate.operators import clean as C


def test_normalise_cleans_each_column_its_way(spark):
    rows = [("\t¿Qué  día \n es?", " No_Valida\t", "\nTrámites  LOCALES "), (" x\u00a0 y", "vaLIDA", None)]
    df = spark.createDataFrame(rows, "text string, label string, subtype string")
    got = {tuple(r) for r in C.normalise(C.default_subtype(df)).select("text", "label", "subtype").collect()}
    assert got == {("¿Qué día es?", "no_valida", "trámites  locales"), ("x y", "valida", "sin_subtipo")}


def test_validate_labels_returns_the_frame(spark):
    df = spark.createDataFrame([(i, "valida" if i % 4 else "no_valida") for i in range(9)], "doc_id int, label string")
    assert C.validate_labels(df) is df


def test_validate_labels_lists_all_bad_ones(spark):
    df = spark.createDataFrame([(f"bad{i:04d}",) for i in range(1500)], "label string")
    with pytest.raises(ValueError, match="1500 unsupported labels.*bad0000.*bad0099.*others in ") as e:
        C.validate_labels(df)
    assert spark.read.parquet(str(e.value).rsplit(" ", 1)[1]).count() == 1500


def test_validate_labels_rejects_sorted(spark):
    df = spark.createDataFrame([("A", "valida"), ("B", "otra"), ("C", "zz"), ("D", None)], "text string, label string")
    with pytest.raises(ValueError) as e:
        C.validate_labels(df)
    assert "['otra', 'zz']" in str(e.value) or "[None, 'otra', 'zz']" in str(e.value)


def test_require_columns(spark):
    df = spark.createDataFrame([("x",)], "text string")
    with pytest.raises(ValueError, match="'label'"):
        C.require_columns(df)


def test_assert_no_blank_shows_five(spark):
    rows = [(i, "" if i % 2 else "t", "valida") for i in range(20)]
    df = C.fill_text_label(spark.createDataFrame(rows, "doc_id int, text string, label string"))
    with pytest.raises(ValueError) as e:
        C.assert_no_blank(df, key="doc_id")
    assert str(e.value).count("doc_id") == 5


# Python's str.strip() / re.sub(r"\s+", " ") over awkward characters.
EDGE = [None, "", " \t ", " x ", " a  b ", "\x1cq\x1f", "NA", "null", '"q ""x"""',
        "a;b", "line1\nline2", "back\\", "\x85z\x0b"]


def test_strip_and_collapse_match_python(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE)], "i int, text string")
    got = {r.i: (r.s, r.n) for r in df.select("i", X.strip("text").alias("s"),
                                               X.strip_collapse("text").alias("n")).collect()}
    import re
    for i, t in enumerate(EDGE):
        if t is None:
            assert got[i] == (None, None)
            continue
        assert got[i][0] == t.strip(), (i, t)
        assert got[i][1] == re.sub(r"\s+", " ", t.strip()), (i, t)


def test_fill_and_default_subtype(spark):
    df = spark.createDataFrame([(None, " L ", None), ("t", None, "  "), ("u", "v", " Sub ")],
                               "text string, label string, subtype string")
    out = C.default_subtype(C.fill_text_label(df)).collect()
    assert [(r.text, r.label, r.subtype) for r in out] == [("", "L", "sin_subtipo"), ("t", "", ""), ("u", "v", "Sub")]
    missing = C.default_subtype(spark.createDataFrame([("a", "b")], "text string, label string"))
    assert missing.first().subtype == "sin_subtipo"


def test_blank_and_control_words(spark):
    df = spark.createDataFrame([(1, " Salir "), (2, "EXIT"), (3, "   "), (4, " ¿Horario? "), (5, None), (6, "quitar")],
                               "k int, text string")
    out = C.drop_control_words(C.drop_blank_asks(df)).orderBy("k").collect()
    assert [(r.k, r.text) for r in out] == [(4, "¿Horario?"), (6, "quitar")]


def test_quality_summary(spark):
    df = spark.createDataFrame([("a", "valida"), ("", "valida"), ("b", "otra"), ("c", None), ("d", "otra")],
                               "text string, label string")
    r = C.quality_summary(df).first()
    assert (r.n_rows, r.n_blank, r.n_bad_label_rows, r.n_bad_labels) == (5, 2, 3, 2)


def test_unexpected_labels_sorted(spark):
    df = spark.createDataFrame([("z",), ("valida",), ("b",), ("b",)], "label string")
    assert [r.label for r in C.unexpected_labels(df).collect()] == ["b", "z"]


def test_clean_header(spark):
    df = spark.createDataFrame([("a", "b")], ["﻿text ", " label"])
    assert C.clean_header(df).columns == ["text", "label"]


def test_label_check_edge_rows(spark):
    df = spark.createDataFrame([("a", "valida"), ("b", "NO_VALIDA "), ("c", "otra"), ("d", None)],
                               "text string, label string")
    bad = [r.label for r in C.unexpected_labels(C.normalise(df, text=None)).collect()]
    assert bad == [None, "otra"]
    ok = C.normalise(df.filter("text in ('a', 'b')"), text=None)
    assert C.validate_labels(ok) is ok
