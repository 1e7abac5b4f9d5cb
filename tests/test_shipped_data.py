"""Our readers and split on a labelled question file and its three stored split files.

Set ``TEXTGATE_RAW_CSV`` (a ``;``-delimited text/label/subtype file of 400 questions, 200 per
label) and ``TEXTGATE_SPLITS_DIR`` (``train.csv``, ``validation.csv``, ``test.csv`` with a BOM,
``,``-delimited) to run these checks; they are skipped otherwise. The files are only read.
"""

import os

import pytest
from pyspark.sql import functions as F

from textgate.operators import clean as C
from textgate.operators import split as SP
from textgate.sources import readers as R

RAW = os.environ.get("TEXTGATE_RAW_CSV", "")
SPLITS = os.environ.get("TEXTGATE_SPLITS_DIR", "")

pytestmark = pytest.mark.skipif(not (RAW and SPLITS and os.path.exists(RAW)), reason="data files not given")


def test_raw_file_loads_and_validates(spark):
    df = R.load_dataset(spark, RAW)
    assert df.columns == ["text", "label", "subtype"]
    clean = C.normalise(df)
    C.check_quality(clean)
    counts = {r.label: r.n for r in SP.strata_counts(clean).collect()}
    assert counts == {"valida": 200, "no_valida": 200}
    assert clean.select("subtype").distinct().count() == 18
    auto = R.read_labelled_auto(spark, RAW)
    assert auto.count() == 400 and auto.columns == ["text", "label", "subtype"]


def test_split_sizes_match_shipped_splits(spark):
    df = C.normalise(R.load_dataset(spark, RAW)).withColumn("row_id", F.monotonically_increasing_id())
    df = df.cache()
    s = SP.stratified_split(df, "row_id")
    got = {(r.split, r.label): r["count"] for r in s.groupBy("split", "label").count().collect()}
    shipped = {}
    for name in ("train", "validation", "test"):
        part = R.read_labelled(spark, f"{SPLITS}/{name}.csv", ",")
        for r in part.groupBy("label").count().collect():
            shipped[(name, r.label)] = r["count"]
    assert got == shipped == {("train", "valida"): 140, ("train", "no_valida"): 140,
                              ("validation", "valida"): 30, ("validation", "no_valida"): 30,
                              ("test", "valida"): 30, ("test", "no_valida"): 30}
    df.unpersist()


def test_shipped_splits_are_disjoint_and_complete(spark):
    texts = {}
    for name in ("train", "validation", "test"):
        texts[name] = {r.text for r in R.read_labelled(spark, f"{SPLITS}/{name}.csv", ",").collect()}
    raw = {r.text for r in R.read_labelled(spark, RAW).collect()}
    assert not (texts["train"] & texts["validation"]) and not (texts["train"] & texts["test"])
    assert texts["train"] | texts["validation"] | texts["test"] == raw


def test_read_split_files_layout(spark, tmp_path):
    s = R.read_split_files(spark, SPLITS)
    assert s is not None and s.count() == 400
    assert {r.split: r["count"] for r in s.groupBy("split").count().collect()} == {"train": 280, "validation": 60, "test": 60}
    assert R.read_split_files(spark, str(tmp_path)) is None
