"""The query registry: one DataFrame-returning callable per operator of the inventory.

Each callable takes ``(spark, sf_dir)``, reads the driver's tables through the test views in
``fixtures`` and returns a DataFrame over the whole tables. Edge values (blank texts, bad labels,
control words) are injected with a ``CASE`` on the key, never by filtering rows away; the same
``CASE`` appears in the oracle SQL (``textgate.plans.oracle``). Array and map results are flattened
(joined strings, exploded rows) and doubles rounded to 6 digits so both sides hash alike.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.functions import logits as L
from textgate.functions import text as X
from textgate.operators import clean as C
from textgate.operators import encode as E
from textgate.operators import labels as LB
from textgate.operators import metrics as M
from textgate.operators import score as S
from textgate.operators import split as SP
from textgate.plans import fixtures as fx
from textgate.session import materialise

# The batch functions below run in Python workers; shipping this module's functions by value
# means a worker needs only pandas / numpy, not this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed class names of the ``scored`` view: its truth labels are the ids 0..9.
SCORED_CLASSES = [str(i) for i in range(10)]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- shared inputs

def cleaned(spark, sf) -> DataFrame:
    """``dirty`` after load-time cleaning and ``normalise``: (doc_id, text, label, subtype)."""
    return C.clean_labelled(fx.dirty(spark, sf))


def gappy(spark, sf) -> DataFrame:
    """``labelled`` with blank texts and bad labels injected by key."""
    lb = fx.labelled(spark, sf)
    k7, k11, k13 = F.col("doc_id") % 7, F.col("doc_id") % 11, F.col("doc_id") % 13
    return lb.select(
        "doc_id",
        F.when(k7 == 0, F.lit(None).cast("string")).when(k7 == 1, F.lit(" \t ")).otherwise(F.col("text")).alias("text"),
        F.when(k11 == 0, F.lit("")).when(k13 == 0, F.lit("Otra")).otherwise(F.col("label")).alias("label"),
        "subtype")


def edgy_asks(spark, sf) -> DataFrame:
    """``asks`` with blank questions and control words injected by key."""
    a = fx.asks(spark, sf)
    k = (F.col("conv_id") + F.col("turn")) % 7
    return a.select("conv_id", "turn",
                    F.when(k == 0, F.lit("   ")).when(k == 1, F.lit(" Salir ")).when(k == 2, F.lit("EXIT"))
                    .otherwise(F.col("text")).alias("text"))


def predicted(spark, sf) -> DataFrame:
    """``scored`` with the argmax class id."""
    return fx.scored(spark, sf).withColumn("predicted_id", L.argmax_class("logits"))


def report_cols(df: DataFrame, by=()) -> DataFrame:
    return df.select(*by, "row_order", "class", *[r6(c).alias(c) for c in ("precision", "recall", "f1_score", "support")])


# ---------------------------------------------------------------- 2.3 projections

@query
def q_fill_text_label(spark, sf):
    return C.fill_text_label(fx.dirty(spark, sf)).select("doc_id", "text", "label")


@query
def q_default_subtype(spark, sf):
    return C.default_subtype(fx.dirty(spark, sf)).select("doc_id", "subtype")


@query
def q_normalise(spark, sf):
    return C.normalise(fx.dirty(spark, sf))


@query
def q_select_core(spark, sf):
    return C.select_core(cleaned(spark, sf), key="doc_id")


@query
def q_training_view(spark, sf):
    df = cleaned(spark, sf)
    return E.training_view(df, LB.build_label_map(df), key="doc_id")


@query
def q_model_columns(spark, sf):
    df = cleaned(spark, sf)
    enc = LB.encode_labels(E.pad_tokens(E.tokenise(df)), LB.build_label_map(df), "label", "labels")
    out = E.model_columns(enc, ("doc_id", "input_ids", "attention_mask", "labels"))
    return out.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"),
                      F.size("input_ids").alias("n_ids"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"), "labels")


# ---------------------------------------------------------------- 2.4 filters and checks

@query
def q_blank_rows(spark, sf):
    return C.blank_rows(C.fill_text_label(gappy(spark, sf))).select("doc_id", "text", "label")


@query
def q_unexpected_labels(spark, sf):
    return C.unexpected_labels(C.clean_labelled(gappy(spark, sf)))


@query
def q_quality_summary(spark, sf):
    return C.quality_summary(C.clean_labelled(gappy(spark, sf)))


@query
def q_drop_blank_asks(spark, sf):
    return C.drop_blank_asks(edgy_asks(spark, sf))


@query
def q_drop_control_words(spark, sf):
    return C.drop_control_words(C.drop_blank_asks(edgy_asks(spark, sf)))


@query
def q_end_sessions(spark, sf):
    return C.end_sessions(edgy_asks(spark, sf))


# ---------------------------------------------------------------- 2.5 joins

@query
def q_encode_labels(spark, sf):
    df = C.clean_labelled(gappy(spark, sf))
    return LB.encode_labels(df, sorted(C.ALLOWED_LABELS)).select("doc_id", "label", "labels")


@query
def q_decode_labels(spark, sf):
    df = predicted(spark, sf)
    return LB.decode_labels(df, LB.build_label_map(df.select(F.col("label").cast("string").alias("label")))) \
        .select("vec_id", "predicted_id", "predicted_label")


@query
def q_attach_predictions(spark, sf):
    rows = fx.scored(spark, sf)
    preds = S.score_logits(rows, SCORED_CLASSES).select("vec_id", "predicted_label")
    return LB.attach_predictions(rows.select("vec_id", "label"), preds, "vec_id")


# ---------------------------------------------------------------- 2.6 aggregations

@query
def q_distinct_labels(spark, sf):
    return LB.distinct_labels(cleaned(spark, sf))


@query
def q_strata_counts(spark, sf):
    return SP.strata_counts(cleaned(spark, sf))


@query
def q_accuracy(spark, sf):
    return M.accuracy(predicted(spark, sf), "label", "predicted_id").select(r6("accuracy").alias("accuracy"))


@query
def q_f1_macro(spark, sf):
    return M.f1_macro(predicted(spark, sf), "label", "predicted_id").select(r6("f1_macro").alias("f1_macro"))


@query
def q_evaluate(spark, sf):
    conf = M.confusion_counts(predicted(spark, sf), "label", "predicted_id")
    return M.metrics_from_confusion(conf).select(r6("accuracy").alias("accuracy"), r6("f1_macro").alias("f1_macro"))


# ---------------------------------------------------------------- 2.7 scalars

@query
def q_strip(spark, sf):
    return fx.dirty(spark, sf).select("doc_id", X.strip("text").alias("text"), X.strip("subtype").alias("subtype"))


@query
def q_collapse_ws(spark, sf):
    return fx.dirty(spark, sf).select("doc_id", X.collapse_ws("text").alias("text"))


@query
def q_lowercase(spark, sf):
    return fx.dirty(spark, sf).select("doc_id", X.lowercase("label").alias("label"),
                                      X.lowercase("subtype").alias("subtype"))


@query
def q_to_string(spark, sf):
    return fx.table(spark, sf, "labels").select("doc_id", X.to_string("quality").alias("quality"),
                                                X.to_string("toxic").alias("toxic"))


@query
def q_argmax_class(spark, sf):
    return predicted(spark, sf).select("vec_id", "predicted_id")


@query
def q_softmax(spark, sf):
    p = fx.scored(spark, sf).select("vec_id", L.softmax("logits").alias("p"))
    return p.select("vec_id", F.posexplode("p").alias("class_id", "probability")) \
        .select("vec_id", "class_id", r6("probability").alias("probability"))


@query
def q_confidence(spark, sf):
    s = S.score_logits(fx.scored(spark, sf), SCORED_CLASSES)
    return s.select("vec_id", r6("confidence").alias("confidence"))


@query
def q_probability_map(spark, sf):
    s = S.score_logits(fx.scored(spark, sf), SCORED_CLASSES)
    e = S.explode_probabilities(s, "vec_id")
    return e.select("vec_id", "class_label", r6("probability").alias("probability"))


# ---------------------------------------------------------------- 2.8 ranking, sort, limit

@query
def q_build_label_map(spark, sf):
    return LB.build_label_map(cleaned(spark, sf))


@query
def q_stratified_split(spark, sf):
    return SP.stratified_split(cleaned(spark, sf), "doc_id").select("doc_id", "label", "split")


@query
def q_train_test_split(spark, sf):
    return SP.train_test_split(cleaned(spark, sf), "doc_id").select("doc_id", "label", "split")


@query
def q_preview_rows(spark, sf):
    df = C.clean_labelled(gappy(spark, sf))
    return C.preview_rows(C.blank_rows(df), "doc_id", 5).select("doc_id", "text", "label")


def epoch_history(spark, sf) -> DataFrame:
    """A metric table per 'epoch' derived from ``scored`` (``vec_id % 4 + 1`` plays the epoch)."""
    df = predicted(spark, sf).withColumn("epoch", (F.col("vec_id") % 4 + 1).cast("int"))
    return M.metrics_from_confusion(M.confusion_counts(df, "label", "predicted_id", ["epoch"]), ["epoch"])


@query
def q_best_candidates(spark, sf):
    from textgate.plans.training import best_candidates
    return best_candidates(epoch_history(spark, sf)).select(
        "epoch", r6("accuracy").alias("accuracy"), r6("f1_macro").alias("f1_macro"))


# ---------------------------------------------------------------- 2.11 evaluation family

def scored_conf(spark, sf) -> DataFrame:
    return M.confusion_counts(predicted(spark, sf), "label", "predicted_id")


@query
def q_confusion_counts(spark, sf):
    return scored_conf(spark, sf)


@query
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(scored_conf(spark, sf), list(range(10)), SCORED_CLASSES)


@query
def q_confusion_matrix_prefixed(spark, sf):
    return M.confusion_matrix_prefixed(scored_conf(spark, sf), list(range(10)), SCORED_CLASSES)


@query
def q_classification_report(spark, sf):
    return report_cols(M.report_from_confusion(scored_conf(spark, sf)))


@query
def q_misclassified(spark, sf):
    s = S.score_logits(fx.scored(spark, sf).withColumn("label", F.col("label").cast("string")), SCORED_CLASSES)
    return M.misclassified(s, "label", "predicted_label").select("vec_id", "label", "predicted_label")


@query
def q_evaluate_per_split(spark, sf):
    df = predicted(spark, sf).withColumn("split", F.when(F.col("vec_id") % 2 == 0, "train").otherwise("test"))
    conf = M.confusion_counts(df, "label", "predicted_id", ["split"])
    return report_cols(M.report_from_confusion(conf, ["split"]), ["split"])


# ---------------------------------------------------------------- 2.10 tokens and batch functions

@query
def q_tokenise(spark, sf):
    df = E.tokenise(cleaned(spark, sf), out="all_tokens", max_length=None)
    cut = F.slice("all_tokens", 1, E.MAX_LENGTH)
    return df.select("doc_id", F.array_join(cut, " ").alias("tokens"), F.size(cut).alias("n_tokens"),
                     F.size("all_tokens").alias("n_tokens_full"))


@query
def q_pad_tokens(spark, sf):
    df = E.pad_tokens(E.tokenise(cleaned(spark, sf)))
    return df.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"), F.size("input_ids").alias("n_ids"),
                     F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"))


@query
def q_pad_to_group_max(spark, sf):
    tokens = E.tokenise(cleaned(spark, sf), max_length=None).withColumn("batch", F.floor(F.col("doc_id") / 8))
    # written once: the maxima and the padded rows both need the tokens
    df = E.pad_to_group_max(materialise(tokens.select("doc_id", "batch", "input_tokens"), "tokens"), "batch")
    return df.select("doc_id", "batch", F.size("input_ids").alias("n_ids"),
                     F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
                     F.array_join("input_ids", " ").alias("input_ids"))


@query
def q_assign_batches(spark, sf):
    """Batches of 8 without a dense key, padded to their longest row."""
    tokens = E.assign_batches(E.tokenise(cleaned(spark, sf), max_length=None).select("doc_id", "input_tokens"), key="doc_id")
    df = E.pad_to_group_max(materialise(tokens, "tokens"), "batch")
    return df.select("doc_id", "batch", F.size("input_ids").alias("n_ids"),
                     F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"))


def _count_words(batches):
    for b in batches:
        t = b["text"].fillna("")
        yield pd.DataFrame({"doc_id": b["doc_id"], "n_chars": t.str.len().astype("int64"),
                            "n_words": t.str.split().str.len().astype("int64")})


@query
def q_map_batches(spark, sf):
    return S.map_batches(cleaned(spark, sf).select("doc_id", "text"), _count_words,
                         "doc_id bigint, n_chars bigint, n_words bigint")


@query
def q_score_logits(spark, sf):
    s = S.score_logits(fx.scored(spark, sf), SCORED_CLASSES)
    return s.select("vec_id", "predicted_id", "predicted_label", r6("confidence").alias("confidence"))


def make_linear_predictor():
    """A fixed linear map standing in for a trained network: logit_j = e_j - e_(j+10) + e_(j+20) - ..."""
    import numpy as np

    from textgate.plans.fixtures import CLASSES, WIDTH, folded

    w = np.zeros((WIDTH, CLASSES), dtype=np.float64)
    for j, part in enumerate(folded(alternate=True)):
        for k, sign in part:
            w[k, j] = sign

    def predict(x):
        return (np.asarray(x, dtype=np.float64) @ w).astype(np.float32)

    return predict


@query
def q_score_with_model(spark, sf):
    e = fx.table(spark, sf, "embeddings").select("vec_id", "embedding")
    s = S.score_with_model(e, make_linear_predictor, "embedding", SCORED_CLASSES, input_shape=[64])
    return s.select("vec_id", "predicted_id", "predicted_label", r6("confidence").alias("confidence"))


def make_ragged_predictor():
    import numpy as np

    def predict(input_ids, attention_mask):
        n = np.maximum(attention_mask.sum(1), 1)
        return np.stack([(input_ids % m * attention_mask).sum(1) / n for m in (2, 3, 5)], axis=1)

    return predict


@query
def q_score_with_inputs(spark, sf):
    """Ids (word lengths) and mask of every document's tokens, ragged, through one predictor."""
    tokens = E.tokenise(cleaned(spark, sf), max_length=None)
    ids = tokens.select("doc_id", F.transform("input_tokens", lambda t: F.length(t)).alias("input_ids"),
                        F.transform("input_tokens", lambda t: F.lit(1)).alias("attention_mask"))
    s = S.score_with_inputs(ids, make_ragged_predictor, ["input_ids", "attention_mask"], ["two", "three", "five"])
    return s.select("doc_id", "predicted_id", "predicted_label", r6("confidence").alias("confidence"))


# ---------------------------------------------------------------- 2.1 / 2.2 sources and sinks (round trips)
# Each writes under the session's checkpoint folder (a fresh path per call) and reads it back.

def _scratch(spark, name):
    from textgate.session import scratch_path

    return scratch_path(spark, name)


def _as_clean(df: DataFrame) -> DataFrame:
    return C.clean_labelled(df).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "label", "subtype")


@query
def q_read_labelled(spark, sf):
    from textgate.sources import readers as R
    from textgate.sources import writers as W

    path = _scratch(spark, "raw-semicolon")
    W.write_table(fx.dirty(spark, sf), path, sep=";")
    return _as_clean(R.read_labelled(spark, path, ";"))


@query
def q_read_labelled_auto(spark, sf):
    from textgate.sources import readers as R
    from textgate.sources import writers as W

    path = _scratch(spark, "raw-comma")
    W.write_table(fx.dirty(spark, sf), path, sep=",")
    return _as_clean(R.read_labelled_auto(spark, path))


@query
def q_read_labelled_dialects(spark, sf):
    """The whole table as files of four dialects in one folder, each with its own column order; texts with
    newlines, quotes and the other dialects' delimiters, and ranges of 64 kB."""
    from textgate.sources import readers as R
    from textgate.sources import writers as W

    path, part = _scratch(spark, "raw-dialects"), F.pmod(F.xxhash64("doc_id"), F.lit(4))
    rows = fx.dirty(spark, sf).select("doc_id", F.concat(F.lit(" \n\"; , \t|' \n"), F.col("text"), F.lit("\n;'|")).alias("text"), "label", "subtype")
    for k, (sep, quote) in enumerate(((";", '"'), (",", '"'), ("\t", "'"), ("|", '"'))):
        columns = rows.columns[k:] + rows.columns[:k]
        rows.filter(part == k).select(columns).write.mode("append").options(**{**W.WRITE_CSV, "quote": quote, "escape": quote}, sep=sep).csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 16))
        back = R.read_labelled_auto(spark, path)  # which keeps these ranges
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return _as_clean(back)


def _in_order(df: DataFrame, files: int) -> DataFrame:
    """Rows as files whose order is that of doc_id."""
    return df.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")


@query
def q_zip_as_placed(spark, sf):
    """Predictions without a key, put beside the rows that they were made of, in the order of the files."""
    from textgate.sources import positions as P

    rows, path = cleaned(spark, sf), _scratch(spark, "placed")
    _in_order(rows, 5).select("doc_id", "label").write.parquet(f"{path}/rows")
    _in_order(rows, 3).select(F.upper("label").alias("predicted_label"), F.length("text").alias("n_chars")).write.parquet(f"{path}/predictions")
    return P.zip_as_placed(P.read_placed(spark, f"{path}/rows"), P.read_placed(spark, f"{path}/predictions"))


@query
def q_preview_file_order(spark, sf):
    """The first five blank rows of a CSV folder, in the order of its files, with their row numbers."""
    from textgate.sources import positions as P
    from textgate.sources import readers as R
    from textgate.sources import writers as W

    path = _scratch(spark, "raw-placed")
    W.write_table(_in_order(gappy(spark, sf), 4), path, sep=";")
    rows = R.read_labelled(spark, path, position="position")
    blank = C.blank_rows(C.fill_text_label(rows))
    return P.first_rows(blank).select(F.col("doc_id").cast("bigint").alias("doc_id"), "position")


@query
def q_write_table(spark, sf):
    from textgate.sources import readers as R
    from textgate.sources import writers as W

    s = S.score_logits(fx.scored(spark, sf).withColumn("label", F.col("label").cast("string")), SCORED_CLASSES)
    path = _scratch(spark, "misclassified")
    W.write_misclassified(M.misclassified(s, "label", "predicted_label").select("vec_id", "label", "predicted_label"),
                          path)
    back = spark.read.options(**R.CSV_OPTIONS, sep=",").csv(path)
    return back.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "predicted_label")


@query
def q_write_splits(spark, sf):
    from textgate.sources import writers as W

    path = _scratch(spark, "splits")
    W.write_splits(SP.stratified_split(cleaned(spark, sf), "doc_id"), path)
    return spark.read.parquet(path).select("doc_id", "text", "label", "subtype", "split")


@query
def q_read_splits(spark, sf):
    from textgate.sources import readers as R
    from textgate.sources import writers as W

    path = _scratch(spark, "splits")
    W.write_splits(SP.stratified_split(cleaned(spark, sf), "doc_id"), path)
    back = R.read_splits(spark, path)
    if back is None:
        raise RuntimeError("stored splits incomplete")
    return back.select("doc_id", "label", "split")


@query
def q_write_metrics(spark, sf):
    from textgate.sources import writers as W

    path = _scratch(spark, "metrics")
    W.write_metrics(M.metrics_from_confusion(scored_conf(spark, sf)), path)
    back = spark.read.json(path)
    return back.select(r6("accuracy").alias("accuracy"), r6("f1_macro").alias("f1_macro"))


@query
def q_write_label_map(spark, sf):
    from textgate.sources import writers as W

    path = _scratch(spark, "labels")
    W.write_label_map(spark, LB.build_label_map(cleaned(spark, sf)), path)
    raw = spark.read.option("multiLine", True).schema("label2id map<string,int>, id2label map<string,string>").json(path)
    return raw.select(F.explode("id2label").alias("id", "label"))


@query
def q_read_label_map(spark, sf):
    from textgate.sources import readers as R
    from textgate.sources import writers as W

    path = _scratch(spark, "labels")
    W.write_label_map(spark, LB.build_label_map(cleaned(spark, sf)), path)
    return R.read_label_map(spark, path)


def _read_csv(spark, path) -> DataFrame:
    from textgate.sources import readers as R

    return spark.read.options(**R.CSV_OPTIONS, sep=",").csv(path)


@query
def q_write_history(spark, sf):
    from textgate.sources import writers as W

    path = _scratch(spark, "history")
    if not W.write_history(epoch_history(spark, sf), path):
        raise RuntimeError("no history was written")
    back = _read_csv(spark, path)
    return back.select(F.col("epoch").cast("int").alias("epoch"), *[r6(F.col(c).cast("double")).alias(c) for c in ("accuracy", "f1_macro")])


@query
def q_write_report(spark, sf):
    from textgate.sources import writers as W

    path = _scratch(spark, "report")
    W.write_report(M.report_from_confusion(scored_conf(spark, sf)), path)
    back = _read_csv(spark, path).withColumnRenamed("f1-score", "f1_score")
    return back.select("class", *[r6(F.col(c).cast("double")).alias(c) for c in ("precision", "recall", "f1_score", "support")])


@query
def q_write_confusion(spark, sf):
    from textgate.sources import writers as W

    path = _scratch(spark, "confusion")
    W.write_confusion(M.confusion_matrix(scored_conf(spark, sf), list(range(10)), SCORED_CLASSES), path)
    back = _read_csv(spark, path)
    return back.select(back.columns[0], *[F.col(c).cast("bigint").alias(c) for c in back.columns[1:]])


# ---------------------------------------------------------------- 2.10 training and scoring (pyspark.ml)

_TRAINED: dict = {}


def _exported(spark, root) -> bool:
    """Whether the splits and the model, each published by its last write, are still at ``root``."""
    from textgate.sources import manifest as MF

    return all(MF.latest(spark, f"{root}/{part}") is not None for part in ("splits", "model"))


def trained(spark, sf):
    """Train once per (session, tables) and export under the checkpoint folder; reused by the
    queries that need a model, unless that folder has been cleared since: then it is trained again."""
    from textgate.plans.training import train_gate

    k = (spark.sparkContext.applicationId, sf)
    if k not in _TRAINED or not _exported(spark, _TRAINED[k][1]):
        root = _scratch(spark, "gate")
        _TRAINED[k] = (train_gate(fx.dirty(spark, sf), "doc_id", save_to=root), root)
    return _TRAINED[k]


@query
def q_train_candidates(spark, sf):
    """Per epoch: the history's metrics against those of the validation rows scored by that epoch's state."""
    from textgate.plans.training import log_loss, materialise_splits, train_candidates

    s = materialise_splits(SP.stratified_split(cleaned(spark, sf), "doc_id"), _scratch(spark, "splits"))
    valid = s.filter(F.col("split") == "validation")
    hist, models = train_candidates(s.filter(F.col("split") == "train"), valid)
    rows = valid.select("doc_id", "text", "label")
    for epoch, model in models.items():
        rows = rows.withColumn(f"p{epoch}", model.probabilities("text"))
    each = F.explode(F.map_from_arrays(F.array(*[F.lit(e) for e in models]), F.array(*[f"p{e}" for e in models]))).alias("epoch", "p")
    label_id = F.array_position(F.array(*[F.lit(x) for x in models[1].labels]), F.col("label")) - 1
    direct = materialise(rows.select(label_id.alias("label_id"), each).withColumns(
        {"predicted_id": L.argmax_class("p").cast("long"), "loss": log_loss(F.col("p"), F.col("label_id"))}), "candidates")
    recall = [F.count_if((F.col("label_id") == k) & (F.col("predicted_id") == k)) for k in (0, 1)]
    size = [F.count_if(F.col("label_id") == k) + F.count_if(F.col("predicted_id") == k) for k in (0, 1)]
    f1 = [F.when(n > 0, 2 * hit / n).otherwise(F.when(F.count("*") > 0, 0.0)) for hit, n in zip(recall, size)]
    seen = [F.when(n > 0, 1).otherwise(0) for n in size]
    direct = direct.groupBy(F.col("epoch").alias("own")).agg(
        F.avg((F.col("label_id") == F.col("predicted_id")).cast("double")).alias("hits"),
        ((f1[0] + f1[1]) / (seen[0] + seen[1])).alias("f1"), F.avg("loss").alias("mean_loss"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-9
    return hist.join(direct, F.col("epoch") == F.col("own")).select(
        "epoch", near("accuracy", "hits").alias("accuracy_agrees"), near("f1_macro", "f1").alias("macro_agrees"),
        near("loss", "mean_loss").alias("loss_agrees"))


@query
def q_train_gate(spark, sf):
    res, _ = trained(spark, sf)
    return res.splits.groupBy("split", "label").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query
def q_save_model(spark, sf):
    from textgate.sources import manifest as MF
    from textgate.sources.readers import read_label_map

    _, root = trained(spark, sf)
    return read_label_map(spark, f"{root}/model/{MF.latest(spark, f'{root}/model')['version']}/labels")


@query
def q_load_model(spark, sf):
    from textgate.sources.readers import load_model

    res, root = trained(spark, sf)
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    loaded = S.score(docs, load_model(spark, f"{root}/model")).select(
        "doc_id", F.col("predicted_label").alias("loaded_label"), F.col("class_probs").alias("loaded_probs"))
    own = S.score(docs, res.model).select(F.col("doc_id").alias("own_id"), "predicted_label", "class_probs")
    same = (F.col("loaded_label") == F.col("predicted_label")) & (F.col("loaded_probs") == F.col("class_probs"))
    return loaded.join(own, F.col("doc_id") == F.col("own_id")).select("doc_id", same.alias("same_as_in_memory"))


@query
def q_score(spark, sf):
    """Every document's prediction against one from joins alone: its words' counts meet the table of weights."""
    from textgate.plans.epochs import token_ids

    res, _ = trained(spark, sf)
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    scored = S.score(docs, res.model)
    weights = materialise(res.model.weights_table(spark), "weights")
    # a document's words are counted where its ids are: before they become a row each, not after
    placed = docs.filter("doc_id IS NOT NULL").select("doc_id", token_ids("text", len(res.model.idf)).alias("ids")) \
        .repartition(max(spark.sparkContext.defaultParallelism, docs.count() // 4096), "doc_id")
    # explode would have Spark filter by the list's size beforehand, and so make the list three times
    words = placed.select("doc_id", F.explode_outer("ids").alias("feature")).groupBy("doc_id", "feature").agg(F.count("*").alias("tf"))
    part = lambda k: F.sum(F.col("tf") * F.col("idf") * F.col("weights")[k])
    summed = words.join(weights, "feature").groupBy(F.col("doc_id").alias("own")).agg(
        F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("norm"), part(0).alias("s0"), part(1).alias("s1"))
    b0, b1 = (float(x) for x in res.model.weights[-1])
    length = F.when(F.col("norm") > 0, F.col("norm"))
    odds = F.coalesce((F.col("s1") - F.col("s0")) / length, F.lit(0.0)) + (b1 - b0)
    p1 = 1 / (1 + F.exp(-odds))
    values = F.map_values("probabilities")
    label = F.when(odds > 0, res.model.labels[1]).otherwise(res.model.labels[0])
    return scored.join(summed, F.col("doc_id") == F.col("own"), "left").select(
        "doc_id", F.size("probabilities").alias("n_classes"),
        r6(F.aggregate(values, F.lit(0.0), lambda a, x: a + x)).alias("probability_sum"),
        ((F.col("predicted_label") == label) | (F.abs(odds) < 1e-9)).alias("label_agrees"),
        (F.abs(F.col("confidence") - F.greatest(p1, 1 - p1)) < 1e-9).alias("confidence_agrees"))


@query
def q_evaluate_model(spark, sf):
    """Per split: the report's supports, with its summary rows checked against the scored rows."""
    from textgate.plans.training import evaluate_model

    res, root = trained(spark, sf)
    rows = spark.read.parquet(f"{root}/splits").drop(*C.quality_flags())
    ev = evaluate_model(rows, res.model, by=["split"])
    report = materialise(ev.report, "report")
    hit = (F.col("label") == F.col("predicted_label")).cast("double")
    p = F.col("probabilities")[F.col("label")]
    direct = ev.scored.groupBy("split").agg(F.avg(hit).alias("hits"), F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("mean_loss"))
    direct = materialise(direct.join(ev.loss, "split"), "direct")
    ev.release()
    classes = report.filter(F.col("class").isin(res.model.labels))
    macro = classes.groupBy("split").agg(F.avg("f1_score").alias("mean_f1"))
    said = report.groupBy("split").agg(F.max(F.when(F.col("class") == "accuracy", F.col("precision"))).alias("said_accuracy"),
                                       F.max(F.when(F.col("class") == "macro avg", F.col("f1_score"))).alias("said_macro"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) < 1e-9
    return classes.join(macro, "split").join(said, "split").join(direct, "split").select(
        "split", "class", F.col("support").cast("bigint").alias("support"), near("said_accuracy", "hits").alias("accuracy_agrees"),
        near("said_macro", "mean_f1").alias("macro_agrees"), near("loss", "mean_loss").alias("loss_agrees"))


@query
def q_report_listed_classes(spark, sf):
    """The report over classes 1..9 with target names: class 0 left out, class 9 unseen in train."""
    df = predicted(spark, sf).withColumn("split", F.when(F.col("label") == 9, "test").when(F.col("vec_id") % 2 == 0, "train").otherwise("test"))
    conf = M.confusion_counts(df, "label", "predicted_id", ["split"])
    listed = list(range(1, 10))
    rep = M.report_from_confusion(conf, ["split"], listed, [f"class {i}" for i in listed])
    return report_cols(rep, ["split"]).drop("row_order").filter(~F.col("class").isin("macro avg", "weighted avg"))


# ---------------------------------------------------------------- 2.12 streaming

def _question_files(spark, sf):
    """``edgy_asks`` as Parquet files that a stream can read: (folder, schema)."""
    rows = edgy_asks(spark, sf).withColumn("role", F.lit("user"))
    path = _scratch(spark, "asks")
    rows.write.parquet(path)
    return path, rows.schema


@query
def q_stream_clean(spark, sf):
    from textgate.streaming.questions import stream_clean

    source, schema = _question_files(spark, sf)
    sink, ckpt = _scratch(spark, "stream-clean"), _scratch(spark, "stream-clean-ckpt")
    stream_clean(spark, source, schema, sink, ckpt, max_files_per_trigger=1000).awaitTermination()
    return spark.read.parquet(sink)


@query
def q_stream_sessions(spark, sf):
    """All turns, dealt to files by a hash, so that they arrive in no order and over several triggers."""
    from textgate.streaming.sessions import stream_sessions

    k = (F.col("conv_id") + F.col("turn")) % 7
    edgy = F.when(k == 0, F.lit("   ")).when(k == 1, F.lit(" Salir ")).when(k == 2, F.lit("EXIT")).otherwise(F.col("text"))
    rows = fx.table(spark, sf, "conversations").select("conv_id", "turn", "role", edgy.alias("text"))
    source, sink, ckpt = (_scratch(spark, f"sessions-{x}") for x in ("in", "out", "ckpt"))
    rows.repartition(6, F.xxhash64("conv_id", "turn")).write.parquet(source)
    stream_sessions(spark, source, rows.schema, sink, ckpt, max_files_per_trigger=2).awaitTermination()
    return spark.read.parquet(sink)


@query
def q_stream_score(spark, sf):
    from textgate.streaming.questions import stream_score

    res, _ = trained(spark, sf)
    source, schema = _question_files(spark, sf)
    sink, ckpt = _scratch(spark, "stream-score"), _scratch(spark, "stream-score-ckpt")
    stream_score(spark, source, schema, res.model, sink, ckpt, max_files_per_trigger=1000).awaitTermination()
    streamed = spark.read.parquet(sink).select("conv_id", "turn", "predicted_label", "confidence")
    batch = S.score(C.drop_control_words(C.drop_blank_asks(edgy_asks(spark, sf))), res.model).select(
        F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("predicted_label").alias("label"), F.col("confidence").alias("conf"))
    both = streamed.join(batch, (F.col("conv_id") == F.col("c")) & (F.col("turn") == F.col("t")), "full")
    same = F.coalesce((F.col("predicted_label") == F.col("label")) & (F.col("confidence") == F.col("conf")), F.lit(False))
    return both.select("conv_id", "turn", same.alias("same_as_batch"))


# ---------------------------------------------------------------- the end-to-end slice (entry)

@query
def q_split_profile(spark, sf):
    from textgate.plans.flagship import split_profile

    return split_profile(spark, sf)
