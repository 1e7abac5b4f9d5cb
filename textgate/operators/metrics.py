"""Evaluation family over one shuffle: the (truth, prediction) confusion counts.

Every metric here is an aggregate over ``confusion_counts``, whose output has at most K² rows
per group (K classes), so the facts are shuffled once, with map-side partial aggregation,
whatever their size. Semantics follow scikit-learn's defaults:

* classes = union of truth and prediction values, unless ``labels`` is given (then exactly
  those, unseen ones counted as zeros);
* precision / recall / F1 are 0 when their denominator is 0;
* macro = unweighted mean over the classes; weighted = mean weighted by support;
* the report has the class rows (sorted, or in ``labels`` order), then ``accuracy`` (its value
  repeated in all four columns), ``macro avg`` and ``weighted avg``. With ``labels`` that leave
  out a present class, the ``accuracy`` row becomes ``micro avg`` over the listed classes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRUTH, PRED, N = "truth", "predicted", "n"


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, truth: str = "label", pred: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    """``(by..., truth, predicted, n)``: the only shuffle of the facts; K² rows per group out."""
    t_type = df.schema[truth].dataType
    p = F.col(pred) if df.schema[pred].dataType == t_type else F.col(pred).cast(t_type)
    return (df.groupBy(*by, F.col(truth).alias(TRUTH), p.alias(PRED))
            .agg(F.count(F.lit(1)).cast("bigint").alias(N)))


def class_stats(conf: DataFrame, by: Sequence[str] = (), labels: Sequence | None = None) -> DataFrame:
    """Per class: ``tp``, ``support`` (true count), ``predicted`` (predicted count), ``listed``.

    Each confusion row is exploded into its truth-side and prediction-side contribution, so the
    confusion table is read once. ``listed`` marks the report's classes: all seen classes
    without ``labels``, else the seen classes among ``labels`` (unseen listed classes are added
    by ``report_from_confusion``; seen unlisted ones stay, ``listed = false``, for the
    micro/accuracy choice).
    """
    hit = F.col(TRUTH).eqNullSafe(F.col(PRED))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col(TRUTH).alias("class"), F.when(hit, F.col(N)).otherwise(zero).alias("tp"),
                 F.col(N).alias("support"), zero.alias("predicted")),
        F.struct(F.col(PRED).alias("class"), zero.alias("tp"), zero.alias("support"), F.col(N).alias("predicted")))
    parts = conf.select(*by, F.explode(sides).alias("_s")).select(*by, "_s.*")
    stats = parts.groupBy(*by, "class").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                            F.sum("predicted").alias("predicted"))
    listed = F.lit(True) if labels is None else F.coalesce(F.col("class").isin(list(labels)), F.lit(False))
    return stats.withColumn("listed", listed)


def _with_prf(stats: DataFrame) -> DataFrame:
    return stats.withColumns({
        "precision": _ratio(F.col("tp"), F.col("predicted")),
        "recall": _ratio(F.col("tp"), F.col("support")),
        "f1_score": _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")),
    })


def metrics_from_confusion(conf: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., accuracy, f1_macro)`` from the confusion counts (one read of ``conf``)."""
    s = _with_prf(class_stats(conf, by))
    return s.groupBy(*by).agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        F.avg("f1_score").alias("f1_macro"))


def accuracy(df: DataFrame, truth: str = "label", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction equals the truth (null-safe)."""
    hit = F.col(truth).eqNullSafe(F.col(pred)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def f1_macro(df: DataFrame, truth: str = "label", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean of per-class F1 over the classes seen in truth or prediction."""
    return metrics_from_confusion(confusion_counts(df, truth, pred, by), by).select(*by, "f1_macro")


REPORT_COLS = ("precision", "recall", "f1_score", "support")
ROW_ARRAY = "array<struct<row_order:int,class:string,precision:double,recall:double,f1_score:double,support:double>>"


def report_from_confusion(conf: DataFrame, by: Sequence[str] = (), labels: Sequence | None = None,
                          names: Sequence[str] | None = None) -> DataFrame:
    """Classification report, long form: ``(by..., row_order, class, precision, recall, f1_score, support)``.

    ``names`` renames the listed ``labels`` (target names), in the same order. Plan: the
    confusion aggregate, the per-class aggregate, then one window over each group's K class rows
    that carries the group totals; the first class row of a group also emits the summary rows
    (and zero rows for listed classes never seen), all through one ``explode``.
    """
    s = _with_prf(class_stats(conf, by, labels))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    ordered = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("class")
    lst = F.col("listed")

    def over_listed(c):
        return F.sum(F.when(lst, c).otherwise(F.lit(0))).over(w)

    g = s.withColumns({
        "_rn": F.row_number().over(ordered),
        "_k": F.lit(len(labels)) if labels is not None else F.count(F.lit(1)).over(w),
        "_tp_l": over_listed(F.col("tp")), "_sup_l": over_listed(F.col("support")),
        "_pred_l": over_listed(F.col("predicted")),
        "_tp_all": F.sum("tp").over(w), "_sup_all": F.sum("support").over(w),
        "_unlisted": F.sum(F.when(lst, 0).otherwise(1)).over(w),
        **{f"_m_{c}": over_listed(F.col(c)) for c in REPORT_COLS[:3]},
        **{f"_w_{c}": over_listed(F.col(c) * F.col("support")) for c in REPORT_COLS[:3]},
    })
    if labels is not None:
        lab = F.array(*[F.lit(x) for x in labels]).cast(
            T.ArrayType(conf.schema[TRUTH].dataType))
        nm = F.array(*[F.lit(str(x)) for x in (names if names is not None else labels)])
        g = g.withColumn("_present", F.collect_set(F.when(lst, F.col("class"))).over(w))
        own_order = (F.array_position(lab, F.col("class")) - 1).cast("int")
        own_name = F.element_at(nm, own_order + 1)
    else:
        own_order = (F.col("_rn") - 1).cast("int")
        own_name = F.col("class").cast("string")

    def row(order, name, p, r, f, sup):
        return F.struct(order.cast("int").alias("row_order"), name.cast("string").alias("class"),
                        p.cast("double").alias("precision"), r.cast("double").alias("recall"),
                        f.cast("double").alias("f1_score"), sup.cast("double").alias("support"))

    k = F.col("_k")
    acc = _ratio(F.col("_tp_all"), F.col("_sup_all"))
    micro_p, micro_r = _ratio(F.col("_tp_l"), F.col("_pred_l")), _ratio(F.col("_tp_l"), F.col("_sup_l"))
    micro_f = _ratio(2 * micro_p * micro_r, micro_p + micro_r)
    is_acc = F.col("_unlisted") == 0
    summary = [
        row(k, F.when(is_acc, F.lit("accuracy")).otherwise(F.lit("micro avg")),
            F.when(is_acc, acc).otherwise(micro_p), F.when(is_acc, acc).otherwise(micro_r),
            F.when(is_acc, acc).otherwise(micro_f), F.when(is_acc, acc).otherwise(F.col("_sup_l"))),
        row(k + 1, F.lit("macro avg"), *[_ratio(F.col(f"_m_{c}"), k) for c in REPORT_COLS[:3]], F.col("_sup_l")),
        row(k + 2, F.lit("weighted avg"), *[_ratio(F.col(f"_w_{c}"), F.col("_sup_l")) for c in REPORT_COLS[:3]],
            F.col("_sup_l")),
    ]
    own = F.when(lst, F.array(row(own_order, own_name, F.col("precision"), F.col("recall"), F.col("f1_score"),
                                  F.col("support")))).otherwise(F.array().cast(ROW_ARRAY))
    extra = F.array(*summary)
    if labels is not None:
        z = F.lit(0.0)
        unseen = F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(len(labels) - 1)),
                     lambda i: ~F.array_contains(F.col("_present"), F.element_at(lab, i + 1))),
            lambda i: row(i, F.element_at(nm, i + 1), z, z, z, z))
        extra = F.concat(unseen, extra)
    out = F.explode(F.when(F.col("_rn") == 1, F.concat(own, extra)).otherwise(own)).alias("_r")
    return g.select(*by, out).select(*by, "_r.*")


def classification_report(df: DataFrame, truth: str = "label", pred: str = "prediction",
                          by: Sequence[str] = (), labels: Sequence | None = None,
                          names: Sequence[str] | None = None) -> DataFrame:
    return report_from_confusion(confusion_counts(df, truth, pred, by), by, labels, names)


def confusion_matrix(conf: DataFrame, labels: Sequence, names: Sequence[str] | None = None,
                     row_prefix: str = "", col_prefix: str = "", first: str = "label") -> DataFrame:
    """Dense matrix: one row per truth label, one column per predicted label, both in ``labels``
    order; zeros filled; pairs outside ``labels`` ignored. Pivot values are always given, so
    the pivot needs no extra job to discover them."""
    names = [str(x) for x in (names if names is not None else labels)]
    ctype = conf.schema[TRUTH].dataType
    lab = F.array(*[F.lit(x) for x in labels]).cast(f"array<{ctype.simpleString()}>")
    kept = conf.filter(F.col(TRUTH).isin(list(labels)) & F.col(PRED).isin(list(labels)))
    zero = conf.sparkSession.range(1).select(F.explode(lab).alias(TRUTH)).select(
        TRUTH, F.col(TRUTH).alias(PRED), F.lit(0).cast("bigint").alias(N))
    both = kept.select(TRUTH, PRED, N).unionByName(zero)
    pos_t = (F.array_position(lab, F.col(TRUTH)) - 1).cast("int")
    pos_p = (F.array_position(lab, F.col(PRED)) - 1).cast("int")
    name_arr = F.array(*[F.lit(x) for x in names])
    both = both.select(pos_t.alias("row_order"), pos_p.alias("_p"), N)
    wide = both.groupBy("row_order").pivot("_p", list(range(len(names)))).agg(F.sum(N))
    return wide.select(
        "row_order",
        F.concat(F.lit(row_prefix), F.element_at(name_arr, F.col("row_order") + 1)).alias(first),
        *[F.coalesce(F.col(str(i)), F.lit(0)).cast("bigint").alias(f"{col_prefix}{nm}")
          for i, nm in enumerate(names)])


def confusion_matrix_prefixed(conf: DataFrame, labels: Sequence, names: Sequence[str] | None = None) -> DataFrame:
    """``real_<label>`` rows and ``pred_<label>`` columns."""
    return confusion_matrix(conf, labels, names, row_prefix="real_", col_prefix="pred_")


def misclassified(df: DataFrame, label: str = "label", pred: str = "predicted_label") -> DataFrame:
    """Rows whose label differs from the prediction (null-safe: a null on one side counts)."""
    return df.filter(~F.col(label).eqNullSafe(F.col(pred)))
