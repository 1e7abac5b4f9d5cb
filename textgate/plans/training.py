"""Training, selection and evaluation of the gate.

The reference fine-tunes a transformer for a few epochs and keeps the epoch with the best validation
macro-F1. Here the network is a softmax classifier over hashed TF-IDF (``plans.epochs``): its epochs
continue each other, a candidate is the state after an epoch, all candidates are scored on the
validation split in one pass, and the history table drives the choice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgate.operators import clean as C
from textgate.operators import metrics as M
from textgate.operators import split as SP
from textgate.plans import epochs as EP

# Fixed values that must equal the reference's training set-up.
EPOCHS = 4
WEIGHT_DECAY = 0.01
SAVE_TOTAL_LIMIT = 2
SEED = 42
NUM_FEATURES = 1 << 16

HISTORY_SCHEMA = T.StructType([
    T.StructField("epoch", T.IntegerType()), T.StructField("accuracy", T.DoubleType()),
    T.StructField("f1_macro", T.DoubleType()), T.StructField("loss", T.DoubleType())])


@dataclass
class GateModel:
    """Weights (features + 1 rows, the last one the bias; a column per class), the features' inverse
    document frequencies, and the class names in id order."""

    weights: np.ndarray
    idf: np.ndarray
    labels: list[str]
    text_col: str = "text"
    label_col: str = "label"

    def probabilities(self, text: str | Column) -> Column:
        """P(class) of a text, an array of doubles in id order."""
        return EP.probabilities(EP.token_ids(text, len(self.idf)), self.idf, self.weights)

    def weights_table(self, spark: SparkSession) -> DataFrame:
        """(feature, idf, weights): a row per feature, and the bias as the last."""
        flat = pa.FixedSizeListArray.from_arrays(pa.array(self.weights.ravel()), self.weights.shape[1]).cast(pa.list_(pa.float64()))
        return spark.createDataFrame(pa.table({"feature": pa.array(np.arange(len(self.weights), dtype=np.int32)),
                                               "idf": pa.array(np.append(self.idf, 0.0)), "weights": flat}))

    def save(self, path: str) -> None:
        """Export as a new version below ``path``, then publish it in the manifest. Until that last
        write readers load the version before; older versions stay."""
        from textgate.sources import manifest as MF
        from textgate.sources.writers import write_label_map

        spark = SparkSession.getActiveSession()
        version = uuid.uuid4().hex
        root = f"{path.rstrip('/')}/{version}"
        self.weights_table(spark).coalesce(1).write.parquet(f"{root}/weights")
        write_label_map(spark, self.labels, f"{root}/labels")
        meta = spark.createDataFrame([(self.text_col, self.label_col)], "text_col string, label_col string")
        meta.coalesce(1).write.mode("overwrite").json(f"{root}/meta")
        MF.publish(spark, path, version, {k: MF.digests(df)[""] for k, df in model_tables(spark, root).items()})


WEIGHTS_SCHEMA = "feature int, idf double, weights array<double>"


def model_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    from textgate.sources.readers import read_label_map

    return {"weights": spark.read.schema(WEIGHTS_SCHEMA).parquet(f"{root}/weights"), "labels": read_label_map(spark, f"{root}/labels"),
            "meta": spark.read.schema("text_col string, label_col string").json(f"{root}/meta")}


def train_candidates(train: DataFrame, validation: DataFrame, text: str = "text", label: str = "label",
                     epochs: Sequence[int] = tuple(range(1, EPOCHS + 1)), decay: float = WEIGHT_DECAY,
                     num_features: int = NUM_FEATURES, labels: Sequence[str] | None = None, batch: int = EP.BATCH,
                     rate: float = EP.RATE, seed: int = SEED) -> tuple[DataFrame, dict[int, GateModel]]:
    """One training run of max(``epochs``) epochs; the states after ``epochs`` are the candidates.

    ``labels`` are the classes in id order (sorted, of the whole table); by default those of both
    splits. They come to the driver, as does the classifier: ``num_features`` weights per class, so
    it is meant for hundreds of classes, not for label domains of any size. Token ids of both splits are
    written once; an epoch is one pass over those of the training rows, and all candidates are
    validated in one pass. Returns the history ``(epoch, accuracy, f1_macro, loss)``, where loss
    is the mean log loss of the validation rows, and the candidates.
    """
    spark = train.sparkSession
    if labels is None:
        labels = sorted(r[0] for r in train.select(label).union(validation.select(label)).distinct().collect() if r[0] is not None)
    labels = list(labels)
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(label)) - 1
    known = F.when(place >= 0, place).otherwise(F.raise_error(F.concat(F.lit("not a class of the model: "), F.coalesce(label, F.lit("null")))))
    train_ids = EP.counted(train, text, known, num_features, "train-ids")
    valid_ids = EP.counted(validation, text, known, num_features, "validation-ids")
    idf = EP.inverse_frequencies(train_ids, num_features)
    states = {e: s for e, s in enumerate(EP.train_epochs(train_ids, idf, len(labels), max(epochs), batch, rate, decay, seed), 1) if e in epochs}
    models = {e: GateModel(s.weights, idf, labels, text, label) for e, s in states.items()}
    counts = EP.validate(valid_ids, idf, [m.weights for m in models.values()])
    conf = counts.select("candidate", F.col("label_id").alias(M.TRUTH), F.col("predicted_id").alias(M.PRED), F.col("n").alias(M.N), "loss").persist()
    try:
        found = {r["candidate"]: r for r in M.metrics_from_confusion(conf.drop("loss"), ["candidate"]).collect()}
        loss = {r["candidate"]: r["loss"] for r in conf.groupBy("candidate").agg((F.sum("loss") / F.sum(M.N)).alias("loss")).collect()}
    finally:
        conf.unpersist()
    rows = [(e, float(found[k]["accuracy"] or 0.0) if k in found else 0.0, float(found[k]["f1_macro"] or 0.0) if k in found else 0.0, loss.get(k))
            for k, e in enumerate(models)]
    return spark.createDataFrame(rows, HISTORY_SCHEMA), models


def log_loss(probabilities, label_id):
    """-ln of the true class's probability (at least 1e-15); a class the model lacks counts as that."""
    p = F.coalesce(F.try_element_at(probabilities, (label_id + 1).cast("int")), F.lit(0.0))
    return -F.log(F.greatest(p, F.lit(1e-15)))


def materialise_splits(splits: DataFrame, path: str) -> DataFrame:
    """Write the split table once and read it back: the lineage (scan, cleaning regexes, ranking)
    is cut, and every later pass reads parquet with ``split`` pruned by folder."""
    from textgate.sources.writers import write_splits

    write_splits(splits, path)
    return splits.sparkSession.read.parquet(path)


def best_candidates(history: DataFrame, metric: str = "f1_macro", keep: int = SAVE_TOTAL_LIMIT) -> DataFrame:
    """Highest metric first, earliest epoch on ties; at most ``keep`` rows (top-k, a limit by design)."""
    return history.orderBy(F.desc(metric), F.asc("epoch")).limit(keep)


@dataclass
class TrainResult:
    model: GateModel
    history: DataFrame
    splits: DataFrame
    best_epoch: int


def train_gate(df: DataFrame, key: str, text: str = "text", label: str = "label", seed: int = SEED,
               epochs: Sequence[int] = tuple(range(1, EPOCHS + 1)), save_to: str | None = None,
               allowed: Sequence[str] = C.ALLOWED_LABELS) -> TrainResult:
    """Normalise → validate → split → label map → candidates → keep the best → save.

    The blank-row and label checks are written as two boolean columns beside the split table,
    so the texts are read once before training; counting the flags reads those two columns only,
    and the checks still raise, with the same messages, before any candidate is fitted.
    """
    from textgate.session import scratch_path

    clean = C.normalise(C.load_clean(df, text, label), text, label)
    root = save_to or scratch_path(df.sparkSession, "gate")
    plan = SP.stratified_split(clean, key, label, seed=seed, min_class_rows=2)
    flags = C.quality_flags(text, label, allowed)
    flagged = materialise_splits(plan.withColumns(flags), f"{root}/splits")
    C.raise_on_quality(flagged, C.count_flags(flagged), text, label, allowed, key)
    splits = flagged.drop(*flags)
    train = splits.filter(F.col("split") == "train")
    valid = splits.filter(F.col("split") == "validation")
    labels = sorted(r[0] for r in splits.select(label).distinct().collect())  # of the whole table, checked above
    history, models = train_candidates(train, valid, text, label, epochs, labels=labels)
    best = best_candidates(history).first()["epoch"]
    model = models[best]
    if save_to:
        model.save(f"{save_to}/model")
        from textgate.sources.writers import write_history

        write_history(history, f"{save_to}/history")
    return TrainResult(model, history, splits, best)


@dataclass
class Evaluation:
    metrics: DataFrame
    report: DataFrame
    confusion: DataFrame
    misclassified: DataFrame
    scored: DataFrame
    conf: DataFrame
    loss: DataFrame

    def release(self) -> None:
        """Drop the cached scored rows and confusion table once the outputs are written."""
        self.scored.unpersist()
        self.conf.unpersist()


def evaluate_model(test: DataFrame, model: GateModel, text: str = "text", label: str = "label",
                   by: Sequence[str] = ()) -> Evaluation:
    """Score the rows once (cached), aggregate the confusion once; every output reads it.

    ``by`` (such as ``["split"]``) gives metrics, report and mean log loss per group; the
    confusion matrix is over all rows.
    """
    from textgate.operators.score import score

    clean = C.normalise(test, text, label)
    C.validate_labels(clean, label, model.labels)
    true_id = F.array_position(F.array(*[F.lit(x) for x in model.labels]), F.col(label)) - 1
    scored = score(clean, model, text).withColumn("loss", log_loss(F.col("class_probs"), true_id)).drop("class_probs").persist()
    conf = M.confusion_counts(scored, label, "predicted_label", by).persist()
    overall = conf.groupBy(*[c for c in conf.columns if c not in (*by, M.N)]).agg(F.sum(M.N).alias(M.N))
    return Evaluation(
        metrics=M.metrics_from_confusion(conf, by),
        report=M.report_from_confusion(conf, by),
        confusion=M.confusion_matrix(overall, sorted(model.labels)),
        misclassified=M.misclassified(scored.drop("probabilities", "loss"), label, "predicted_label"),
        scored=scored, conf=conf, loss=scored.groupBy(*by).agg(F.avg("loss").alias("loss")))


def save_evaluation(ev: Evaluation, path: str) -> None:
    """Persist what the reference's evaluation writes: metrics JSON, report, misclassified rows
    and the confusion matrix (CSV)."""
    from textgate.sources import writers as W

    W.write_metrics(ev.metrics, f"{path}/metrics")
    W.write_report(ev.report, f"{path}/classification_report")
    W.write_misclassified(ev.misclassified.drop("predicted_id"), f"{path}/misclassified_examples")
    W.write_confusion(ev.confusion, f"{path}/confusion_matrix")


def load_gate(spark: SparkSession, path: str) -> GateModel:
    """Load the published version of an exported gate; ``FileNotFoundError`` when nothing is published
    there, ``ValueError`` when its files are not what was published. Other failures (no permission)
    come through as they are."""
    from textgate.sources import manifest as MF

    published = MF.latest(spark, path)
    if published is None:
        raise FileNotFoundError(f"no trained model at {path}")
    tables = model_tables(spark, f"{path.rstrip('/')}/{published['version']}")
    wrong = MF.differences(published["parts"], {k: MF.digests(df).get("", "0-") for k, df in tables.items()})
    if wrong:
        raise ValueError(f"the model at {path} is damaged: {'; '.join(wrong)}")
    rows = tables["weights"].orderBy("feature").toArrow()
    weights = rows.column("weights").combine_chunks()
    labels = [r["label"] for r in tables["labels"].orderBy("id").collect()]
    meta = tables["meta"].first()
    return GateModel(weights.flatten().to_numpy(zero_copy_only=False).reshape(len(weights), -1).copy(), rows.column("idf").to_numpy()[:-1].copy(), labels,
                     meta["text_col"], meta["label_col"])
