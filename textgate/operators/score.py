"""Scoring: logits → softmax → argmax → label, confidence and the per-class map.

``score_logits`` is pure Catalyst (higher-order array functions). ``score`` applies a trained
gate. ``score_with_model`` wraps a caller's batch predictor (any framework)
with ``predict_batch_udf``: Arrow batches, the model loaded once per Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgate.functions.logits import argmax_class, confidence, label_array, probability_map, softmax


def score_logits(df: DataFrame, labels: Sequence[str], logits: str = "logits", keep_logits: bool = False,
                 prob_col: str = "class_probs") -> DataFrame:
    """Add ``predicted_id``, ``predicted_label``, ``confidence``, ``probabilities`` (a map).

    ``labels`` are the class names in id order. The probability vector is kept as
    ``class_probs``. An id outside ``labels`` gives a null label.
    """
    out = df.withColumn(prob_col, softmax(logits))
    out = out.withColumn("predicted_id", argmax_class(prob_col))
    out = out.withColumns({
        "predicted_label": F.try_element_at(label_array(labels), F.col("predicted_id") + 1),
        "confidence": confidence(prob_col, "predicted_id"),
        "probabilities": probability_map(prob_col, labels),
    })
    return out if keep_logits else out.drop(logits)


def explode_probabilities(df: DataFrame, key: str | Sequence[str], col: str = "probabilities") -> DataFrame:
    """``(key..., class_label, probability)``: one row per class (the map in long form)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.select(*keys, F.explode(col).alias("class_label", "probability"))


def score(df: DataFrame, model, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Apply a trained gate (``textgate.plans.training.GateModel``) to a text column.

    The texts' tokens are hashed in the plan and their probabilities computed in Arrow batches;
    label, confidence and the map follow from them as in ``score_logits``.
    """
    scored = df.withColumn("class_probs", model.probabilities(text))
    scored = scored.withColumn("predicted_id", argmax_class("class_probs"))
    scored = scored.withColumns({
        "predicted_label": F.element_at(label_array(model.labels), F.col("predicted_id") + 1),
        "confidence": confidence("class_probs", "predicted_id"),
        "probabilities": probability_map("class_probs", model.labels),
    })
    return scored if keep is None else scored.select(*keep, "predicted_id", "predicted_label", "confidence",
                                                     "probabilities", "class_probs")


def score_with_model(df: DataFrame, make_predict_fn: Callable, input_col: str, labels: Sequence[str],
                     input_shape: Sequence[int] | None = None,
                     batch_size: int = 1024, out: str = "logits") -> DataFrame:
    """Logits from a caller-supplied batch predictor, then ``score_logits``.

    ``make_predict_fn()`` runs once per Python worker and returns ``fn(batch: ndarray) -> ndarray``
    of shape ``(rows, n_classes)``; batches are Arrow-backed and ``batch_size`` rows long.
    """
    from pyspark.ml.functions import predict_batch_udf

    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size,
                            input_tensor_shapes=[list(input_shape)] if input_shape else None)
    return score_logits(df.withColumn(out, udf(F.col(input_col))), labels, logits=out)


def score_with_inputs(df: DataFrame, make_predict_fn: Callable, inputs: Sequence[str], labels: Sequence[str], batch_size: int = 64,
                      pad: Sequence[int] | None = None, by_length: bool = True, out: str = "logits", padded: str = "padded_cells") -> DataFrame:
    """Logits from a predictor that takes several ragged inputs (such as input_ids and attention_mask),
    then ``score_logits``; ``padded`` counts the cells that padding added to a row, per input.

    ``make_predict_fn()`` runs once per task and returns ``fn(**{input: int64 array (rows, width)})`` ->
    ``(rows, n_classes)``. Rows of an Arrow batch are sorted by length and cut into batches of ``batch_size``,
    each padded with ``pad`` (0 by default) to its own longest row, at least one cell; results go back
    to their rows. A null list is an empty one. Inputs of one row must have one length.
    """
    fill = list(pad or [0] * len(inputs))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType())), T.StructField(padded, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = make_predict_fn()
        for b in batches:
            if not b.num_rows:
                continue
            lists = [b.column(b.schema.get_field_index(c)) for c in inputs]
            lengths = [x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in lists]
            if any((n != lengths[0]).any() for n in lengths):
                raise ValueError(f"{list(inputs)} differ in length within a row")
            size, values = lengths[0], [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
            starts = np.cumsum(size) - size
            order = np.argsort(size, kind="stable") if by_length else np.arange(len(size))
            logits, extra = [None] * len(size), np.zeros(len(size), np.int32)
            for at in range(0, len(order), batch_size):
                rows = order[at:at + batch_size]
                width = max(1, int(size[rows].max()))
                real = np.arange(width) < size[rows][:, None]
                arrays = {}
                for name, value, blank in zip(inputs, values, fill):
                    arrays[name] = np.full(real.shape, blank, np.int64)
                    arrays[name][real] = value[(starts[rows][:, None] + np.arange(width))[real]]
                for row, result in zip(rows.tolist(), np.asarray(predict(**arrays), float)):
                    logits[row] = result
                extra[rows] = width - size[rows]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(logits, pa.list_(pa.float64())), pa.array(extra)], [*b.schema.names, out, padded])

    return score_logits(df.mapInArrow(run, schema), labels, logits=out)


#: Rows, and characters of text, of the parts that ``map_batches`` hands to a function (one row at least).
PART_ROWS, PART_CHARS = 1024, 4 << 20


def map_batches(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """Apply ``fn(Iterator[pandas.DataFrame]) -> Iterator[pandas.DataFrame]`` to Arrow batches.

    A batch reaches ``fn`` in parts of ``PART_ROWS`` rows and ``PART_CHARS`` characters at most, so what
    ``fn`` makes of the rows before it yields does not grow with Spark's batches.
    """
    rows, chars = PART_ROWS, PART_CHARS

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b) == 0:
                yield b
            size = np.zeros(len(b), np.int64)
            for k in range(b.shape[1]):
                if not pd.api.types.is_numeric_dtype(b.dtypes.iloc[k]):
                    size += np.fromiter((len(v) if isinstance(v, (str, bytes)) else 0 for v in b.iloc[:, k]), np.int64, len(b))
            ends, at = np.cumsum(size), 0
            while at < len(b):
                before = ends[at - 1] if at else 0
                to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + chars, side="right"))))
                yield b.iloc[at:to].reset_index(drop=True)
                at = to

    return df.mapInPandas(lambda batches: fn(parts(batches)), schema)


def score_texts(spark, model, texts: Sequence[str]) -> list[dict]:
    """Score a handful of typed questions (the single-text entry point): one record per text with
    ``text``, ``predicted_label``, ``confidence`` and ``probabilities``, in input order."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_pos int, text string")
    rows = score(df, model).orderBy("_pos").select("text", "predicted_label", "confidence", "probabilities").collect()
    return [r.asDict() for r in rows]
