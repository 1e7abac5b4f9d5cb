"""Model-facing projections: the training view and token arrays with padding and masks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgate.functions.text import attention_mask, pad_tokens as pad_expr, tokens
from textgate.operators.labels import encode_labels
from textgate.ranking import with_position

# Fixed values that must equal the reference's: the token limit, rows of a batch.
MAX_LENGTH, BATCH_SIZE = 128, 8
PAD = "<pad>"


def training_view(df: DataFrame, label_map, text: str = "text", label: str = "label",
                  key: str | Sequence[str] | None = None) -> DataFrame:
    """``(key..., text, labels)`` with the integer class id (null for an unmapped label)."""
    keys = [] if key is None else ([key] if isinstance(key, str) else list(key))
    return encode_labels(df, label_map, label, "labels").select(*keys, text, "labels")


def tokenise(df: DataFrame, text: str = "text", out: str = "input_tokens",
             max_length: int | None = MAX_LENGTH) -> DataFrame:
    """Whole-text lower-cased whitespace tokens, cut to ``max_length`` as the reference's tokenizer
    does (``truncation=True``); ``max_length=None`` keeps them all."""
    return df.withColumn(out, tokens(text, max_length))


def pad_tokens(df: DataFrame, col: str = "input_tokens", max_length: int = MAX_LENGTH,
               out: str = "input_ids", mask: str = "attention_mask", pad: str = PAD) -> DataFrame:
    """Pad every row to ``max_length`` (``padding="max_length"``); mask 1 = real token."""
    return df.withColumns({out: pad_expr(col, max_length, pad), mask: attention_mask(col, max_length)})


def assign_batches(df: DataFrame, size: int = BATCH_SIZE, seed: int = 42, key: str | Sequence[str] | None = None,
                   out: str = "batch") -> DataFrame:
    """``df`` plus ``out``: batches 0, 1, ... of ``size`` rows (the last may have fewer), in a seeded order.

    Rows are ordered by the MD5 of the seed and ``key`` (by default of all columns) and numbered by a
    range partitioning of that order, so no task holds more than its range and reruns agree, however
    the table is split. Rows equal in all of it are interchangeable.
    """
    by = [key] if isinstance(key, str) else list(key or df.columns)
    place, order = (f"_{n}_{uuid.uuid4().hex[:8]}" for n in ("place", "order"))
    text = F.col(f"`{by[0]}`").cast("string") if len(by) == 1 and key else F.to_json(F.struct(*[F.col(f"`{c}`") for c in by]), {"ignoreNullFields": "false"})
    hashed = df.withColumn(order, F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(text, F.lit(""))).cast("binary")))
    return with_position(hashed, [order], place).withColumn(out, F.floor(F.col(place) / size)).drop(order, place)


def pad_to_group_max(df: DataFrame, batch: str, col: str = "input_tokens", out: str = "input_ids",
                     mask: str = "attention_mask", pad: str = PAD) -> DataFrame:
    """Pad each row to the longest row of its batch (dynamic padding).

    The batch maxima come from a partial aggregation (one row per batch and task before the
    shuffle) and are joined back on the batch id; a hot batch is split by AQE's skew-join
    handling instead of landing whole in one window task.
    """
    lens = df.groupBy(F.col(batch).alias("_batch")).agg(F.max(F.size(col)).alias("_len"))
    return df.join(lens, df[batch].eqNullSafe(lens["_batch"])).drop("_batch").withColumns(
        {out: pad_expr(col, F.col("_len"), pad), mask: attention_mask(col, F.col("_len"))}).drop("_len")


def model_columns(df: DataFrame, cols: Sequence[str] = ("input_ids", "attention_mask", "labels")) -> DataFrame:
    return df.select(*cols)
