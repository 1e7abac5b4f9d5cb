"""Load-time cleaning, normalisation and quality checks.

Every operator is ``DataFrame -> DataFrame`` with column names as arguments, so they chain with
``df.transform``. Checks that must raise (``assert_no_blank``, ``validate_labels``) run one job
each and bring at most a few rows, or the sorted bad-label list, to the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgate.functions.text import fill_blank, is_blank, lowercase, strip, strip_collapse
from textgate.session import scratch_path

# Fixed values that must equal the reference's.
ALLOWED_LABELS = ("valida", "no_valida")
DEFAULT_SUBTYPE = "sin_subtipo"
CONTROL_WORDS = ("salir", "exit", "quit")
REQUIRED_COLUMNS = ("text", "label")


def clean_header(df: DataFrame) -> DataFrame:
    """Strip a BOM and surrounding blanks from column names."""
    return df.toDF(*[c.replace("\ufeff", "").strip() for c in df.columns])


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Plan-time check: raise naming the first missing column (no job runs)."""
    for c in required:
        if c not in df.columns:
            raise ValueError(f"the dataset must contain the column '{c}'")
    return df


def fill_text_label(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Null text/label → '', cast to string, strip."""
    return df.withColumns({text: fill_blank(text), label: fill_blank(label)})


def default_subtype(df: DataFrame, subtype: str = "subtype", default: str = DEFAULT_SUBTYPE) -> DataFrame:
    """Missing column → constant default; null → default; a blank value stays blank after strip."""
    if subtype not in df.columns:
        return df.withColumn(subtype, F.lit(default))
    return df.withColumn(subtype, fill_blank(subtype, default))


def normalise(df: DataFrame, text: str | None = "text", label: str = "label", subtype: str = "subtype") -> DataFrame:
    """text: strip + collapse whitespace runs; label, subtype: strip + lowercase.

    Nulls stay null (fill them first with ``fill_text_label`` / ``default_subtype``). With
    ``text=None`` only the label and subtype are normalised (checks do not need the text regex:
    a text is blank before normalisation exactly when it is blank after).
    """
    cols = {label: lowercase(strip(label))}
    if text is not None:
        cols[text] = strip_collapse(text)
    if subtype in df.columns:
        cols[subtype] = lowercase(strip(subtype))
    return df.withColumns(cols)


def select_core(df: DataFrame, key: str | Sequence[str] | None = None,
                columns: Sequence[str] = ("text", "label", "subtype")) -> DataFrame:
    """Keep the key column(s), then text, label, subtype."""
    keys = [] if key is None else ([key] if isinstance(key, str) else list(key))
    return df.select(*keys, *columns)


def load_clean(df: DataFrame, text: str = "text", label: str = "label", subtype: str = "subtype",
               default: str = DEFAULT_SUBTYPE) -> DataFrame:
    """Load-time cleaning: header names, required columns, fill + strip, default subtype."""
    df = require_columns(clean_header(df), (text, label))
    return default_subtype(fill_text_label(df, text, label), subtype, default)


def clean_labelled(df: DataFrame, text: str = "text", label: str = "label", subtype: str = "subtype",
                   default: str = DEFAULT_SUBTYPE) -> DataFrame:
    """Load-time cleaning followed by ``normalise`` (one projection, no shuffle)."""
    return normalise(load_clean(df, text, label, subtype, default), text, label, subtype)


# ---------------------------------------------------------------- quality checks

def blank_rows(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Rows whose text or label is empty after cleaning (null counts as empty)."""
    return df.filter(F.coalesce(F.col(text), F.lit("")).eqNullSafe("")
                     | F.coalesce(F.col(label), F.lit("")).eqNullSafe(""))


def preview_rows(df: DataFrame, key: str | Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """First ``n`` rows by key (top-k per partition, then a merge: bounded driver load)."""
    if key is None:
        return df.limit(n)
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(*keys).limit(n)


def assert_no_blank(df: DataFrame, text: str = "text", label: str = "label",
                    key: str | Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """Raise when a text or label is blank, showing the first ``n`` offending rows."""
    rows = preview_rows(blank_rows(df, text, label), key, n).collect()
    if rows:
        preview = [r.asDict() for r in rows]
        raise ValueError(f"the dataset contains blank rows. Examples: {preview}")
    return df


def unexpected_labels(df: DataFrame, label: str = "label",
                      allowed: Sequence[str] = ALLOWED_LABELS) -> DataFrame:
    """Distinct labels outside the allowed set, sorted (null counts as unexpected)."""
    ok = F.coalesce(F.col(label).isin(list(allowed)), F.lit(False))
    return df.select(label).filter(~ok).distinct().orderBy(label)


def validate_labels(df: DataFrame, label: str = "label", allowed: Sequence[str] = ALLOWED_LABELS,
                    shown: int = 100) -> DataFrame:
    """Raise on unexpected labels; returns ``df`` unchanged otherwise.

    The message shows the first ``shown`` of them in order and, when there are more, their count
    and the table in the scratch folder that lists every one.
    """
    bad = unexpected_labels(df, label, allowed)
    some = [r[0] for r in bad.limit(shown + 1).collect()]
    if len(some) > shown:
        path = scratch_path(df.sparkSession, "unexpected-labels")
        bad.write.parquet(path)
        raise ValueError(f"{bad.count()} unsupported labels found: {some[:shown]} and the others in {path}")
    if some:
        raise ValueError(f"unsupported labels found: {some}")
    return df


def quality_summary(df: DataFrame, text: str = "text", label: str = "label",
                    allowed: Sequence[str] = ALLOWED_LABELS) -> DataFrame:
    """One scan: row count, blank rows, rows with a bad label, distinct bad labels.

    Grouped first by the bad label (null for good rows), so each task ships one partial
    row per distinct bad label; the final one-row aggregate reads that small table.
    """
    ok = F.coalesce(F.col(label).isin(list(allowed)), F.lit(False))
    blank = is_blank(text) | is_blank(label)
    per_bad = (df.groupBy(F.when(~ok, F.coalesce(F.col(label), F.lit("\u0000null"))).alias("_bad"))
               .agg(F.count(F.lit(1)).alias("_n"), F.count_if(blank).alias("_nb")))
    return per_bad.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum("_nb"), F.lit(0)).cast("bigint").alias("n_blank"),
        F.coalesce(F.sum(F.when(F.col("_bad").isNotNull(), F.col("_n"))), F.lit(0)).cast("bigint")
        .alias("n_bad_label_rows"),
        F.count("_bad").cast("bigint").alias("n_bad_labels"),
    )


def quality_flags(text: str = "text", label: str = "label", allowed: Sequence[str] = ALLOWED_LABELS) -> dict:
    """The load checks as two boolean columns, to be written beside the rows on a pass that runs
    anyway; counting them later reads two one-bit columns instead of the texts."""
    ok = F.coalesce(F.col(label).isin(list(allowed)), F.lit(False))
    return {"_blank_row": is_blank(text) | is_blank(label), "_bad_label": ~ok}


def count_flags(df: DataFrame) -> dict:
    r = df.agg(F.count_if("_blank_row").alias("n_blank"), F.count_if("_bad_label").alias("n_bad_label_rows")).first()
    return r.asDict()


def raise_on_quality(df: DataFrame, counts, text: str = "text", label: str = "label",
                     allowed: Sequence[str] = ALLOWED_LABELS, key: str | Sequence[str] | None = None) -> None:
    """Raise from check counts (``n_blank``, ``n_bad_label_rows``); the preview rows or the sorted
    bad labels are read from ``df`` only then."""
    if counts["n_blank"]:
        rows = preview_rows(df.filter(is_blank(text) | is_blank(label)), key, 5).collect()
        raise ValueError(f"the dataset contains blank rows. Examples: {[r.asDict() for r in rows]}")
    if counts["n_bad_label_rows"]:
        validate_labels(df, label, allowed)


def check_quality(df: DataFrame, text: str = "text", label: str = "label",
                  allowed: Sequence[str] = ALLOWED_LABELS, key: str | Sequence[str] | None = None) -> DataFrame:
    """Both load checks from one scan (``quality_summary``); the preview rows or the sorted bad
    labels are fetched only when a check fails. Returns ``df`` unchanged."""
    raise_on_quality(df, quality_summary(df, text, label, allowed).first(), text, label, allowed, key)
    return df


def drop_blank_asks(df: DataFrame, text: str = "text") -> DataFrame:
    """Skip questions that are empty after strip; the kept text is stripped."""
    return df.withColumn(text, strip(text)).filter(~is_blank(text))


def is_control_word(text: str = "text", words: Sequence[str] = CONTROL_WORDS):
    """Whether the stripped, lower-cased text is a control word (``salir``/``exit``/``quit``); false for null."""
    return F.coalesce(F.lower(strip(text)).isin([x.lower() for x in words]), F.lit(False))


def drop_control_words(df: DataFrame, text: str = "text", words: Sequence[str] = CONTROL_WORDS) -> DataFrame:
    """Drop rows whose text is a control word. Later turns of the session stay: ``end_sessions`` ends it."""
    return df.filter(~is_control_word(text, words))


def end_sessions(df: DataFrame, conv: str | Sequence[str] = "conv_id", turn: str = "turn", text: str = "text",
                 words: Sequence[str] = CONTROL_WORDS) -> DataFrame:
    """The questions of each conversation before its first control word, stripped, without blank ones.

    Rows at the control word's turn and later ones are dropped. Rows without a conversation or a turn
    belong to no session: they are kept unless blank or a control word. The first control turn per
    conversation, an aggregate with one row for each that has one, is joined to the questions, so no
    conversation is brought together in one task.
    """
    keys = [conv] if isinstance(conv, str) else list(conv)
    own, end = [f"_c{i}_{uuid.uuid4().hex[:8]}" for i in range(len(keys))], f"_end_{uuid.uuid4().hex[:8]}"
    ends = df.filter(is_control_word(text, words) & F.col(turn).isNotNull()) \
        .groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own)]).agg(F.min(turn).alias(end))
    asks = drop_control_words(drop_blank_asks(df, text), text, words)
    same = reduce(lambda a, b: a & b, [asks[k] == ends[o] for k, o in zip(keys, own)])
    before = F.col(end).isNull() | F.col(turn).isNull() | (F.col(turn) < F.col(end))
    return asks.join(ends, same, "left").filter(before).select(*[asks[f"`{c}`"] for c in df.columns])
