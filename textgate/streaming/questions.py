"""Streaming gate: questions arrive as files; each is stripped, blank ones and control words are
dropped, and (optionally) the rest are scored with a model loaded once.

Stateless, append mode, exactly-once file sink with a checkpoint folder; ``availableNow`` drains
what is there and stops, a processing-time trigger keeps it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textgate.operators.clean import drop_blank_asks, drop_control_words


def read_questions(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                   role: str | None = "user", glob: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of question rows from the files of a folder (``glob`` picks file names); with
    ``role`` set, only that speaker's turns. ``max_files_per_trigger`` bounds each micro-batch."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    s = r.load(path)
    return s.filter(F.col("role") == role) if role else s


def read_question_lines(spark: SparkSession, path: str, text: str = "text",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of raw question lines (one question per line, as typed at a prompt), with the
    file each came from; no key exists for such input."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(path).select(F.col("value").alias(text), F.input_file_name().alias("source_file"))


def clean_questions(stream: DataFrame, text: str = "text") -> DataFrame:
    return drop_control_words(drop_blank_asks(stream, text), text)


def start_sink(df: DataFrame, sink: str, checkpoint: str, once: bool = True, fmt: str = "parquet",
               every: str = "10 seconds") -> StreamingQuery:
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=every)
    return w.start(sink)


def stream_clean(spark: SparkSession, source: str, schema, sink: str, checkpoint: str, keep=("conv_id", "turn"),
                 text: str = "text", once: bool = True, glob: str | None = None,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    """source → strip → drop blank → drop control words → append sink."""
    stream = read_questions(spark, source, schema, glob=glob, max_files_per_trigger=max_files_per_trigger)
    q = clean_questions(stream, text).select(*keep, text)
    return start_sink(q, sink, checkpoint, once)


def stream_score(spark: SparkSession, source: str, schema, model, sink: str, checkpoint: str,
                 keep=("conv_id", "turn"), text: str = "text", once: bool = True,
                 glob: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """… then score each question with the gate (a stateless map; the fitted pipeline ships once)."""
    from textgate.operators.score import score

    stream = read_questions(spark, source, schema, glob=glob, max_files_per_trigger=max_files_per_trigger)
    q = clean_questions(stream, text)
    s = score(q.select(*keep, text), model, text).select(
        *keep, text, "predicted_id", "predicted_label", "confidence", "probabilities")
    return start_sink(s, sink, checkpoint, once)
