"""The flagship query: the data half of training, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgate.operators.clean import count_flags, load_clean, normalise, quality_flags, raise_on_quality
from textgate.operators.split import stratified_split
from textgate.plans import fixtures as fx
from textgate.session import materialise


def split_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dirty`` → clean + normalise → checks → 70/15/15 split → rows and mean text length per
    (split, label).

    One pass reads the texts: it writes each row's length and its two check flags, from which the
    checks raise and the profile is made.
    """
    filled = load_clean(fx.dirty(spark, sf_dir))
    df = normalise(filled)
    slim = materialise(df.select("doc_id", "label", F.length("text").alias("chars"),
                                 *[c.alias(k) for k, c in quality_flags().items()]), "profile")
    raise_on_quality(df, count_flags(slim), key="doc_id")
    s = stratified_split(slim, "doc_id")
    return s.groupBy("split", "label").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.round(F.avg("chars"), 6).alias("mean_chars"))
