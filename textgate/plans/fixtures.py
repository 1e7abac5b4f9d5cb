"""Test views over the driver's tables (FIXTURES.md §3), as Spark plans and as DuckDB SQL.

The SQL text of each view is kept next to its DataFrame form so the oracle strings in
``textgate.plans.oracle`` use exactly the same definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels on doc_id; quality 1 → 'valida' else 'no_valida'; subtype = source."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    lb = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lb, "doc_id").select(
        "doc_id", "text",
        F.when(F.col("quality") == 1, "valida").otherwise("no_valida").alias("label"),
        F.col("source").alias("subtype"))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labelled`` with whitespace runs, upper-case labels and null / blank / padded subtypes."""
    k = F.col("doc_id") % 5
    return labelled(spark, sf_dir).select(
        "doc_id",
        F.concat(F.lit("  "), F.replace(F.col("text"), F.lit(" "), F.lit("   ")), F.lit(" ")).alias("text"),
        F.upper("label").alias("label"),
        F.when(k == 0, F.lit(None).cast("string")).when(k == 1, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.upper("subtype"))).alias("subtype"))


#: Elements of an embedding, and classes that they are folded into.
WIDTH, CLASSES = 64, 10


def folded(classes: int = CLASSES, alternate: bool = False) -> list[list[tuple[int, int]]]:
    """Per class, the (element, sign) pairs that make its logit: every ``classes``-th element."""
    return [[(k, -1 if alternate and k // classes % 2 else 1) for k in range(j, WIDTH, classes)] for j in range(classes)]


def folded_sql(alternate: bool = False) -> str:
    """The logits as a DuckDB list, added in the same order as in Spark."""
    def logit(part: list[tuple[int, int]]) -> str:
        return " ".join(f"{'-' if s < 0 else '+'} CAST(embedding[{k + 1}] AS DOUBLE)" for k, s in part)

    return "[" + ", ".join(f"CAST(0.0::DOUBLE {logit(p)} AS FLOAT)" for p in folded(alternate=alternate)) + "]"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings: logit j = the sum of every tenth element from j on, label = truth class 0..9."""
    e = table(spark, sf_dir, "embeddings")

    # higher-order functions keep the generated code small; elements are added in their order
    logits = F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda j: F.aggregate(
        F.filter("embedding", lambda x, i: i % CLASSES == j), F.lit(0.0), lambda total, x: total + x.cast("double")).cast("float"))
    return e.select("vec_id", logits.alias("logits"), F.col("label").cast("int").alias("label"))


def asks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns of the conversations, key (conv_id, turn)."""
    c = table(spark, sf_dir, "conversations")
    return c.filter(F.col("role") == "user").select("conv_id", "turn", "text")


# ---------------------------------------------------------------- the same views in DuckDB SQL

LABELLED_SQL = """labelled AS (
  SELECT d.doc_id, d.text,
         CASE WHEN l.quality = 1 THEN 'valida' ELSE 'no_valida' END AS label,
         d.source AS subtype
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

DIRTY_SQL = LABELLED_SQL + """,
dirty AS (
  SELECT doc_id,
         '  ' || replace(text, ' ', '   ') || ' ' AS text,
         upper(label) AS label,
         CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN '  '
              ELSE ' ' || upper(subtype) END AS subtype
  FROM labelled)"""

SCORED_SQL = f"""scored AS (
  SELECT vec_id, {folded_sql()} AS logits, CAST(label AS INTEGER) AS label FROM embeddings)"""

ASKS_SQL = """asks AS (
  SELECT conv_id, turn, text FROM conversations WHERE role = 'user')"""
