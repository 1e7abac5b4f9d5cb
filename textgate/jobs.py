"""Job entry points (``spark-submit`` or ``python -m textgate.jobs``): train, evaluate, predict, stream.

    python -m textgate.jobs train    --input raw.csv --sep ';' --out OUT [--key doc_id]
    python -m textgate.jobs evaluate --out OUT
    python -m textgate.jobs predict  --out OUT --text "¿A qué hora abre la biblioteca?" [--text ...]
    python -m textgate.jobs stream   --out OUT --source DIR --sink DIR [--once]

Everything runs as Spark jobs; the session is the one ``spark-submit`` provides (or a local one).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_ID = "row_id"


def read_input(spark: SparkSession, path: str, sep: str | None, key: str | None, out: str,
               multi_line: bool = True) -> tuple[DataFrame, str]:
    """CSV (given or detected delimiter) or parquet, and its key column. CSV is written once as
    Parquet under ``out``, as only one task can read a file whose fields may hold newlines.

    Without a key column the key is a digest of the row's columns: the same for the same row,
    however the files are packed. Rows equal in everything share it, and splitting them by it
    gives the same rows in any order.
    """
    from textgate.sources import readers as R

    if path.endswith(".parquet") or sep == "parquet":
        df = spark.read.parquet(path)
    else:
        csv = R.read_labelled(spark, path, sep, multi_line) if sep else R.read_labelled_auto(spark, path, multi_line)
        csv.write.mode("overwrite").parquet(f"{out}/input")
        df = spark.read.parquet(f"{out}/input")
    if key:
        return df, key
    columns = F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return df.withColumn(ROW_ID, F.md5(F.to_json(columns, {"ignoreNullFields": "false"}))), ROW_ID


def cmd_train(spark: SparkSession, a) -> dict:
    from textgate.plans.training import train_gate

    df, key = read_input(spark, a.input, a.sep, a.key, a.out, not a.single_line)
    res = train_gate(df, key, save_to=a.out)
    hist = [r.asDict() for r in res.history.orderBy("epoch").collect()]
    return {"best_epoch": res.best_epoch, "history": hist, "model": f"{a.out}/model"}


def cmd_evaluate(spark: SparkSession, a) -> dict:
    from textgate.operators.clean import quality_flags
    from textgate.plans.training import evaluate_model, load_gate, save_evaluation

    model = load_gate(spark, f"{a.out}/model")
    splits = spark.read.parquet(f"{a.out}/splits").drop(*quality_flags())
    parts = [r[0] for r in splits.select("split").distinct().collect()]
    if "test" not in parts:
        raise ValueError(f"{a.out}/splits has no test split, only {sorted(parts)}")
    ev = evaluate_model(splits.filter(F.col("split") == "test"), model)
    save_evaluation(ev, f"{a.out}/evaluation")
    metrics = ev.metrics.first().asDict()
    ev.release()
    return metrics


def cmd_predict(spark: SparkSession, a) -> list[dict]:
    from textgate.operators.score import score_texts
    from textgate.plans.training import load_gate

    return score_texts(spark, load_gate(spark, f"{a.out}/model"), a.text)


def cmd_stream(spark: SparkSession, a) -> dict:
    from textgate.operators.score import score
    from textgate.plans.training import load_gate
    from textgate.streaming.questions import clean_questions, read_question_lines, start_sink

    model = load_gate(spark, f"{a.out}/model")
    lines = clean_questions(read_question_lines(spark, a.source))
    q = start_sink(score(lines, model).drop("class_probs"), a.sink, a.checkpoint or f"{a.sink}/_checkpoint",
                   once=a.once)
    q.awaitTermination()
    return {"sink": a.sink}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="textgate.jobs", description="Train, evaluate and apply the question gate.")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--input", required=True)
    t.add_argument("--sep", default=None, help="delimiter; omitted = detect; 'parquet' for parquet input")
    t.add_argument("--key", default=None)
    t.add_argument("--single-line", action="store_true", help="no field holds a newline: files are split across tasks")
    t.add_argument("--out", required=True)
    e = sub.add_parser("evaluate")
    e.add_argument("--out", required=True)
    pr = sub.add_parser("predict")
    pr.add_argument("--out", required=True)
    pr.add_argument("--text", action="append", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--out", required=True)
    s.add_argument("--source", required=True)
    s.add_argument("--sink", required=True)
    s.add_argument("--checkpoint", default=None)
    s.add_argument("--once", action="store_true")
    return p


COMMANDS = {"train": cmd_train, "evaluate": cmd_evaluate, "predict": cmd_predict, "stream": cmd_stream}


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    a = parser().parse_args(argv)
    if spark is None:
        from textgate.session import get_spark

        spark = get_spark()
    result = COMMANDS[a.cmd](spark, a)
    print(json.dumps(result, ensure_ascii=False, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
