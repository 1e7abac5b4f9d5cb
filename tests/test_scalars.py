import math

from textgate.functions import logits as L
from textgate.operators import encode as E
from textgate.operators import score as S


def test_argmax_ties_nan_large_empty(spark):
    df = spark.createDataFrame([(1, [2.0, 2.0]), (2, [1.0, float("nan"), 3.0]), (3, [1000.0, 0.0]), (4, [])],
                               "k int, logits array<double>")
    got = {r.k: r.p for r in df.select("k", L.argmax_class("logits").alias("p")).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: None}


def test_softmax_sums_to_one_and_is_stable(spark):
    df = spark.createDataFrame([([1000.0, 0.0],), ([0.1, 0.2, 0.3],)], "logits array<double>")
    for r in df.select(L.softmax("logits").alias("p")).collect():
        assert math.isclose(sum(r.p), 1.0)
    big = df.select(L.softmax("logits").alias("p")).first().p
    assert big[0] == 1.0 and big[1] == 0.0


def test_score_logits_fields(spark):
    df = spark.createDataFrame([(1, [0.9, 0.1]), (2, [0.2, 0.8])], "k int, logits array<double>")
    out = {r.k: r for r in S.score_logits(df, ["no_valida", "valida"]).collect()}
    assert out[1].predicted_label == "no_valida" and out[2].predicted_label == "valida"
    assert math.isclose(out[2].confidence, out[2].probabilities["valida"])
    assert math.isclose(sum(out[1].probabilities.values()), 1.0)


def test_tokens_pad_and_group_pad(spark):
    df = spark.createDataFrame([(0, "  Hola   Mundo "), (1, "a b c"), (2, "")], "k int, text string")
    t = E.pad_tokens(E.tokenise(df), max_length=4).orderBy("k").collect()
    assert t[0].input_ids == ["hola", "mundo", "<pad>", "<pad>"] and t[0].attention_mask == [1, 1, 0, 0]
    assert t[2].input_ids == ["<pad>"] * 4 and t[2].attention_mask == [0, 0, 0, 0]
    long = spark.createDataFrame([(0, " ".join(["w"] * 300))], "k int, text string")
    assert len(E.tokenise(long).first().input_tokens) == 128
    g = E.pad_to_group_max(E.tokenise(df).withColumn("b", (df.k / 2).cast("int")), "b").orderBy("k").collect()
    assert [len(r.input_ids) for r in g] == [3, 3, 0]
