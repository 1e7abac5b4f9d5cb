import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textgate.plans import epochs as EP
from textgate.plans import training as TR
from textgate.session import scratch_path
from textgate.sources import manifest as MF

FEATURES, CLASSES = 32, 3


def table(spark, n=77, seed=1, parts=3):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(CLASSES), [rnd.randrange(FEATURES) for _ in range(rnd.choice([0, 1, 5, 30]))], rnd.getrandbits(62)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "label_id int, ids array<int>, h long").repartition(parts)


def dense(ids, idf):
    x = np.zeros(len(idf))
    for i in ids:
        x[i] += idf[i]
    return x / np.linalg.norm(x) if x.any() else x


def orders(spark, df, epoch, shards, seed=42):
    """[(shard, label, ids)] in the order of the epoch."""
    order = F.xxhash64(F.lit(seed), F.lit(epoch), "h")
    rows = df.select(F.pmod(order, F.lit(shards)).alias("shard"), F.xxhash64(order).alias("o"), "label_id", "ids").collect()
    return sorted(((r.shard, r.o, r.label_id, r.ids) for r in rows))


def plain(spark, df, idf, epochs, shards, batch, rate, decay):
    """AdamW over dense rows, step by step, shards one after the other."""
    n = df.count()
    w, m, v, t = np.zeros((FEATURES + 1, CLASSES)), np.zeros((FEATURES + 1, CLASSES)), np.zeros((FEATURES + 1, CLASSES)), 0.0
    out = []
    for epoch in range(epochs):
        merged, rows = [], orders(spark, df, epoch, shards)
        for s in range(shards):
            own = [r for r in rows if r[0] == s]
            ws, ms, vs, ts = w.copy(), m.copy(), v.copy(), t
            for k in range(0, len(own), batch):
                part = own[k:k + batch]
                x = np.array([np.append(dense(r[3], idf), 1.0) for r in part])
                p = np.exp(x @ ws) / np.exp(x @ ws).sum(1, keepdims=True)
                p[np.arange(len(part)), [r[2] for r in part]] -= 1
                g = x.T @ p / len(part)
                now = rate * (1 - (epoch + min(1.0, k / batch / math.ceil(n / (shards * batch)))) / epochs)
                ts += 1
                ws[:-1] *= 1 - now * decay
                ms, vs = 0.9 * ms + 0.1 * g, 0.999 * vs + 0.001 * g * g
                ws = ws - now * (ms / (1 - 0.9 ** ts)) / (np.sqrt(vs / (1 - 0.999 ** ts)) + 1e-8)
            merged.append((len(own), ws, ms, vs, ts))
        w, m, v, t = (sum(part[0] * part[k] for part in merged) / n for k in range(1, 5))
        out.append((w, t))
    return out


@pytest.mark.parametrize("shards", [1, 3])
def test_epochs_equal_a_plain_optimiser(spark, shards):
    rows, df = table(spark)
    idf = EP.inverse_frequencies(df, FEATURES)
    want_idf = [math.log((len(rows) + 1) / (sum(i in r[1] for r in rows) + 1)) for i in range(FEATURES)]
    assert np.allclose(idf, want_idf)
    states = list(EP.train_epochs(df, idf, CLASSES, 4, rate=0.1, decay=0.05, shards=shards))
    want = plain(spark, df, idf, 4, shards, EP.BATCH, 0.1, 0.05)
    assert len(states) == 4
    for s, (w, t) in zip(states, want):
        assert np.allclose(s.weights, w, atol=1e-9) and s.steps == pytest.approx(t)
    assert [s.seen for s in states] == [len(rows) * e for e in (1, 2, 3, 4)]  # a pass an epoch


def test_reruns_agree_whatever_the_partitions(spark):
    _, df = table(spark, 60)
    idf = EP.inverse_frequencies(df, FEATURES)
    runs = [[s.weights for s in EP.train_epochs(d, idf, CLASSES, 2, shards=2)] for d in (df, df.repartition(7), df.coalesce(1))]
    assert all((a == b).all() for run in runs[1:] for a, b in zip(runs[0], run))


def test_validation_counts_and_losses(spark):
    rows, df = table(spark, 50, 2)
    idf = EP.inverse_frequencies(df, FEATURES)
    weights = [np.random.default_rng(k).normal(size=(FEATURES + 1, CLASSES)) for k in (0, 1)]
    got = EP.validate(df, idf, weights).collect()
    for k, w in enumerate(weights):
        want, loss = {}, 0.0
        for label, ids, _ in rows:
            z = np.append(dense(ids, idf), 1.0) @ w
            p = np.exp(z) / np.exp(z).sum()
            want[label, int(p.argmax())] = want.get((label, int(p.argmax())), 0) + 1
            loss -= math.log(p[label])
        mine = [r for r in got if r.candidate == k]
        assert {(r.label_id, r.predicted_id): r.n for r in mine} == want and sum(r.loss for r in mine) == pytest.approx(loss)


def test_no_rows_and_bad_labels(spark):
    _, df = table(spark)
    assert list(EP.train_epochs(df.limit(0), np.ones(FEATURES), CLASSES, 3)) == []
    bad = spark.createDataFrame([("a", "x"), ("b", "other")], "text string, label string")
    with pytest.raises(Exception, match="not a class"):
        TR.train_candidates(bad, bad, labels=["x"])


def test_probabilities_of_any_text(spark):
    texts = [None, "", "  ", "uno dos dos", "UNO\x1cdos", "uno " * 3000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    r = np.random.default_rng(4)
    model = TR.GateModel(r.normal(size=(FEATURES + 1, 2)), r.uniform(0.5, 2, FEATURES), ["a", "b"])
    ids = {r.i: r.ids for r in df.select("i", EP.token_ids("text", FEATURES).alias("ids")).collect()}
    assert [len(ids[i]) for i in range(6)] == [0, 0, 0, 3, 2, 3000] and ids[4] == ids[3][:2]
    for row in df.select("i", model.probabilities("text").alias("p")).collect():
        z = np.append(dense(ids[row.i], model.idf), 1.0) @ model.weights
        assert np.allclose(row.p, np.exp(z) / np.exp(z).sum())


def a_model(seed):
    r = np.random.default_rng(seed)
    return TR.GateModel(r.normal(size=(FEATURES + 1, 2)), r.uniform(size=FEATURES), ["a", "b"], "t", "l")


def test_a_kill_between_any_two_writes_leaves_the_old_model(spark, monkeypatch):
    path = scratch_path(spark, "export")
    with pytest.raises(FileNotFoundError):
        TR.load_gate(spark, path)
    old, new = a_model(1), a_model(2)
    old.save(path)
    steps = [("textgate.plans.training.GateModel.weights_table", 1), ("textgate.sources.writers.write_label_map", 1),
             ("textgate.sources.manifest.digests", 1), ("textgate.sources.manifest.publish", 1)]
    for name, _ in steps:
        with monkeypatch.context() as m:
            m.setattr(name, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
            with pytest.raises(KeyboardInterrupt):
                new.save(path)
        assert (TR.load_gate(spark, path).weights == old.weights).all()
    new.save(path)
    back = TR.load_gate(spark, path)
    assert (back.weights == new.weights).all() and (back.idf == new.idf).all() and (back.text_col, back.label_col) == ("t", "l")


def test_a_damaged_model_is_refused(spark, tmp_path):
    a_model(3).save(str(tmp_path / "m"))
    version = MF.latest(spark, str(tmp_path / "m"))["version"]
    file = next((tmp_path / "m" / version / "weights").glob("*.parquet"))
    other = spark.read.parquet(str(file)).filter("feature > 3").toPandas()
    other.to_parquet(file)
    for crc in (tmp_path / "m" / version / "weights").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(ValueError, match="'weights' has 29 rows, published were 33"):
        TR.load_gate(spark, str(tmp_path / "m"))


def test_score_shuffles_no_row_per_word(spark):
    """Word counts of a document are made where its ids are; the ids are made once, not again for a filter on them."""
    from conftest import SF001
    from textgate.plans.queries import QUERIES

    df = QUERIES["score"](spark, SF001)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1
    assert "Filter ((size(" not in plan and "size(filter(" not in plan
    agg = [x for x in plan.splitlines() if "Aggregate [doc_id" in x and "feature" in x]
    assert agg and "RepartitionByExpression [doc_id" in plan
